"""Mixing against a plain water-filling, hand-worked cases and the rules of its parts."""

import math
import random
import re

import duckdb
import pytest

from parcelpulse.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string"


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes, weights, most=3.0):
    """The textbook way: clamp what is above its cap, share the rest anew, again and again."""
    target, open_ = {}, set(sizes)
    left = float(sum(sizes.values()))
    while open_:
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total if total else 0.0 for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000, 90_000]) for i in range(40)}
    weights = {s: rng.choice([0.0, 1.0, 2.0, 5.0, 0.25]) for s in sizes}
    rows = [(s, n, weights[s]) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.fill(spark.createDataFrame(rows, "source string, source_size long, weight double")).collect()}
    want = _targets(sizes, weights)
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in sizes)


def test_many_sources_that_clamp_one_by_one_take_few_rounds(spark, monkeypatch):
    rows = [(f"s{i:02}", 2**i, float(4**i)) for i in range(20, 0, -1)]
    df = spark.createDataFrame(rows, "source string, source_size long, weight double").cache()
    got = {r.source: r.target for r in mixing.fill(df, 2.0).collect()}
    want = _targets({s: n for s, n, _ in rows}, {s: w for s, _, w in rows}, 2.0)
    assert all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)


def test_hand_worked(spark):
    # 12 words in all; a asks for 7.5 but stops at 3 epochs of 2, so b and c share 6 as 2 to 1
    rows = [(1, "x y", "a"), (2, "p q r s t u v", "b"), (3, "k l m", "c")]
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), [5.0, 2.0, 1.0]).collect()}
    assert [(got[i].size, got[i].source_size, got[i].target, got[i].taken) for i in (1, 2, 3)] == [
        (2, 2, 6.0, 6), (7, 7, 4.0, 4), (3, 3, 2.0, 2)
    ]
    assert (got[1].repeats, got[1].part_words, got[2].repeats, got[2].part_words) == (3, 0, 0, 4)


def test_odd_rows(spark):
    """Null ids, texts and sources, empty and repeated documents, and a column that clashes."""
    rows = [(None, "a b", None), (None, "c", None), (1, None, "s"), (1, None, "s"), (2, "", "t"), (3, "d e f", "u"), (3, "d e f", "u"), (4, " \t\n", "u")]
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", size int")
    got = mixing.mix(df, [5.0, 2.0, 1.0], carry=("text",)).collect()
    assert len(got) == len(rows)
    total = sum(_words(r[1]) for r in rows)
    for source in {r[2] for r in rows}:
        own = [r for r in got if r.source == source]
        assert len({(r.source_size, r.target) for r in own}) == 1
        assert own[0].source_size == sum(_words(r[1]) for r in rows if r[2] == source)
        assert sum(r.taken for r in own) == math.floor(own[0].target + 0.5)
    assert sum(r.target for r in {r.source: r for r in got}.values()) == pytest.approx(total)
    assert all(r.size == _words(r.carried.text) and 0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(df.limit(0), [5.0, 2.0, 1.0]).count() == 0


def test_hot_source_is_taken_to_the_word_and_again_the_same(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), "hot" if i % 3 else f"c{i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = {r.doc_id: r for r in mixing.mix(df, [1.0, 2.0, 5.0]).collect()}
    again = {r.doc_id: r for r in mixing.mix(df.repartition(7), [1.0, 2.0, 5.0]).collect()}
    assert once == again
    for source in {r.source for r in once.values()}:
        own = [r for r in once.values() if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert sum(0 < r.part_words < r.size for r in own) <= 1 and len({r.repeats for r in own}) == 1
    other = {r.doc_id: r.taken for r in mixing.mix(df, [1.0, 2.0, 5.0], seed=7).collect()}
    assert other != {k: r.taken for k, r in once.items()}


def test_weights_by_code_point_null_last_and_by_table(spark):
    names = spark.createDataFrame([("é",), ("Z",), (None,), ("a",), ("",), ("\U0001f600",)], "source string")
    assert {r.source: r.weight for r in mixing.cycled_weights(names, [5.0, 2.0, 1.0]).collect()} == {
        "": 5.0, "Z": 2.0, "a": 1.0, "é": 5.0, "\U0001f600": 2.0, None: 1.0
    }
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "e f", "y"), (3, "g", "z")], SCHEMA)
    table = spark.createDataFrame([("x", 1.0), ("y", None)], "source string, weight double")
    got = {r.source: r.target for r in mixing.mix(docs, table).collect()}
    assert got == {"x": 7.0, "y": 0.0, "z": 0.0}


def test_repetitions_hold_the_words_taken(spark):
    rows = [(1, " one two\tthree", "a"), (2, "four five six seven eight nine", "b"), (3, "", "a"), (4, "ten", "c")]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), [5.0, 2.0, 1.0], carry=("text",))
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    texts = {}
    for r in mixing.repetitions(mixed, mixed["carried.text"]).collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    own = {r[0]: r[1] for r in rows}
    assert {k: sum(map(_words, v)) for k, v in texts.items()} == {k: v for k, v in taken.items() if v}
    assert all(own[k].startswith(t) for k, v in texts.items() for t in v)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    cursor = con.execute(queries.ORACLE_SQL["op11_mixing"])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(dict(zip(names, r)).items()) for r in cursor.fetchall())
    got = queries.op11_mixing(spark, "/root/testdata/sf0.001")
    assert sorted(tuple(r.asDict().items()) for r in got.select(*names).collect()) == want
