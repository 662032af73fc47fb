"""Survival words and the audit against plain counting."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from parcelpulse.llm import filter_audit as fa
from parcelpulse.llm import queries

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def _failed(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": smaller,
    }


def _brute(docs, labels):
    """Every order run over every document."""
    rows = []
    for i, text, part in docs:
        text = text or ""
        smaller = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        said = [x for x in labels if x[0] == i and i is not None]
        rows.append((part or "", _failed(text, smaller), any(x[1] == 1 for x in said), any(x[2] == 1 for x in said)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, stay = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(stay), len(gone), sum(r[1][f] for r in own) - len(gone),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
                left = stay
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def _rows(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in df.collect()}


def test_positional_popcount():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 7, 100, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        want = [int(((words >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
        assert fa.positional_popcount(words).tolist() == want


def test_survival_words():
    words = fa.survival_words()
    for mask in range(32):
        assert [bool(words[mask] >> s & 1) for s in range(32)] == [mask & s == 0 for s in range(32)]


def test_words_of_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(fa, "PIECE", 16)
    for _ in range(200):
        data = "".join(rng.choice(["a", "bb", " ", "\n", "\x0b", "é", " ", "x" * 40]) for _ in range(rng.randint(0, 60))).encode()
        found = re.findall(rb"[^\x20\x09-\x0D]+", data)
        assert fa._words(data) == (len(found), len(set(found)))


def _sample(seed, n):
    rng = random.Random(seed)
    some = ["", "Tiny", "plain words here " * 80, "A B C " * 3, "# tag", None, "many different " + " ".join(f"w{i}" for i in range(250)), "SHOUT " * 210 + "$"]
    docs = [(i, rng.choice(some) if i % 3 else f"{rng.choice(some)}{rng.randint(0, 2)}", rng.choice(["s", "t", None, ""])) for i in range(n)]
    labels = [(rng.randrange(n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


def test_audit_equals_counting(spark):
    docs, labels = _sample(4, 90)
    docs += [(None, "plain words here " * 80, "s"), (None, "", None), (5, docs[5][1], "t"), (5, "other text", "t")]
    labels += [(None, 1, 1), (1000, 1, 1)]
    got = fa.audit_filters(spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS + ", mask int, key int"), spark.createDataFrame(labels, LABELS))
    assert _rows(got) == _brute(docs, labels)


def test_hot_text_and_hot_part(spark):
    docs = [(i, "the same old text", "hot") for i in range(400)] + [(i, f"text {i}", "cold") for i in range(400, 420)]
    labels = [(i, 1, i % 2) for i in range(420)]
    got = fa.audit_filters(spark.createDataFrame(docs, DOCS).repartition(9), spark.createDataFrame(labels, LABELS))
    assert _rows(got) == _brute(docs, labels)


def test_more_parts_than_a_task_holds(spark, monkeypatch):
    rows = [(f"p{i % 500}", i % 32, i % 2 == 0, i % 3 == 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean")
    got = {r.part: r for r in fa.survivors(df).collect()}
    for part in got:
        own = [r for r in rows if r[0] == part]
        assert list(got[part].all) == [sum(r[1] & s == 0 for r in own) for s in range(32)]
        assert list(got[part].toxic) == [sum(r[1] & s == 0 and r[3] for r in own) for s in range(32)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert fa.audit_filters(none, labels).count() == 0
    one = fa.audit_filters(spark.createDataFrame([(1, None, None)], DOCS), labels)
    assert one.count() == 600 and _rows(one) == _brute([(1, None, None)], [])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(queries.ORACLE_SQL["op12_filter_audit"])
    names = [d[0] for d in cursor.description]
    got = queries.op12_filter_audit(spark, sf).select(*names)
    assert sorted(tuple(r) for r in got.collect()) == sorted(cursor.fetchall())
