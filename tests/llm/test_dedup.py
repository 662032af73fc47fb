import random
from collections import Counter

import numpy as np
import pytest

from parcelpulse.llm import embed_dedup, graph, minhash


def _classes(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (5, 5), (None, 3), (200, 300), (1000, 200)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90, 200: 200, 300: 200, 1000: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    with np.errstate(over="ignore"):
        for share in (100, 220, 280):
            a = rng.integers(0, 60, 300).tolist()
            b = a[:share] + rng.integers(0, 90, 100).tolist()
            bags = [np.unique(minhash.mixed(np.array(x, np.uint64)), return_counts=True) for x in (a, b)]
            found = minhash.signatures(bags, 8000)
            ca, cb = Counter(a), Counter(b)
            want = sum((ca & cb).values()) / sum((ca | cb).values())
            assert abs((found[0] == found[1]).mean() - want) < 0.02


def _shingles(text):
    w = text.lower().split()
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def _texts():
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(4))
    base = [" ".join(word() for _ in range(random.randint(6, 150))) for _ in range(25)]
    rows = list(base)
    for b in base[:15]:
        for _ in range(6):
            w = b.split()
            for _ in range(random.randint(0, max(1, len(w) // 25))):
                w[random.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rows += ["", None, " \n", "one two", "One  two", "one two three", "a b c d e " * 200, "a b c d e " * 230, base[0], base[0].upper(), "x " * 30_000]
    return dict(enumerate(rows))


@pytest.mark.parametrize("plan", [minhash.Plan(), minhash.Plan(block=4)])
def test_texts_like_brute_force(spark, plan):
    texts = _texts()
    bags = {i: _shingles(t or "") for i, t in texts.items()}

    def linked(a, b):
        x, y = bags[a], bags[b]
        if not x or not y or len((texts[a] or "").split()) < 5 or len((texts[b] or "").split()) < 5:
            return bool(x) and x == y and texts[a].lower().split() == texts[b].lower().split()
        return sum((x & y).values()) >= 0.8 * sum((x | y).values()) - 1e-9

    want = _classes(list(texts), linked)
    df = spark.createDataFrame(list(texts.items()) + [(None, texts[0]), (3, texts[3])], "doc_id long, text string")
    out = minhash.near_duplicates(df, plan).collect()
    assert {r.doc_id: r.class_id for r in out} == want and all(r.kept == (r.doc_id == r.class_id) for r in out)
    assert len(out) == len(texts)


def test_one_of_each_class_stays(docs):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (3, text), (3, text), (9, "other words stand here alone now"), (None, text), (7, None), (8, "")]
    out = minhash.keep_one(docs(rows))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "7", "8", "9", "None"]
    assert out.columns == docs(rows).columns
    assert minhash.keep_one(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 3])
def test_vectors_like_brute_force(spark, block):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 16))
    vectors = [v for v in base] + [b + rng.standard_normal(16) * 0.03 for b in base[:8] for _ in range(7)]
    rows = [(i, v.tolist(), i % 2 if i < 12 else (i - 12) // 7 % 2) for i, v in enumerate(vectors)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], 1), (203, [x * 1e-200 for x in rows[0][1]], 0), (204, [x * 1e200 for x in rows[0][1]], 0)]
    lone = [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] + rows[0][1][1:], 0), (304, [float("inf")] + rows[0][1][1:], 0)]
    lone += [(305, [None] + rows[0][1][1:], 0), (306, rows[0][1], None), (307, rows[0][1][:8], 0)]
    unit = {i: np.array(v) / np.abs(v).max() for i, v, _ in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    label = {i: x for i, _, x in rows}
    near = lambda a, b: label[a] == label[b] and unit[a] @ unit[b] >= 0.98
    want = _classes([i for i, _, _ in rows], near)
    links = {a: sum(near(a, b) for b in label if a != b) for a in label}
    df = spark.createDataFrame(rows + lone + [(None, rows[0][1], 0), rows[1]], "vec_id long, embedding array<double>, label int")
    out = embed_dedup.near_duplicates(df, tables=embed_dedup.Tables(block=block)).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert {i: got[i] for i in label if i != 1} == {i: (links[i], want[i], want[i] == i) for i in label if i != 1}
    assert got[1][1] == want[1]
    assert all(got[i] == (0, i, True) for i, _, _ in lone) and got[None] == (0, None, True) and len(out) == len(label) + 9
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_keep_one_where_ids_do_not_tell_rows_apart(spark):
    """Unlike texts of one id stay both, repeats go, the least id of a class stays, and so do null ids."""
    words = [f"word{i}" for i in range(40)]
    a, b, c = " ".join(words), " ".join(reversed(words)), " ".join(words[::2] * 2)
    near = " ".join([*words[:39], "other"])
    rows = [(1, a), (1, b), (2, near), (None, c), (None, c), (None, a), (3, c), (4, ""), (4, ""), (4, None), (5, "alone here")]
    df = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, row string, nth int")
    got = minhash.keep_one(df)
    assert got.columns == df.columns
    kept = sorted((str(r.doc_id), str(r.text)) for r in got.collect())
    assert kept == sorted([("1", a), ("1", b), ("3", c), ("4", ""), ("4", "None"), ("5", "alone here"), ("None", a), ("None", c), ("None", c)])
    assert minhash.keep_one(df.limit(0)).count() == 0
