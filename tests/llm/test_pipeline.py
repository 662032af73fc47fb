import random

import public_tokenizers as P
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _prose(n):
    """Plain sentences about trade, each with an amount; no two alike."""
    rng = random.Random(4)
    which = "old young quiet busy clever weary foreign northern honest careful stubborn wealthy".split()
    who = "baker captain neighbour weaver farmer miller carpenter sailor teacher merchant doctor painter".split()
    did = "sold bought carried weighed promised lost borrowed stored found shared counted wanted".split()
    what = "loaves barrels bales baskets planks jars sheets ropes candles bricks blankets buckets".split()
    of = "bread salt wool fruit oak honey paper hemp wax clay linen fish".split()
    when = "yesterday before after during without beyond behind near against beside".split()
    day = "supper winter harvest market rain noise church bridge summer morning".split()
    pick = lambda words: rng.choice(words)
    return " ".join(f"The {pick(which)} {pick(who)} {pick(did)} {rng.randrange(2, 900)} {pick(what)} of {pick(of)} {pick(when)} {pick(which)} {pick(day)}." for _ in range(n))


def test_stages_follow_each_other(spark, tmp_path):
    text = "The old harbour lies behind two hills, and ships from many lands still call there every spring to trade salt for wool; write to me{}@x.org."
    rows = [(1, text.format(1)), (2, text.format(1)), (3, "too short"), (4, None), (5, _prose(300))]
    full = [(i, t, "en", "s", len(t) if t else None) for i, t in rows]
    (tmp_path / "sf").mkdir()
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "sf/documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "sf/documents.parquet"))
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path / "sf"))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept[0] == [1, 2, 5] and kept[1] == kept[2] == [1, 5]
    clean = docs.where("doc_id = 1").first()
    assert "[EMAIL]" in clean.text and "@" not in clean.text and clean.n_chars == len(clean.text)
    packed = corpus_pipeline.run(spark, str(tmp_path / "sf"))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r.length for r in packed.collect()) == want
