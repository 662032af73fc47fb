import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from parcelpulse.llm import token_store as ts
from parcelpulse.session import new_folder

WORDS = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,size", [(0, 1), (1, 1), (1000, 1), (5000, 2), (5000, 300), (1537, 40_000)])
def test_wavelet_matrix(n, size):
    ids = np.random.default_rng(n).integers(0, size, n).astype(np.uint16)
    made = ts.WaveletMatrix.build(ids)
    m = ts.WaveletMatrix.from_row(n, **made.to_row())
    assert (m.decode() == ids).all()
    for i in range(0, n, max(1, n // 40)):
        assert m.access(i) == ids[i]
        token = int(ids[i])
        assert m.rank(token, i) == (ids[:i] == token).sum() and m.count(token) == (ids == token).sum()
        assert (m.positions(token) == np.flatnonzero(ids == token)).all() and ids[m.select(token, 0)] == token
    assert m.count(60_000) == 0 and len(m.positions(60_000)) == 0


def test_ids_of_the_library():
    tokenizer, words = Tokenizer.from_file(WORDS), ts.WordIds(WORDS)
    texts = [
        "Don't it's a.b., x... İstanbul ΣΑΣ é́ ab cd <|endoftext|> a<|startoftext|>b ½ 12ab. ª. 漢字. naïve; 'll", "", " \n\t",
        "word, word. (word) word!!! a b 　c   \x1c d", "x" * 3000, "!?" * 500, "ǅ ﬁ ß ŉ",
    ]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_in_order(spark, docs):
    tokenizer, folder = Tokenizer.from_file(WORDS), new_folder(spark, "test-store")
    rows = [(i, f"word{i} " * (i % 50)) for i in range(200)] + [(None, "null id"), (7, None), (7, "again"), (7, "again"), (999, "long " * 40_000)]
    ts.write_shards(docs(rows), WORDS, 2, folder, 5, block=500)
    got = sorted(ts.read_documents(spark, folder).collect(), key=lambda r: r.start)
    want = sorted(crc for _, t in rows for crc in [_crc(tokenizer, t)])
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(i for i, _ in rows if i is not None)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert ts.count_token(spark, folder, 2).first().n == sum(1 for _ in rows)
    long = tokenizer.encode("long", add_special_tokens=False).ids[0]
    assert ts.find_token(spark, folder, long).where("doc_id = 999").count() == 40_000
    assert ts.find_token(spark, folder, 2).where("doc_id = 3").first().place == got[[r.doc_id for r in got].index(3)].n_tokens - 1


def _crc(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def test_empty_table(spark, docs):
    folder = new_folder(spark, "test-store")
    ts.write_shards(docs([(1, "a")]).limit(0), WORDS, 2, folder, 3)
    assert ts.read_documents(spark, folder).count() == 0 and ts.count_token(spark, folder, 2).first().n == 0
