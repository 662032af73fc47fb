"""Codec, packing and token counts against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from parcelpulse.llm import bpe_codec, packing, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "Hello  world's \n\n tést <|endoftext|> a<|endoftext|>", "x" * 5000, " " * 3000 + "a", "aaaaaaa bbb" * 300, "😀é́漢字 ١٢" * 50,
    "word " * 20_000, "\n" * 2000, "a\n" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def _rows():
    return list(enumerate(TEXTS)) + [(8, TEXTS[8]), (None, "null id"), (3, "other text")]


def test_counts_are_the_library_s(docs, library):
    out = token_counts.count_tokens(docs(_rows()), JSON, P.PATTERN).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in _rows())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out) == want
    assert token_counts.count_tokens(docs([(1, "a")]).limit(0), JSON, P.PATTERN).count() == 0


def test_ragged_merging_of_runs(library):
    counter = token_counts.Counter(JSON, P.PATTERN)
    random.seed(2)
    words = ["".join(random.choice("aabé t!") for _ in range(random.randint(0, 40))) for _ in range(400)] + ["a" * n for n in range(40)]
    assert counter.count(words) == [len(e.ids) for e in library.encode_batch(words, add_special_tokens=False)]


def test_stitched_pieces_encode_like_the_whole():
    codec = bpe_codec.Codec(RANKS, P.PATTERN)
    random.seed(3)
    parts = ["a", " ", "\n", "  ", "'s", "b1", "!!", "é", "  \n", "word", "x" * 30, " " * 30]
    for _ in range(300):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 120)))
        chunk, overlap = random.choice([(20, 7), (40, 10), (16, 16)])
        last = max(0, (len(text) - overlap - 1) // chunk)
        chunks = [text[i * chunk : i * chunk + chunk + overlap] for i in range(last + 1)]
        pieces = bpe_codec.stitch(chunks, [codec.starts(c) for c in chunks], chunk, codec)
        assert "".join(pieces) == text
        assert [i for p in pieces for i in codec.encode(p)] == codec.encode(text)


def test_codec_round_trip(docs, library):
    rows = _rows()
    encoded = bpe_codec.encode(docs(rows), RANKS, P.PATTERN, chunk=1000, overlap=50)
    out = bpe_codec.decode(encoded, RANKS, P.PATTERN).collect()
    plain = bpe_codec.Codec(RANKS, P.PATTERN).encoding
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in out) == sorted(
        (str(i), plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows
    )
    assert bpe_codec.encode(docs([(1, "a")]).limit(0), RANKS, P.PATTERN).count() == 0


def test_packing_leaves_no_gap(docs, library):
    rows = _rows()
    out = packing.pack(docs(rows).repartition(3), JSON, RANKS, P.PATTERN, 1, 256).collect()
    ids = {str(i): [] for i, _ in rows}
    for i, t in rows:
        ids[str(i)].append(library.encode(t or "", add_special_tokens=False).ids + [1])
    total = sum(len(x) for many in ids.values() for x in many)
    assert sorted(s for r in out for s in range(r.sequence_id * 256 + r.offset, r.sequence_id * 256 + r.offset + r.length)) == list(range(total))
    for r in out:
        pieces = [x[r.start : r.start + r.length] for x in ids[str(r.doc_id)] if len(x) == r.doc_tokens]
        assert r.ids_crc32 in [zlib.crc32(np.array(p, "<u4").tobytes()) for p in pieces] and r.offset + r.length <= 256
    for i, many in ids.items():
        assert sum(r.length for r in out if str(r.doc_id) == i) == sum(map(len, many))
    assert packing.pack(docs([(1, "a")]).limit(0), JSON, RANKS, P.PATTERN).count() == 0
