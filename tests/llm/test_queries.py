"""The registered queries over whole small tables, against DuckDB or the libraries."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from parcelpulse.llm import queries
from parcelpulse.llm.common import rank_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def _rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_url_filter(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cursor = con.execute(queries.ORACLE_SQL["op1_url_filter"])
    names = [d[0] for d in cursor.description]
    want = sorted((dict(zip(names, r)) for r in cursor.fetchall()), key=lambda r: r["page_id"])
    assert sorted((r.asDict() for r in _rows(spark, "op1_url_filter")), key=lambda r: r["page_id"]) == want


def test_token_store_and_packing(spark, texts):
    words, pieces = Tokenizer.from_file(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start = 0
    for r in sorted(_rows(spark, "op3_token_store"), key=lambda r: r.doc_id):
        ids = words.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), _crc(ids))
        start += len(ids)
    ids = {k: pieces.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}
    packed = _rows(spark, "op6_packing")
    assert sorted(r.doc_id for r in packed if r.start == 0) == sorted(texts)
    assert all(r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == _crc(ids[r.doc_id][r.start : r.start + r.length]) for r in packed)
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in _rows(spark, "op10_token_counts")}
    assert counts == {k: (len(t.encode()), len(ids[k]) - 1, len(ids[k]) > 513) for k, t in texts.items()}


def test_codec(spark, texts):
    plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=rank_table(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in _rows(spark, "op5_bpe_codec"):
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


@pytest.mark.parametrize("name", ["op2_license_scan", "op4_pii", "op7_minhash_dedup", "op9_quality_rules"])
def test_one_row_per_document(spark, texts, name):
    assert sorted(r.doc_id for r in _rows(spark, name)) == sorted(texts)


def test_vectors(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    unit = {r["vec_id"]: np.array(r["embedding"], float) / np.linalg.norm(np.array(r["embedding"], float)) for r in table}
    label = {r["vec_id"]: r["label"] for r in table}
    got = {r.vec_id: r for r in _rows(spark, "op8_embedding_dedup")}
    for a in unit:
        near = [b for b in unit if b != a and label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
        assert got[a].n_links == len(near) and all(got[b].component_id == got[a].component_id for b in near)
