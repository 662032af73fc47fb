"""Byte-level BPE encoding and decoding of texts of any length by overlapping chunks.

A text longer than a chunk becomes rows of overlapping chunks that tasks pre-tokenise side by
side. A match of the pattern depends on what follows its start only, so once the boundaries of
two neighbouring chunks share a position in their overlap, they agree from there on. The text is
cut at such a position, behind a character that is no white space, and the pieces are encoded
apart. Where an overlap holds none, as in a run of letters longer than it, the next chunk is read
on from the last sure boundary. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import binary_column, rank_table, whole_text

CHUNK, OVERLAP = 32_768, 512
IDS = pa.list_(pa.int32())


class Codec:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.pattern = regex.compile(pattern)
        ranks = rank_table(path)
        self.encoding = tiktoken.Encoding("codec", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = dict(zip(ranks.values(), ranks.keys()))

    def encode(self, text: str) -> list[int]:
        try:
            return self.encoding.encode_ordinary(text)
        except BaseException as error:  # its pattern library gives up on huge runs of white space
            if type(error).__name__ not in ("PanicException", "ValueError", "RuntimeError"):
                raise
            single = self.encoding._core_bpe.encode_single_piece
            return [i for word in self.pattern.findall(text) for i in single(word.encode())]

    def starts(self, text: str) -> np.ndarray:
        return np.fromiter((m.start() for m in self.pattern.finditer(text)), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def stitch(chunks: list[str], starts: list[np.ndarray], chunk: int, codec: Codec) -> list[str]:
    """The pieces of one text, from its chunks in order and the boundaries found in each."""
    pieces, begin, held, bounds = [], 0, chunks[0], starts[0].astype(np.int64)
    # held: the text from begin to the end of the last chunk read; bounds: its sure boundaries, absolute
    for i in range(1, len(chunks)):
        seam, text = i * chunk, chunks[i]
        here = starts[i].astype(np.int64) + seam
        both = np.intersect1d(bounds[bounds > seam], here, assume_unique=True)
        cut = next((int(p) for p in both if not text[p - seam - 1].isspace()), None)
        if cut is not None:
            pieces.append(held[: cut - begin])
            begin, held, bounds = cut, text[cut - seam :], here[here >= cut]
        else:
            end = begin + len(held)
            last = int(bounds[-1]) if len(bounds) else begin
            held += text[end - seam :]
            bounds = np.r_[bounds[:-1], codec.starts(held[last - begin :]).astype(np.int64) + last]
    return [*pieces, held]


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", id_column: str = "doc_id", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, ids) for every row, ids as an array of ints.

    A null text counts as the empty text and has no ids. Texts of one chunk need no shuffle. Long
    texts are known by their hash, so rows with equal long texts are encoded once and each gets
    the ids. Other columns are left out. A task holds a batch of chunks, or the pieces of one text.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text).alias("text"))
    is_long = F.length("text") > chunk + overlap

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, pattern)
        for batch in batches:
            ids = pa.array([tokens.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()], IDS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, pattern)
        for batch in batches:
            found = pa.array([tokens.starts(t) for t in batch.column("chunk").to_pylist()], IDS)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "starts"])

    def stitched(group: pa.Table) -> pa.Table:
        group = group.sort_by("nth")
        starts = [np.asarray(s.values) for s in group["starts"]]
        pieces = stitch(group["chunk"].to_pylist(), starts, chunk, codec(path, pattern))
        return pa.table({"key": pa.array([group["key"][0].as_py()] * len(pieces)), "piece": pa.array(range(len(pieces)), pa.int32()), "text": pieces})

    short = rows.where(~is_long).mapInArrow(encoded, f"doc_id {kind}, ids array<int>")

    long = rows.where(is_long).select("doc_id", F.sha2("text", 256).alias("key"), "text")
    last = F.expr(f"cast((length(text) - {overlap} - 1) div {chunk} as int)")
    chunks = long.select(
        "key", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("nth"), "text"
    ).select("key", "nth", F.substring("text", F.col("nth") * chunk + 1, F.lit(chunk + overlap)).alias("chunk"))
    pieces = (
        chunks.dropDuplicates(["key", "nth"])
        .mapInArrow(bounded, "key string, nth int, chunk string, starts array<int>")
        .groupBy("key")
        .applyInArrow(stitched, "key string, piece int, text string")
        .repartition("key", "piece")
        .mapInArrow(encoded, "key string, piece int, ids array<int>")
    )
    whole = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    whole = whole.select("key", F.flatten(F.col("pieces.ids")).alias("ids"))
    return short.unionByName(long.select("doc_id", "key").join(whole, "key").select("doc_id", "ids"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the concatenated bytes of the ids; null ids give null."""
    kind = dict(encoded.dtypes)["doc_id"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, pattern)
        for batch in batches:
            raw = [None if ids is None else tokens.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, binary_column(raw)], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, ids array<int>, decoded binary")
