"""Concatenate-and-cut packing of tokenised documents into sequences of fixed length.

Pass 1 tokenises once and stores ids with each row's place in its partition. The partitions'
token totals, one row each, become offsets by a running sum. Pass 2 adds the offset of its
partition to each row and cuts the global line of tokens at every multiple of the sequence
length. A document that crosses a cut leaves one boundary record per piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelpulse.llm.common import binary_column, rank_table, whole_text
from parcelpulse.session import staged

SEQUENCE = 2048


class FastIds:
    """Ids as the tokenizers library gives them for a vocabulary that exists as ranks too.

    The rank library computes the same merges several times faster; where it gives up, as on a
    run of a million spaces, the tokenizers library does the text.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        ranks = rank_table(rank_path)
        vocabulary = self.slow.get_vocab(with_added_tokens=False)
        added = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        if len(set(vocabulary) - set(added)) != len(ranks):
            raise ValueError("the rank file is not of this vocabulary")
        self.fast = tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except (ValueError, RuntimeError):
            return self.slow.encode(text, add_special_tokens=False).ids
        except BaseException as error:  # the rank library's panics are no Exception
            if type(error).__name__ != "PanicException":
                raise
            return self.slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def fast_ids(json_path: str, rank_path: str, pattern: str) -> FastIds:
    return FastIds(json_path, rank_path, pattern)


def tokenise(
    docs: DataFrame, json_path: str, rank_path: str, pattern: str, end_id: int, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """(doc_id, ids, n_tokens, part, place): little-endian 32-bit ids with the end id, and the tokens
    of the same partition before the row."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, place = fast_ids(json_path, rank_path, pattern), [end_id], 0
        for batch in batches:
            found = [np.array(ids.encode(t) + end, "<u4") for t in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in found], np.int64)
            places = place + np.cumsum(sizes) - sizes
            place += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binary_column([x.tobytes() for x in found]), pa.array(sizes), batch.column(2), pa.array(places)],
                ["doc_id", "ids", "n_tokens", "part", "place"],
            )

    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(
        F.col(id_column).alias("doc_id"), whole_text(text).alias("text"), F.spark_partition_id().alias("part")
    )
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids binary, n_tokens long, part int, place long")


def with_offsets(stored: DataFrame) -> DataFrame:
    """Adds ``start_at``, the place of a row's first token on the global line.

    The running sum sees one row per partition of pass 1, which is a number of tasks and not of
    documents. Stored, its size is known, so the join shuffles nothing unless that is large.
    """
    totals = stored.groupBy("part").agg(F.max(F.col("place") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    return stored.join(staged(offsets, "pack-offsets"), "part").withColumn("start_at", F.col("before") + F.col("place"))


def cut(placed: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """The boundary records: one row per piece of a document, with the ids of the piece."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            first = batch.column(3).to_numpy()
            from_sequence, to_sequence = first // sequence, (first + sizes - 1) // sequence
            n = to_sequence - from_sequence + 1
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = from_sequence[row] + nth
            begin = np.maximum(at * sequence, first[row])
            end = np.minimum((at + 1) * sequence, (first + sizes)[row])
            start, length = begin - first[row], end - begin
            held = [memoryview(x.as_buffer()) for x in batch.column(1)]
            ids = [held[r][4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), binary_column([bytes(x) for x in ids]),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(sizes[row]), pa.array(at), pa.array(begin % sequence),
                ],
                names,
            )

    fields = placed.schema
    schema = T.StructType(
        [T.StructField("doc_id", fields["doc_id"].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )
    return placed.select("doc_id", "ids", "n_tokens", "start_at").mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, json_path: str, rank_path: str, pattern: str, end_id: int = 1, sequence: int = SEQUENCE,
    text: str = "text", id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece; every sequence but the last is full, so padding is at most one sequence.

    A null text is the empty text and has the end id alone. Repeated rows are packed as often as
    they occur; a table without rows gives no pieces. Other columns of ``docs`` are left out.
    The stored ids take the shared folder; a lost executor repeats only its own tasks.
    """
    stored = staged(tokenise(docs, json_path, rank_path, pattern, end_id, text, id_column), "pack-ids")
    return cut(with_offsets(stored), sequence)
