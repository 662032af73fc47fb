"""Audit of how filters interact, by truth-table survival words.

A document that fails a set of filters survives exactly those subsets of the filters that hold none of them.
With five filters there are 32 subsets, so a document becomes one 32-bit word: bit s is set if the
document survives subset s. Counting the documents that survive each subset is then a positional
popcount over words. It is done by carry-save adders: three words of equal weight become one of
that weight and one of twice the weight, bit by bit for a whole array at once, until some two words
per weight are left to be unpacked. Whatever is asked about an order of filters follows from these
32 counts per part and label, without a look at any document.

Tasks hand on the counts of each part, never rows. A hot part is counted wherever its rows lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import whole_text
from parcelpulse.session import staged

#: The filters by letter, their limits and the signs of D.
LETTERS = "ABCDE"
FEWEST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
SIGNS = b"#$%&*|"
SAME_TEXT = 1 << LETTERS.index("E")
#: Bytes of a text whose words are split at once.
PIECE = 1 << 20
#: Parts whose counts a task holds before it hands them on.
PARTS_HELD = 4096
LABELS = ("all", "good", "toxic")


def _words(data: bytes) -> tuple[int, int]:
    """Number of words and of different words; long texts are split piece by piece."""
    if len(data) <= PIECE:
        found = data.split()
        return len(found), len(set(found))
    n, different, at, rest = 0, set(), 0, b""
    while at < len(data):
        piece = rest + data[at : at + PIECE]
        at += PIECE
        found = piece.split()
        # the last word may go on in the next piece
        rest = found.pop() if at < len(data) and found and piece[-1:].strip() else b""
        n += len(found)
        different.update(found)
    if rest:
        n += 1
        different.add(rest)
    return n, len(different)


def failed_alone(data: bytes) -> int:
    """The mask of the filters A to D that a text fails; bit 0 is A."""
    n, different = _words(data)
    codes = np.frombuffer(data, np.uint8)
    capitals = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    points = int(np.count_nonzero((codes & 0xC0) != 0x80))
    return (
        (n < FEWEST_WORDS)
        | (100 * different < LEAST_DISTINCT * n) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | any(bytes([sign]) in data for sign in SIGNS) << 3
    )


def document_masks(docs: DataFrame, text: str = "text", id_column: str = "doc_id", part: str = "source") -> DataFrame:
    """(doc_id, part, mask, key): the filters failed by a text alone, and the digest of the text.

    A null text is an empty one, a null part the empty part. An empty text fails A only.
    """
    kind = dict(docs.dtypes)[id_column]

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x.as_py() for x in batch.column(2)]
            masks = pa.array([failed_alone(x) for x in data], pa.int32())
            keys = pa.array([hashlib.sha256(x).digest() for x in data], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, keys], ["doc_id", "part", "mask", "key"])

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.encode(whole_text(text), "UTF-8").alias("data"),
    )
    return rows.mapInArrow(masked, f"doc_id {kind}, part string, mask int, key binary")


def with_repeats(masks: DataFrame) -> DataFrame:
    """Sets the bit of E where a smaller id has the same text anywhere in the table.

    Only texts that several ids share are joined, one row for each. A null id is neither smaller
    nor larger than another; rows that repeat one id with one text do not fail for each other.
    """
    least = masks.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # stored, so that both sides of the join are plain exchanges, of which a hot one can be split
    shared = staged(least.where(F.col("first") < F.col("last")).select("key", "first"), "audit-shared")
    joined = masks.join(shared, "key", "left")
    again = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return joined.withColumn("mask", F.col("mask").bitwiseOR(F.when(again, SAME_TEXT).otherwise(0))).drop("key", "first")


def survival_words(n_filters: int = 5) -> np.ndarray:
    """For each mask of failed filters the word of the subsets that a document with it survives."""
    subsets = np.arange(1 << n_filters)
    bits = (subsets[:, None] & subsets[None, :]) == 0
    return (bits.astype(np.uint64) << subsets[None, :].astype(np.uint64)).sum(axis=1).astype(np.uint32)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set, by a tree of carry-save adders."""
    counts, level, weight = np.zeros(32, np.int64), np.ascontiguousarray(words, np.uint32), 1
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c, rest = level[:third], level[third : 2 * third], level[2 * third : 3 * third], level[3 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, rest])
        if len(level):
            bits = np.unpackbits(np.ascontiguousarray(level, "<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
            counts += weight * bits.sum(axis=0, dtype=np.int64)
        level, weight = np.concatenate(carries) if carries else level[:0], weight * 2
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """(part, all, good, toxic): per part the documents that survive each subset, an array of 32
    counts for all of them and for those of each label. ``rows`` has part, mask, good and toxic."""
    words = survival_words()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array([x[k].tolist() for x in held.values()], pa.list_(pa.int64())) for k in range(len(LABELS))]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *columns], ["part", *LABELS])

        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            codes, names = parts.indices.to_numpy(), parts.dictionary.to_pylist()
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(names)))
            own = words[batch.column(1).to_numpy()][order]
            labelled = [batch.column(2 + k).to_numpy(zero_copy_only=False)[order] for k in range(2)]
            for name, start, end in zip(names, [0, *ends], ends):
                of = own[start:end]
                sums = [positional_popcount(of), *[positional_popcount(of[x[start:end]]) for x in labelled]]
                held[name] = held[name] + sums if name in held else np.array(sums)
            if len(held) >= PARTS_HELD:
                yield flush()
                held.clear()
        if held:
            yield flush()

    kind = "part string, " + ", ".join(f"{k} array<long>" for k in LABELS)
    partial = rows.select("part", "mask", "good", "toxic").mapInArrow(counted, kind)
    sums = [F.sum(F.get(k, F.lit(s))).alias(f"{k}{s}") for k in LABELS for s in range(32)]
    arrays = [F.array(*[F.col(f"{k}{s}") for s in range(32)]).alias(k) for k in LABELS]
    return partial.groupBy("part").agg(*sums).select("part", *arrays)


def _steps(letters: Sequence[str]) -> list[tuple[str, int, int, int, int]]:
    """(order, step, filters applied before as a mask, filter's place and bit) of every order and step."""
    out = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(letters[i] for i in order), step, before, f, 1 << f))
            before |= 1 << f
    return out


def audit(counts: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, all read off the survivors of subsets.

    There are 600 rows per part, whatever the number of documents; zeros are included.
    """
    steps, every = _steps(LETTERS), (1 << len(LETTERS)) - 1
    plan = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, ("filter_order", "step", "before", "filter", "bit"))]) for s in steps])
    by_filter = [[b for _, _, b, f, _ in steps if f == i] for i in range(len(LETTERS))]

    def lost(kind: str, before: Column, bit: Column) -> Column:
        return F.get(kind, before) - F.get(kind, before + bit)

    def total(f: int) -> Column:
        """Removed by one filter, summed over all orders: each set before it counts as often as orders begin so."""
        out = F.lit(0)
        for before in sorted(set(by_filter[f])):
            out = out + (F.get("all", F.lit(before)) - F.get("all", F.lit(before | 1 << f))) * by_filter[f].count(before)
        return out

    shapley = F.array(*[total(f) for f in range(len(LETTERS))])
    rows = counts.withColumn("__shapley", shapley).withColumn("s", F.explode(plan))
    before, bit, none = F.col("s.before"), F.col("s.bit"), F.lit(0)
    removed = lost("all", before, bit)
    return rows.select(
        "part", "s.filter_order", "s.step",
        F.get("all", before + bit).alias("kept"), removed.alias("removed"),
        (lost("all", none, bit) - removed).alias("redundant"),
        lost("all", F.lit(every) - bit, bit).alias("unique_fails"),
        lost("good", before, bit).alias("good_lost"), lost("toxic", before, bit).alias("toxic_lost"),
        F.get("__shapley", F.col("s.filter")).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", part: str = "source"
) -> DataFrame:
    """The audit of the five filters over documents and their labels.

    Parts are the values of ``part``, null being the empty part. A document is good, or toxic, if any
    row of ``labels`` with its id says so; repeated labels count once, null labels and labels of
    a null id or an unknown one count for nothing. Repeated documents count each. Texts of any
    length are judged whole. An empty table has no parts and so no rows. Columns beyond those
    named are never looked at, so their names can't clash.
    """
    masks = staged(document_masks(docs, text, id_column, part), "audit-masks")
    said = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    rows = with_repeats(masks).join(said, "doc_id", "left").fillna(False, ["good", "toxic"])
    return audit(staged(survivors(rows), "audit-counts"))
