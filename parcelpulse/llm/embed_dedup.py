"""Near-duplicate vectors within a label by Euclidean p-stable hashing and exact cosines.

A table's key is ``floor((a . v + b) / width)`` for several Gaussian directions ``a``, of the
normalised vector v. Vectors with cosine 0.98 are 0.2 apart and share a key of the defaults with
probability 0.25, so they meet in one of the tables but for one pair in 9,000; vectors with
cosine 0 share one of them once in 30,000. Rows that meet are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import binary_column
from parcelpulse.llm.graph import components, groups, local_roots
from parcelpulse.session import staged


@dataclass(frozen=True)
class Tables:
    count: int = 32
    directions: int = 8
    width: float = 1.0
    seed: int = 8
    #: A bucket with more rows is compared block by block, in as many tasks as pairs of blocks.
    block: int = 1024


def _unit(raw: bytes) -> np.ndarray | None:
    v = np.frombuffer(raw, np.float64)
    largest = np.abs(v).max() if len(v) else 0.0
    if not len(v) or not np.isfinite(largest) or largest == 0:
        return None
    v = v / largest
    return v / np.linalg.norm(v)


def _hashed(tables: Tables):
    planes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def drawn(width: int):
        if width not in planes:
            rng = np.random.default_rng([tables.seed, width])
            n = tables.count * tables.directions
            planes[width] = (
                rng.standard_normal((width, n)), rng.uniform(0, tables.width, n),
                rng.integers(1, 1 << 62, (tables.count, tables.directions), dtype=np.int64) | 1,
            )
        return planes[width]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            out: list[list[int] | None] = []
            for v in map(_unit, raw):
                if v is None:
                    out.append(None)
                    continue
                a, b, mix = drawn(len(v))
                spots = np.floor((v @ a + b) / tables.width).astype(np.int64).reshape(tables.count, tables.directions)
                with np.errstate(over="ignore"):
                    out.append(((spots * mix).sum(axis=1) * 31 + len(v)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], [*batch.schema.names, "keys"])

    return keys


def _linked(tables: Tables, threshold: float):
    """Links within sorted groups of rows: per row how many, and the least row it reaches."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 5):
            if group.num_rows < 2:
                continue
            nth, first, second = (group[c][0].as_py() for c in ("nth", "block_a", "block_b"))
            ids, weight = group["rep"].to_numpy(), group["copies"].to_numpy()
            vectors = [_unit(x) for x in group["vector"].to_pylist()]
            if len({len(v) for v in vectors}) > 1:
                continue  # other lengths share no key but by a collision of hashes
            rows = np.stack(vectors)
            near = np.triu(rows @ rows.T >= threshold - 1e-9, 1)
            if first != second:
                block = group["block"].to_numpy()
                near &= block[:, None] != block[None, :]
            a, b = np.nonzero(near)
            a, b = _exact(rows, a, b, group["vector"].to_pylist(), threshold)
            if not len(a):
                continue
            keys = np.stack([np.asarray(k.values) for k in group["keys"]])
            new = ~(keys[a, :nth] == keys[b, :nth]).any(axis=1)
            counts = np.zeros(len(ids), np.int64)
            np.add.at(counts, a[new], weight[b[new]])
            np.add.at(counts, b[new], weight[a[new]])
            root = local_roots(len(ids), a, b)
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, root, ids)
            hit = np.unique(np.r_[a, b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[hit]), pa.array(counts[hit]), pa.array(least[root[hit]])], ["rep", "links", "reached"]
            )

    return links


def _exact(rows, a, b, raw, threshold):
    """Pairs at the border are settled with the vectors as they are, in double precision."""
    cosines = np.einsum("ij,ij->i", rows[a], rows[b]) if len(a) < 1 << 16 else np.concatenate(
        [np.einsum("ij,ij->i", rows[a[i : i + 65536]], rows[b[i : i + 65536]]) for i in range(0, len(a), 65536)]
    )
    keep = cosines >= threshold
    for i in np.flatnonzero(np.abs(cosines - threshold) < 1e-9):
        x, y = np.frombuffer(raw[a[i]], np.float64), np.frombuffer(raw[b[i]], np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            plain = np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y))
        keep[i] = plain >= threshold if np.isfinite(plain) else keep[i]
    return a[keep], b[keep]


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, tables: Tables = Tables(), id_column: str = "vec_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id.

    Links are between different ids with equal labels that are not null. Vectors that are null,
    empty or zero, or hold a null or a value that is not finite, link with nothing, as do null
    ids, which give one row in all. An id that occurs again is one node with all its vectors.
    Equal vectors of a label are compared as one with a weight, so copies cost one comparison.
    Empty tables give no rows. Other columns are left out.

    A bucket is compared in one task only up to ``tables.block`` rows; larger ones are dealt out
    as pairs of blocks, and no pair leaves its task: each row's number of links and least
    neighbour do. A pair that meets in several tables counts in the first.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(v, np.float64).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary_column(raw)], ["id", "label", "vector"])

    sound = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    kinds = dict(rows.dtypes)
    usable = rows.where(F.coalesce(sound, F.lit(False))).mapInArrow(packed, f"id {kinds['id']}, label {kinds['label']}, vector binary")
    usable = staged(usable.distinct(), "vectors")
    reps = usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = reps.select(F.col("rep").cast("long").alias("rep"), "copies", "label", "vector")
    hashed = staged(reps.mapInArrow(_hashed(tables), f"rep long, copies long, label {kinds['label']}, vector binary, keys array<long>"), "vector-keys")

    met = hashed.select("rep", F.xxhash64("label", "vector").alias("row"), "label", F.posexplode("keys").alias("nth", "key"))
    full = met.groupBy("label", "nth", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = met.join(full, ["label", "nth", "key"])
    n_blocks = F.ceil(F.col("n") / tables.block).cast("int")
    met = met.withColumn("block", F.pmod(F.col("row"), n_blocks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    met = met.select(
        "rep", "row", F.xxhash64("label").alias("label_key"), "nth", "key", F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"), "block",
    )
    held = hashed.select(F.col("rep"), F.xxhash64("label", "vector").alias("row"), "copies", "vector", "keys")
    order = ["label_key", "nth", "key", "block_a", "block_b"]
    dealt = met.join(held, ["rep", "row"]).select(*order, "block", "rep", "copies", "vector", "keys")
    partial = dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(_linked(tables, threshold), "rep long, links long, reached long")
    partial = staged(partial.groupBy("rep", "reached").agg(F.sum("links").alias("links")), "vector-links")

    # ids with their representative: copies are linked with it, and it with what it is like
    member = usable.join(reps.select("label", "vector", "rep", "copies"), ["label", "vector"]).select(
        F.col("id").cast("long").alias("id"), "rep", "copies"
    )
    member = staged(member, "vector-members")
    per_rep = partial.groupBy("rep").agg(F.sum("links").alias("links"))
    counted = member.join(per_rep, "rep", "left").groupBy("id").agg(
        F.sum(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    edges = partial.select(F.col("rep").alias("a"), F.col("reached").alias("b")).unionByName(
        member.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    of = components(edges)
    ids = rows.select(F.col("id").cast("long").alias("vec_id")).distinct()
    out = ids.join(counted.withColumnRenamed("id", "vec_id"), "vec_id", "left").join(of.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
