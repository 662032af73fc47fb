"""Connected components of a graph of links, and groups of sorted rows inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the links (a, b): the smallest node reachable.

    Alternates two star steps until nothing changes: every node hands the least node it knows to
    its larger neighbours, then to its smaller ones. The number of rounds grows with the logarithm
    of the longest chain. Least values are combined before the shuffle, and the join that gives
    them to a hub's many links is one that adaptive execution splits. Rounds are stored in the
    shared folder. Null nodes and links of a node to itself are left out.
    """
    links = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = staged(links.distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        handed = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = staged(small.select("a", F.col("m").alias("b")).unionByName(handed).distinct(), "links")
    found = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    roots = links.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return found.unionByName(roots)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns from sorted batches; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links between them, the least node each one reaches."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, root[left])
        new = new[new]
        if (new == root).all():
            return root
        root = new
