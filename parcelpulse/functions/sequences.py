"""Row-to-row work along the events of a key, safe for hot keys.

A plain window puts every event of a key into one task. Keys with more than
``limit`` events are therefore cut into slices of consecutive events first; windows run
per (key, slice), and what must cross a slice border is carried over from one summary
row per slice. Keys below the limit have the single slice 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.session import staged

SLICE = "__slice"
HOT_KEY_ROWS = 1_000_000
KEY_BUCKETS = 4_096


@dataclass(frozen=True)
class Sequence_:
    """Events with their slice column; ``hot`` tells whether any key was cut."""

    df: DataFrame
    key: tuple[str, ...]
    time: str
    ties: tuple[str, ...]
    hot: bool

    def replace(self, df: DataFrame) -> "Sequence_":
        return Sequence_(df, self.key, self.time, self.ties, self.hot)

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]

    @property
    def lane(self) -> list[str]:
        return [*self.key, SLICE]


def hot_keys(df: DataFrame, key: Sequence[str], limit: int = HOT_KEY_ROWS) -> DataFrame | None:
    """The stored keys of more than ``limit`` rows, or None.

    Rows are first counted by a hash of their key, which shuffles at most a few thousand numbers a
    task. Only the keys of a bucket that holds more than ``limit`` are counted themselves.
    """
    marked = df.select(*key, F.pmod(F.xxhash64(*key), F.lit(KEY_BUCKETS)).alias("__bucket"))
    many = F.count(F.lit(1)) > limit
    full = [r[0] for r in marked.groupBy("__bucket").agg(many.alias("many")).where("many").collect()]  # numbers of buckets
    if not full:
        return None
    found = marked.where(F.col("__bucket").isin(full)).groupBy(*key).agg(many.alias("many")).where("many").drop("many")
    hot = staged(found, "hot-keys")
    return None if hot.isEmpty() else hot


def sequence(
    df: DataFrame, key: Sequence[str], time: str, ties: Sequence[str] = (), limit: int = HOT_KEY_ROWS
) -> Sequence_:
    """Cut the events of hot keys into slices of about ``limit`` events, by rank.

    The events of hot keys are dealt out by ranges of (key, time, ties), so a burst is cut as
    finely as it is dense, and an instant by its ties. They are stored with their slice, because
    the bounds of ranges are drawn anew by every plan that computes them.
    """
    hot = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    hot = staged(hot, "hot-keys")
    rows = hot.agg(F.sum("__n").alias("n")).first().n
    if not rows:
        return Sequence_(df.withColumn(SLICE, F.lit(0).cast("long")), tuple(key), time, tuple(ties), False)
    marked = null_safe_join(df, hot, list(key), "left")
    cold = marked.where(F.col("__n").isNull()).drop("__n").withColumn(SLICE, F.lit(0).cast("long"))
    many = 2 * -(-rows // limit)
    ranges = marked.where(F.col("__n").isNotNull()).drop("__n").repartitionByRange(many, *key, time, *ties)
    sliced = staged(ranges.withColumn(SLICE, F.spark_partition_id().cast("long")), "hot-events")
    return Sequence_(cold.unionByName(sliced), tuple(key), time, tuple(ties), True)


def previous(seq: Sequence_, columns: Sequence[str]) -> Sequence_:
    """Add ``prev_<c>``: the value of c at the preceding event of the key."""
    here = F.struct(*[F.col(c) for c in columns])
    lane = Window.partitionBy(*seq.lane).orderBy(*seq.order)
    df = seq.df.withColumn("__prev", F.lag(here).over(lane))
    if seq.hot:
        ends = seq.df.groupBy(*seq.lane).agg(
            F.max_by(here, F.struct(*[F.col(c) for c in seq.order])).alias("__last")
        )
        carried = ends.select(
            *seq.lane, F.lag("__last").over(Window.partitionBy(*seq.key).orderBy(SLICE)).alias("__carried")
        )
        df = null_safe_join(df, carried, seq.lane, "left")
        # only the first event of a slice takes the carried value
        df = df.withColumn(
            "__prev", F.when(F.row_number().over(lane) == 1, F.col("__carried")).otherwise(F.col("__prev"))
        )
    for c in columns:
        df = df.withColumn(f"prev_{c}", F.col(f"__prev.{c}"))
    return seq.replace(df.drop("__prev", "__carried"))


def running(
    seq: Sequence_, sums: Sequence[str] = (), maxima: Sequence[str] = (), minima: Sequence[str] = ()
) -> Sequence_:
    """Add ``run_<c>``: the running sum, maximum or minimum of c up to this event."""
    lane = Window.partitionBy(*seq.lane).orderBy(*seq.order).rowsBetween(Window.unboundedPreceding, 0)
    kinds: list[tuple[str, object, object]] = (
        [(c, F.sum, lambda a, b: F.coalesce(b, F.lit(0)) + a) for c in sums]
        + [(c, F.max, lambda a, b: F.greatest(a, b)) for c in maxima]
        + [(c, F.min, lambda a, b: F.least(a, b)) for c in minima]
    )
    df = seq.df.select("*", *[fn(c).over(lane).alias(f"run_{c}") for c, fn, _ in kinds])
    if seq.hot:
        earlier = Window.partitionBy(*seq.key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        totals = seq.df.groupBy(*seq.lane).agg(*[fn(c).alias(f"__t_{c}") for c, fn, _ in kinds])
        carried = totals.select(
            *seq.lane, *[fn(f"__t_{c}").over(earlier).alias(f"__c_{c}") for c, fn, _ in kinds]
        )
        df = null_safe_join(df, carried, seq.lane, "left")
        for c, _, merge in kinds:
            df = df.withColumn(f"run_{c}", merge(F.col(f"run_{c}"), F.col(f"__c_{c}")))
        df = df.drop(*[f"__c_{c}" for c, _, _ in kinds])
    return seq.replace(df)


def gap_hours(previous_time: Column, time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", previous_time, time) / F.lit(3_600_000_000.0)
