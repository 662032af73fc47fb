"""Exact order statistics and running totals without one big sort per group.

A group (a month, a class, a split) may hold a third of all rows, so nothing here
sorts or buffers a whole group in one task. Equal values are counted first, which
combines on the map side. The counted values are then dealt into ranges of (group,
value) that hold about equally many of them, however close together they lie, and
stored with the number of their range. Totals per range, of which a group has no more
than there are ranges, place each range in the order of its group; values are sorted
within their range only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.session import staged

RANGE = "__range"


def in_ranges(df: DataFrame, order: Sequence[str | Column], tag: str = "ranges") -> DataFrame:
    """The stored rows with ``__range``, the number of the range of ``order`` that a row falls into.

    Ranges are cut by counts of a sample, as many as the session has shuffle partitions. They are
    stored, since another sample would cut them elsewhere. Rows equal in ``order`` share a range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()), tag)


def count_values(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per group, measure and distinct value, with its count; NULL and NaN values left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), col.cast("double").alias("value"))
            for name, col in measures.items()
        ]
    )
    return (
        df.select(*by, F.explode(pairs).alias("m"))
        .select(*by, "m.measure", "m.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def percentiles(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], probs: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Exact linearly interpolated percentiles per group, one column per measure and probability.

    Columns are ``<measure>__<percent>`` such as ``total__95``; ``probs`` gives the
    probabilities wanted of each measure.
    """
    keys = [*by, "measure"]
    counts = in_ranges(count_values(df, by, measures), [*keys, "value"])
    group = Window.partitionBy(*keys)
    bins = (
        counts.groupBy(*keys, RANGE)
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("n").over(group))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    wanted = F.create_map(
        *[x for m, ps in probs.items() for x in (F.lit(m), F.array(*[F.lit(float(p)) for p in ps]))]
    )

    def targets(end: str) -> Column:
        """Rank within the range of the lower or upper neighbour of each percentile."""
        snap = F.floor if end == "lo" else F.ceil

        def target(p: Column) -> Column:
            at = (F.col("total") - 1) * p
            return F.struct(
                p.alias("prob"), F.lit(end).alias("end"),
                (snap(at).cast("long") - F.col("before")).alias("rank"), (at - F.floor(at)).alias("part"),
            )

        return F.transform(F.try_element_at(wanted, F.col("measure")), target)

    bins = bins.withColumn(
        "targets",
        F.filter(F.concat(targets("lo"), targets("hi")), lambda t: (t["rank"] >= 0) & (t["rank"] < F.col("n"))),
    ).where(F.size("targets") > 0)
    within = Window.partitionBy(*keys, RANGE).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        null_safe_join(counts, bins.select(*keys, RANGE, "targets"), [*keys, RANGE])
        .withColumn("upto", F.sum("n").over(within))
        .select(*keys, "value", "n", "upto", F.explode("targets").alias("t"))
        .where((F.col("t.rank") < F.col("upto")) & (F.col("t.rank") >= F.col("upto") - F.col("n")))
        .groupBy(*keys, F.col("t.prob").alias("prob"))
        .agg(
            F.max(F.when(F.col("t.end") == "lo", F.col("value"))).alias("lo"),
            F.max(F.when(F.col("t.end") == "hi", F.col("value"))).alias("hi"),
            F.max("t.part").alias("part"),
        )
        .withColumn("value", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part"))
    )
    columns = [
        F.max(F.when((F.col("measure") == m) & (F.col("prob") == float(p)), F.col("value"))).alias(
            percentile_name(m, p)
        )
        for m, ps in probs.items()
        for p in ps
    ]
    return hits.groupBy(*by).agg(*columns)


def percentile_name(measure: str, prob: float) -> str:
    return f"{measure}__{round(prob * 100):02d}"


def running_totals(
    counts: DataFrame, by: Sequence[str], value: str | Sequence[str], sums: Sequence[str], descending: bool = True
) -> DataFrame:
    """Running and total sums over the rows of each group in the order of ``value``.

    Adds ``cum_<s>`` (this row included) and ``tot_<s>`` for each summed column. Rows equal in
    ``by`` and ``value`` are summed one after the other, in any order.
    """
    order = [F.col(v).desc() if descending else F.col(v).asc() for v in ([value] if isinstance(value, str) else value)]
    ranged = in_ranges(counts, [*by, *order])
    group = Window.partitionBy(*by)
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, RANGE).agg(*[F.sum(s).alias(s) for s in sums])
    totals = totals.select(
        *by, RANGE,
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"before_{s}") for s in sums],
        *[F.sum(s).over(group).alias(f"tot_{s}") for s in sums],
    )
    within = Window.partitionBy(*by, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = null_safe_join(ranged, totals, [*by, RANGE])
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"before_{s}") + F.sum(s).over(within))
    return out.drop(RANGE, *[f"before_{s}" for s in sums])


def most_frequent(df: DataFrame, key: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Most frequent value per key; ties go to the smallest value; NULL values do not count."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*key, value)
        .agg(n.alias("__n"))
        .groupBy(*key)
        .agg(F.min_by(F.col(value), F.struct(-F.col("__n"), F.col(value))).alias(value))
    )
