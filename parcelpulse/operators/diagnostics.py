"""Distributions of hours by class, and validity of the promised SLA."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.ordered import percentile_name, percentiles
from parcelpulse.session import staged

HOURS = "target_horas_totales"
SLA = "sla_horas_prometidas"


def class_name(target: Column) -> Column:
    return F.when(target == 0, "OK").when(target == 1, "DISRUPTED")


def category_name(category: Column) -> Column:
    return F.coalesce(category, F.lit("(NULL)"))


def with_class(population: DataFrame) -> DataFrame:
    return population.withColumn("clase", class_name(F.col("target_binario"))).withColumn(
        "service_category", category_name(F.col("service_category"))
    )


def describe_by(df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float], spread: bool) -> DataFrame:
    """Count, mean and exact percentiles per group; minimum, maximum and deviation with ``spread``."""
    stats = [F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("media")]
    if spread:
        stats += [F.min(value).alias("min_h"), F.max(value).alias("max_h"), F.round(F.stddev(value), 6).alias("std_h")]
    exact = percentiles(df, by, {"v": F.col(value)}, {"v": probs})
    named = [F.round(percentile_name("v", p), 6).alias(f"p{round(p * 100):02d}") for p in probs]
    return null_safe_join(df.groupBy(*by).agg(*stats), exact.select(*by, *named), list(by))


def pivot_ratio(by_category: DataFrame) -> DataFrame:
    """Mean hours of both classes side by side, and their ratio."""
    wide = by_category.groupBy("service_category").pivot("clase", ["OK", "DISRUPTED"]).agg(F.first("media"))
    return wide.select(
        "service_category", F.col("OK").alias("ok"), F.col("DISRUPTED").alias("disrupted"),
        F.round(F.try_divide("DISRUPTED", "OK"), 6).alias("ratio_disrupted_ok"),
    )


def sample_per_class(df: DataFrame, cls: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """A random sample of at most n rows per class, exactly n where the class has more.

    The random number of a row is a hash of its key, hence the same on every
    recomputation. Rows are ranked only inside the one hash bin of each class where
    the n-th row falls; lower bins are taken whole.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))
    drawn = df.withColumn("__h", digest).withColumn("__bin", F.substring("__h", 1, 4))
    sizes = drawn.groupBy(cls, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(cls).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
    room = sizes.withColumn("__room", F.lit(n) - (upto - F.col("__n"))).where(F.col("__room") > 0)
    room = staged(room.select(cls, "__bin", "__room", "__n"), "sample-bins")
    joined = null_safe_join(drawn, room, [cls, "__bin"])
    whole = joined.where(F.col("__n") <= F.col("__room"))
    rank = F.row_number().over(Window.partitionBy(cls, "__bin").orderBy("__h", key))
    cut = joined.where(F.col("__n") > F.col("__room")).withColumn("__r", rank).where(F.col("__r") <= F.col("__room"))
    return whole.select(*df.columns).unionByName(cut.select(*df.columns))


def histogram(df: DataFrame, value: str, by: str, bins: int = 80, cap: float = 0.99) -> DataFrame:
    """Equal-width bins per class: of hours clipped to [0, global p99], and of log1p(hours).

    As usual, a class's bins span its own values and the last bin includes its end.
    """
    top = percentiles(df, [], {"v": F.col(value)}, {"v": [cap]}).first()[percentile_name("v", cap)]
    scaled = df.select(
        by,
        F.explode(F.array(
            F.struct(F.lit("lineal").alias("escala"),
                     F.least(F.greatest(F.col(value), F.lit(0.0)), F.lit(top)).alias("x")),
            F.struct(F.lit("log1p").alias("escala"), F.log1p(value).alias("x")),
        )).alias("s"),
    ).select(by, "s.escala", "s.x")
    # one row per class and scale; its stored size lets the planner broadcast it
    bounds = staged(
        scaled.groupBy(by, "escala").agg(F.min("x").alias("lo"), F.max("x").alias("hi")), "histogram-bounds"
    )
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("lo")) / width))).otherwise(0)
    return (
        null_safe_join(scaled, bounds, [by, "escala"])
        .groupBy(by, "escala", slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
        .select(
            by, "escala", "bin", "n",
            F.round(F.col("lo") + F.col("bin") * width, 6).alias("desde"),
            F.round(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("hasta"),
        )
    )


def sample_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Mean, median and population deviation per class, and the mean over that of class OK."""
    exact = percentiles(df, [by], {"v": F.col(value)}, {"v": [0.5]})
    stats = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__std")
    )
    ok = F.max(F.when(F.col(by) == "OK", F.col("__mean"))).over(Window.partitionBy(F.lit(1)))
    # at most one row per class reaches this window
    return null_safe_join(stats, exact, [by]).select(
        by, "n", F.round("__mean", 6).alias("media"), F.round(percentile_name("v", 0.5), 6).alias("mediana"),
        F.round("__std", 6).alias("std"), F.round(F.try_divide(F.col("__mean"), ok), 6).alias("ratio_media_ok"),
    )


def _pct(part: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * part / F.count(F.lit(1)), digits)


def _invalid() -> Column:
    return F.col(SLA).isNull() | (F.col(SLA) <= 0)


def sla_validity(population: DataFrame) -> DataFrame:
    """State of the promised SLA per split."""
    valid = F.col(SLA) > 0
    return population.groupBy("split_set").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(SLA).isNull()).alias("sla_null"),
        F.count_if(F.col(SLA) <= 0).alias("sla_zero_neg"),
        F.count_if(valid).alias("sla_valida"),
        _pct(F.count_if(F.col(SLA).isNull()), 2).alias("pct_null"),
        F.round(F.avg(F.when(valid, F.col(SLA))), 1).alias("media_sla_valida"),
        F.round(F.min(SLA), 1).alias("min_sla"),
        F.round(F.max(SLA), 1).alias("max_sla"),
    )


def sla_by_category(population: DataFrame) -> DataFrame:
    return population.groupBy(category_name(F.col("service_category")).alias("service_category"), "split_set").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_invalid()).alias("sla_invalida"),
        _pct(F.count_if(_invalid()), 1).alias("pct_invalida"),
    )


def sla_top_sellers(population: DataFrame, k: int = 15) -> DataFrame:
    """The k (seller, category) pairs with most invalid SLAs."""
    counts = population.where(_invalid()).groupBy("seller_id", "service_category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_invalid()).alias("sla_invalida"),
        _pct(F.count_if(_invalid()), 1).alias("pct_invalida"),
    )
    category = category_name(F.col("service_category")).alias("categoria_mas_frecuente")
    return counts.orderBy(F.col("sla_invalida").desc(), "seller_id", "service_category").limit(k).select(
        "seller_id", "total", "sla_invalida", "pct_invalida", category
    )


def sla_filter_impact(population: DataFrame) -> DataFrame:
    """Rows kept by demanding a positive SLA, and the deviation over those rows."""
    valid = F.col(SLA) > 0
    off = F.when(valid, F.col(HOURS) - F.col(SLA))
    exact = percentiles(population, ["split_set"], {"v": off}, {"v": [0.5, 0.9]})
    base = population.groupBy("split_set").agg(
        F.count(F.lit(1)).alias("filas_actuales"),
        F.count_if(valid).alias("filas_con_sla_valido"),
        _pct(F.count_if(valid), 1).alias("pct_retencion"),
        F.round(F.avg(off), 1).alias("desvio_medio_h"),
    )
    return base.join(exact, "split_set", "left").select(
        *base.columns,
        F.round(percentile_name("v", 0.5), 1).alias("desvio_mediana_h"),
        F.round(percentile_name("v", 0.9), 1).alias("desvio_p90_h"),
    )


# Classes of the deviation in their order, with inclusive or exclusive upper ends in hours.
DEVIATION_CLASSES = [
    ("muy_early (< -24h)", "<", -24.0),
    ("early (0 a -24h)", "<", 0.0),
    ("exacto", "<=", 0.0),
    ("leve_tarde (0-24h)", "<=", 24.0),
    ("tarde (24-72h)", "<=", 72.0),
    ("muy_tarde (> 72h)", "<=", float("inf")),
]


def deviation_buckets(population: DataFrame) -> DataFrame:
    """Share of each class of deviation among rows with a positive SLA, in class order."""
    off = F.col(HOURS) - F.col(SLA)
    rank = F.lit(len(DEVIATION_CLASSES))
    for i, (_, op, end) in reversed(list(enumerate(DEVIATION_CLASSES, start=1))):
        rank = F.when(off < end if op == "<" else off <= end, i).otherwise(rank)
    counts = population.where(F.col(SLA) > 0).groupBy(rank.alias("orden")).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(name) for name, _, _ in DEVIATION_CLASSES])
    # at most six rows reach this window
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        F.element_at(names, F.col("orden")).alias("categoria_desvio"), "n",
        F.round(F.lit(100.0) * F.col("n") / total, 2).alias("pct"), "orden",
    ).orderBy("orden")
