"""Data-quality checks and load reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def reconcile(source: DataFrame, target: DataFrame, by: str = "year_month") -> DataFrame:
    """Row counts of source and target per group, OK or MISMATCH."""
    a = source.groupBy(by).agg(F.count(F.lit(1)).alias("source_rows"))
    b = target.groupBy(by).agg(F.count(F.lit(1)).alias("target_rows"))
    both = a.withColumn("target_rows", F.lit(0)).unionByName(b.withColumn("source_rows", F.lit(0)))
    return both.groupBy(by).agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")
    ).withColumn("status", F.when(F.col("source_rows") == F.col("target_rows"), "OK").otherwise("MISMATCH"))


def load_report(events: DataFrame) -> DataFrame:
    """Rows, distinct orders and distinct statuses per month."""
    return events.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("logistic_order_id").alias("n_orders"),
        F.count_distinct("package_status").alias("n_statuses"),
    )


def null_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULLs per required column, all columns of a table in one pass."""
    out = None
    for name, (df, columns) in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
        rows = counts.select("n_rows", F.explode(pairs).alias("p")).select(
            F.lit(name).alias("table_name"), F.col("p.column").alias("column_name"), "n_rows",
            F.col("p.n_null").alias("n_null"), (F.col("p.n_null") == 0).alias("passed"),
        )
        out = rows if out is None else out.unionByName(rows)
    assert out is not None
    return out


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with counts; NULL is not judged."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many keys occur once, twice, ...: the unique-key expectation in one table."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_per_key"))
    return sizes.groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("n_keys"))


