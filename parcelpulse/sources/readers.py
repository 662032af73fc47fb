"""Reading month-partitioned logs and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


NARROW_SCAN_SPLITS = 32


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of very few splits out to all cores.

    A table of one file with one row group is read by one task, which would also do
    everything up to the first shuffle. The bound keeps the extra exchange to a few
    gigabytes; a larger table is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, NARROW_SCAN_SPLITS) else df


def scan_months(
    spark: SparkSession, root: str, country: str | None = None, months: Sequence[str] | None = None
) -> DataFrame:
    """Scan ``country=.../year_month=...`` folders; both filters prune folders."""
    df = spark.read.option("basePath", root).parquet(root)
    if country is not None:
        df = df.where(F.col("country") == country)
    if months is not None:
        df = df.where(F.col("year_month").isin(list(months)))
    return df


def scan_tree(
    spark: SparkSession, root: str, columns: Sequence[str] | None = None, partitions: Sequence[str] = ()
) -> DataFrame:
    """Every Parquet file below a folder, whatever its depth; files may differ in columns.

    ``partitions`` names folders ``name=value`` on the way, at any depth, whose value becomes a
    column; it is NULL for files without that folder, unless they have the column themselves.
    """
    df = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", True)
        .parquet(root)
    )
    df = df.withColumns({p: folder_value(p, F.col(p) if p in df.columns else None) for p in partitions})
    return df.select(*columns) if columns else df


def folder_value(name: str, otherwise: Column | None = None) -> Column:
    """The value of a folder ``name=value`` in the path of the file that a row comes from."""
    found = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1), F.lit(""))
    value = F.nullif(F.url_decode(found), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.coalesce(value, otherwise.cast("string")) if otherwise is not None else value


def search_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column has the value; none when no file has the column."""
    return df.where(F.col(column) == value) if column in df.columns else df.where(F.lit(False))


def conform(df: DataFrame, schema: str | T.StructType, **stamps: Column) -> DataFrame:
    """Project to a fixed schema: cast what is there, NULL for the rest, drop extras.

    Text that cannot be cast becomes NULL. ``stamps`` sets columns outright.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = dict(df.dtypes)
    out = []
    for field in target:
        if field.name in stamps:
            col = stamps[field.name].cast(field.dataType)
        elif field.name not in have:
            col = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType.simpleString():
            col = F.col(field.name)
        elif isinstance(field.dataType, T.StringType) and have[field.name].startswith(("map", "struct", "array")):
            col = F.to_json(field.name)
        else:
            col = F.col(field.name).try_cast(field.dataType)
        out.append(col.alias(field.name))
    return df.select(*out)


def read_features(
    df: DataFrame, split: str | None = None, months: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One split or some months of a feature table, in one scan."""
    if split is not None:
        df = df.where(F.col("split_set") == split)
    if months is not None:
        df = df.where(F.col("year_month").isin(list(months)))
    return df.select(*columns) if columns else df
