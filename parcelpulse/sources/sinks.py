"""Month loads, upserts and text sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.session import staged


def reload_months(df: DataFrame, path: str, months: str = "year_month", reloaded: Sequence[str] | None = None) -> None:
    """Replace the months present in df, and of the months named in ``reloaded`` those without rows too.

    Other months stay as they are. A month named but absent from df has no rows afterwards. The
    rebalance gives each month few files, and splits a month too large for one task.
    """
    (
        df.hint("rebalance", months).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(months)
        .parquet(path)
    )
    if reloaded is None:
        return
    spark = df.sparkSession
    there = df.where(F.col(months).isin(list(reloaded))).select(months).distinct().collect()  # months, no rows
    for month in sorted(set(reloaded) - {r[0] for r in there}):
        _clear(spark, f"{path}/{months}={month}")


def _clear(spark: SparkSession, folder: str) -> None:
    """Remove one partition's folder through the file system it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def loaded_months(spark: SparkSession, path: str, schema: T.StructType, months: str = "year_month") -> DataFrame:
    """Distinct months of a loaded table; reads folder names only."""
    return spark.read.schema(schema).parquet(path).select(months).distinct()


def missing_months(df: DataFrame, loaded: DataFrame, months: str = "year_month") -> DataFrame:
    """Rows of the months that the target does not have yet."""
    return df.join(loaded, months, "left_anti")


def append_missing_months(df: DataFrame, path: str, months: str = "year_month") -> None:
    """Append only months not yet loaded. The month list is fixed before anything is written."""
    todo = missing_months(df, staged(loaded_months(df.sparkSession, path, df.schema, months), "months"), months)
    todo.hint("rebalance", months).write.mode("append").partitionBy(months).parquet(path)


def first_rows(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order; combines on the map side."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.min_by(F.struct(*rest), F.struct(*order_by)).alias("__row")
    )
    return picked.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def insert_if_absent(
    new: DataFrame, target: DataFrame | None, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows to append: the first of each key, unless the target has the key."""
    firsts = first_rows(new, key, order_by)
    return firsts if target is None else firsts.join(target.select(*key), list(key), "left_anti")


def flatten_nested(df: DataFrame) -> DataFrame:
    """Maps, structs and arrays as JSON text, for sinks with flat columns."""
    nested = (T.MapType, T.StructType, T.ArrayType)
    return df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def relational_type(kind: T.DataType) -> str:
    """Column type of a relational sink for a Spark type."""
    fixed: Mapping[type, str] = {
        T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
        T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
        T.TimestampType: "TIMESTAMPTZ", T.TimestampNTZType: "TIMESTAMP",
    }
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    if isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
        return "JSONB"
    return fixed.get(type(kind), "TEXT")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


NULL_MARK = "\\N"


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated lines without a header, ``\\N`` for NULL, texts quoted and their quotes doubled.

    A text with a tab, a newline or a quote and an empty one come back as they are. A text that
    reads like the NULL mark, which readers take for NULL even in quotes, gets a backslash more.
    """
    flat = flatten_nested(df)
    fields = [F.coalesce(_field(f), F.lit(NULL_MARK)) for f in flat.schema]
    flat.select(F.concat_ws("\t", *fields)).write.mode("overwrite").text(path)


def _field(field: T.StructField) -> Column:
    value = F.col(field.name).cast("string")
    if not isinstance(field.dataType, T.StringType):
        return value
    value = F.when(value.rlike(r"\A\\+N\z"), F.concat(F.lit("\\"), value)).otherwise(value)
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of ``write_tsv``; a record may run over several lines."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = (
        spark.read.schema(texts).option("sep", "\t").option("lineSep", "\n").option("multiLine", True).option("quote", '"')
        .option("escape", '"').option("nullValue", NULL_MARK).option("emptyValue", "").option("maxCharsPerColumn", -1)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    out = []
    for f in schema:
        value = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            value = F.when(value.rlike(r"\A\\{2,}N\z"), F.substring(value, 2, 1 << 30)).otherwise(value)
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def upsert_first(new: DataFrame, path: str, key: Sequence[str], order_by: Sequence[str], reload: bool = False) -> None:
    """Append the first row of each key that the stored table does not have; ``reload`` empties it before."""
    spark = new.sparkSession
    target = None if reload or not _has_parts(spark, path) else spark.read.parquet(path)
    rows = insert_if_absent(new, target, key, order_by)
    # staged: what is appended is fixed before the table that it was compared with changes
    staged(rows, "upsert").write.mode("overwrite" if target is None else "append").parquet(path)


BUCKET = "bucket"


def upsert_first_bucketed(new: DataFrame, path: str, key: Sequence[str], order_by: Sequence[str], buckets: int = 256) -> list[int]:
    """``upsert_first`` into a table in buckets by key, of which only those that new keys fall into are read.

    A key's bucket is a digest of it, so a bucket holds about the same share of any keys, and a load of few keys
    reads few buckets however large the table is. The numbers of the buckets touched, at most ``buckets``, come
    to the driver and prune the folders. Returns them. Null keys are kept like others.
    """
    spark = new.sparkSession
    rows = staged(first_rows(new, key, order_by).withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")), "upsert-new")
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
    if _has_parts(spark, path):
        known = read_buckets(spark, path, rows.schema, touched).select(BUCKET, *key).withColumn("__known", F.lit(True))
        rows = null_safe_join(rows, known, [BUCKET, *key], "left").where("__known is null").drop("__known")
        rows = staged(rows, "upsert")
    rows.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    return touched


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
    table = spark.read.schema(schema).parquet(path)
    return table if only is None else table.where(F.col(BUCKET).isin(list(only)))


def write_json_sets(sets: Mapping[str, DataFrame], path: str) -> None:
    """Several result sets side by side, one folder of JSON lines each."""
    for name, df in sets.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def replace_predictions(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "split_set").write.mode("overwrite").partitionBy("split_set").parquet(path)


def run_once(spark: SparkSession, path: str, name: str, build: Callable[[], DataFrame]) -> None:
    """Append the rows of an experiment unless its folder is already there."""
    done = spark.read.parquet(path).where(F.col("experimento") == name) if _has_parts(spark, path) else None
    if done is None or done.isEmpty():
        rows = build().withColumn("experimento", F.lit(name))
        rows.write.mode("append").partitionBy("experimento").parquet(path)


def _has_parts(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, path: str, months: str | None = "year_month", sort: Column | None = None) -> DataFrame:
    """Store a layer as Parquet by month, sorted within files so that min/max skip row groups."""
    out = df.hint("rebalance", months) if months else df
    out = out.sortWithinPartitions(*([months] if months else []), sort) if sort is not None else out
    writer = out.write.mode("overwrite")
    if months:
        writer = writer.partitionBy(months)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
