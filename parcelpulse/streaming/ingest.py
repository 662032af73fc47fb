"""Loading files that were not loaded before, as a file stream that ends when caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelpulse.sources.readers import conform, folder_value


def load_new_files(
    spark: SparkSession, source: str, target: str, progress: str, source_schema: T.StructType,
    target_schema: str | T.StructType, months: str = "year_month", time: str = "event_dt",
) -> StreamingQuery:
    """Append the rows of new files to the month folders of the target, once each.

    ``progress`` records the files already taken, so a second call loads only what has
    arrived since, and a call cut short goes on where it stopped. A batch that is
    repeated after a failure replaces its own output.
    """
    target_type = T.StructType.fromDDL(target_schema) if isinstance(target_schema, str) else target_schema
    stream = (
        spark.readStream.schema(source_schema).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").parquet(source)
    )
    # the month of a source folder is the file's month; only files outside of such folders go by event
    own = F.col(months) if months in source_schema.names else None
    stream = stream.withColumn(months, folder_value(months, own))

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = conform(batch, target_type)
        stamped = stamped.withColumn(
            months, F.coalesce(F.col(months), F.date_format(time, "yyyy-MM"))
        ).withColumn("load_batch", F.lit(batch_id))
        (
            stamped.hint("rebalance", months).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(months, "load_batch").parquet(target)
        )

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
    return query
