"""Staging: rename, type and filter the raw logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.times import parse_time
from parcelpulse.sources.schemas import JobVars


def _valid(df: DataFrame, country: str, time: str, order_id: str, vars: JobVars) -> DataFrame:
    """Focus country, readable time not before the first valid day, order id present.

    The time test goes through a cast and cannot prune files. Where the month folder
    is the month of the event itself, an equal test on the folder column does.
    """
    since = F.lit(vars.min_date).cast("timestamp_ntz")
    kept = df.where(
        (F.col(country) == vars.country) & (parse_time(F.col(time)) >= since) & F.col(order_id).isNotNull()
    )
    return kept.where(F.col("year_month") >= vars.min_date[:7]) if vars.folder_is_event_month else kept


def stg_events(raw: DataFrame, vars: JobVars) -> DataFrame:
    kept = _valid(raw, "h_country", "h_datetime", "h_logistic_order_id", vars).where(
        F.col("h_event_type").isNotNull()
    )
    renamed = {
        "h_logistic_order_id": "logistic_order_id", "h_source_order_id": "source_order_id",
        "d_logistic_order_id": "d_logistic_order_id", "h_event_type": "event_type",
        "h_entity_type": "entity_type", "h_country": "country", "h_commerce": "commerce",
    }
    tail = {
        "d_state": "order_state", "d_executed_by": "executed_by",
        "d_fulfillment_order_type": "fulfillment_order_type", "d_source_order_type": "source_order_type",
        "d_is_international": "is_international",
    }
    return kept.select(
        *[F.col(a).alias(b) for a, b in renamed.items()],
        parse_time(F.col("h_datetime")).alias("event_at"),
        parse_time(F.col("d_executed_at")).alias("executed_at"),
        parse_time(F.col("publish_time")).alias("published_at"),
        *[F.col(a).alias(b) for a, b in tail.items()],
        F.col("d_order_version").try_cast("int").alias("order_version"),
        "year_month",
    )


def stg_packages(raw: DataFrame, vars: JobVars) -> DataFrame:
    def promised(key: str) -> Column:
        return F.col("promised_date")[key]

    return _valid(raw, "country", "event_dt", "logistic_order_id", vars).select(
        "logistic_order_id", "shipment_id", "package_id", "event_type",
        parse_time(F.col("event_dt")).alias("event_at"),
        "country", "package_status",
        promised("dateTo").alias("promised_date_to"),
        promised("dateFrom").alias("promised_date_from"),
        promised("serviceCategory").alias("service_category"),
        promised("timeRangeFrom").alias("promised_time_from"),
        promised("timeRangeTo").alias("promised_time_to"),
        promised("collectAvailabilityDate").alias("collect_availability_date"),
        promised("collectAvailabilityDate").isNotNull().alias("is_click_and_collect"),
        "year_month",
    )


def stg_items(raw: DataFrame, vars: JobVars) -> DataFrame:
    return _valid(raw, "country", "event_dt", "logistic_order_id", vars).select(
        "logistic_order_id", "event_type",
        parse_time(F.col("event_dt")).alias("event_at"),
        "country",
        F.col("sku").cast("string").alias("sku"),
        F.col("seller_id").cast("string").alias("seller_id"),
        F.col("quantity.number").alias("quantity_number"),
        F.col("quantity.unit").alias("quantity_unit"),
        "reserved_quantity",
        F.coalesce(F.col("has_insurance") == 1, F.lit(False)).alias("has_insurance"),
        "year_month",
    )
