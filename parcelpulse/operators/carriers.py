"""Carrier of an order, from JSON envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.text import strip
from parcelpulse.session import staged
from parcelpulse.sources import schemas as S
from parcelpulse.sources import versions


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """Event type, order and country of the header ('' when unreadable), and the data text.

    The header is parsed once per row: as a generator it is not copied into later filters.
    """
    names = ["eventType", "logisticOrderId", "country"]
    rest = [c for c in raw.columns if c != "header"]
    parsed = raw.select(*rest, F.json_tuple("header", *names).alias("__e", "__o", "__c"))
    return parsed.select(
        *rest,
        F.coalesce("__e", F.lit("")).alias("event_type"),
        F.coalesce("__o", F.lit("")).alias("logistic_order_id"),
        F.coalesce("__c", F.lit("")).alias("country"),
    )


def first_carrier(envelopes: DataFrame, country: str | None, event_type: str = S.STATE_CHANGED) -> DataFrame:
    """First non-blank carrier of each envelope in document order; rows without one are left out.

    The rows are filtered on the header before the larger data text is parsed, once per row.
    """
    kept = parse_envelopes(envelopes).where((F.col("event_type") == event_type) & (F.col("logistic_order_id") != ""))
    if country is not None:
        kept = kept.where(F.col("country") == country)
    items = F.from_json("data", S.ENVELOPE_DATA)["orderItems"]
    packages = F.flatten(F.flatten(F.transform(
        items,
        lambda i: F.transform(
            F.coalesce(i["states"], F.array()), lambda s: F.coalesce(s["packagesInfo"], F.array())
        ),
    )))
    named = F.filter(packages, lambda p: strip(p["trackingData"]["carrierCode"]) != "")
    carrier = F.transform(
        F.slice(named, 1, 1),
        lambda p: F.struct(
            strip(p["trackingData"]["carrierCode"]).alias("carrier_code"),
            strip(F.coalesce(p["trackingData"]["carrierName"], p["trackingData"]["carrierCode"])).alias("carrier_name"),
        ),
    )
    rest = [c for c in kept.columns if c != "data"]
    return kept.select(*rest, F.inline(carrier))


def carrier_per_order(
    carriers: DataFrame, seen: str = "seen", key: Sequence[str] = ("logistic_order_id",), name_of_code: bool = True
) -> DataFrame:
    """Most frequent carrier of each order; ties go to the code seen first, then by code.

    The name is the first one seen with that code, or with ``name_of_code=False`` the
    first one seen with any code.
    """
    order = F.struct(seen, "carrier_code", "carrier_name")
    per_code = carriers.groupBy(*key, "carrier_code").agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.min("year_month").alias("first_month")
    )
    best = per_code.groupBy(*key).agg(
        F.min(F.struct((-F.col("n")).alias("minus_n"), "first")).alias("best"),
        F.min("first").alias("first"), F.min("first_month").alias("first_month"), F.sum("n").alias("n_envelopes"),
    )
    name = F.col("best.first.carrier_name") if name_of_code else F.col("first.carrier_name")
    rest = [F.col("first_month").alias("year_month")] if "year_month" not in key else []
    return best.select(
        *key, F.col("best.first.carrier_code").alias("carrier_code"), name.alias("carrier_name"), *rest, "n_envelopes"
    )


def carrier_state(carriers: DataFrame, seen: str = "seen") -> DataFrame:
    """What can be merged: per order, month and code the number of envelopes and the first one seen."""
    first = F.struct(F.col(seen).alias("seen"), "carrier_code", "carrier_name")
    return carriers.groupBy("logistic_order_id", "year_month", "carrier_code").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))


def carriers_of_state(state: DataFrame) -> DataFrame:
    """``carrier_per_order`` from states of any months."""
    per_code = state.groupBy("logistic_order_id", "carrier_code").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.min("year_month").alias("first_month")
    )
    best = per_code.groupBy("logistic_order_id").agg(
        F.min(F.struct((-F.col("n")).alias("minus_n"), "first")).alias("best"), F.min("first_month").alias("year_month"), F.sum("n").alias("n_envelopes")
    )
    return best.select("logistic_order_id", "best.first.carrier_code", "best.first.carrier_name", "year_month", "n_envelopes")


def load_carrier_months(carriers: DataFrame, path: str, reloaded: Sequence[str] = (), seen: str = "seen") -> DataFrame:
    """Put the months of ``carriers`` into the stored state, all or nothing, and return the new rows of touched orders.

    Touched are the orders with an envelope in these months now or before; an order that lost its last one comes
    back with nulls. Envelopes of other months are not read again, only their states.
    """
    spark = carriers.sparkSession
    state = staged(carrier_state(carriers, seen), "carrier-state")
    months = sorted({*reloaded, *[r[0] for r in state.select("year_month").distinct().collect()]})  # months, no rows
    before = staged(versions.read_months(spark, path, state.schema, months).select("logistic_order_id"), "carrier-before")
    versions.reload_months(state, path, months)
    touched = staged(before.unionByName(state.select("logistic_order_id")).distinct(), "carrier-touched")
    whole = versions.read_months(spark, path, state.schema).join(touched, "logistic_order_id", "left_semi")
    return touched.join(carriers_of_state(whole), "logistic_order_id", "left")


def carrier_earliest_month(carriers: DataFrame, seen: str = "seen") -> DataFrame:
    """Mode per order and month, then the earliest month wins."""
    monthly = carrier_per_order(carriers, seen, ("logistic_order_id", "year_month"))
    return monthly.groupBy("logistic_order_id").agg(
        F.min_by("carrier_code", "year_month").alias("carrier_code"),
        F.min_by("carrier_name", "year_month").alias("carrier_name"),
        F.min("year_month").alias("year_month"),
    )


def attach_carrier(base: DataFrame, carriers: DataFrame) -> DataFrame:
    joined = base.join(carriers.select("logistic_order_id", "carrier_code"), "logistic_order_id", "left")
    return joined.fillna(S.UNKNOWN, ["carrier_code"])


def carrier_coverage(base: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of orders whose carrier is known."""
    known = F.col("carrier_code") != S.UNKNOWN
    return base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(known).alias("n_known"),
        F.round(F.avg(F.when(known, 100.0).otherwise(0.0)), 2).alias("pct_known"),
    )


def top_carriers(per_order: DataFrame, k: int = 10) -> DataFrame:
    """The k carriers with most orders, and the number of all orders with a carrier."""
    counts = per_order.groupBy("carrier_code", "carrier_name").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), "carrier_code", F.col("carrier_name").asc_nulls_first()).limit(k)
    return top.withColumn("n_total", per_order.agg(F.count(F.lit(1)).alias("n_total")).scalar())
