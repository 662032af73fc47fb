"""Fact table of orders and the mart of disrupted orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.sequences import HOT_KEY_ROWS, hot_keys
from parcelpulse.operators.baselines import LEGS
from parcelpulse.session import staged

NO_LEG = "sin_disrupcion"


def item_summary(items: DataFrame, limit: int = HOT_KEY_ROWS) -> DataFrame:
    """Main seller and SKU, item totals, insurance and distinct SKUs of each order.

    What is needed of the lines is stored, as it is read twice: to see whether an order has more
    than ``limit`` lines, and to combine them. Ordinary orders are dealt out by order as they are,
    which is less than their lists of values would be, and take one aggregation. Hot orders go by way of their values.
    """
    columns = ["logistic_order_id", "sku", "seller_id", "quantity_number", "has_insurance"]
    items = staged(items.select(*columns), "item-lines", codec="zstd")
    hot = hot_keys(items, columns[:1], limit)
    if hot is None:
        return _items_at_once(items)
    cold = _items_at_once(null_safe_join(items, hot, columns[:1], "left_anti"))
    return cold.unionByName(_items_by_value(null_safe_join(items, hot, columns[:1], "left_semi")))


def _items_at_once(items: DataFrame) -> DataFrame:
    """One aggregation; the most frequent value is the smallest of equal ones, and NULL does not count."""
    return items.repartition("logistic_order_id").groupBy("logistic_order_id").agg(
        F.mode("seller_id", True).alias("main_seller_id"), F.mode("sku", True).alias("main_sku"),
        F.sum("quantity_number").alias("total_items"), F.bool_or("has_insurance").alias("has_insurance"),
        F.size(F.collect_set("sku")).cast("long").alias("distinct_skus"),
    )


def _items_by_value(items: DataFrame) -> DataFrame:
    """The same for orders with very many lines.

    Every line counts once for its SKU and once for its seller. Lines are combined per
    (order, SKU) and (order, seller) first, so that an order with very many lines is
    spread over tasks; one more aggregation per order gives all outputs.
    """
    sides = F.array(
        F.struct(F.lit("sku").alias("side"), F.col("sku").alias("value"),
                 F.col("quantity_number").alias("quantity"), F.col("has_insurance").alias("insured")),
        F.struct(F.lit("seller").alias("side"), F.col("seller_id").alias("value"),
                 F.lit(None).cast("double").alias("quantity"), F.lit(None).cast("boolean").alias("insured")),
    )
    part = (
        items.select("logistic_order_id", F.explode(sides).alias("s"))
        .groupBy("logistic_order_id", F.col("s.side").alias("side"), F.col("s.value").alias("value"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("s.quantity").alias("quantity"), F.bool_or("s.insured").alias("insured")
        )
    )

    def mode(side: str) -> Column:
        """Most frequent value, ties to the smallest; NULL does not count."""
        counted = (F.col("side") == side) & F.col("value").isNotNull()
        return F.min_by("value", F.when(counted, F.struct(-F.col("n"), F.col("value"))))

    return part.groupBy("logistic_order_id").agg(
        mode("seller").alias("main_seller_id"), mode("sku").alias("main_sku"),
        F.sum("quantity").alias("total_items"), F.bool_or("insured").alias("has_insurance"),
        F.count_if((F.col("side") == "sku") & F.col("value").isNotNull()).alias("distinct_skus"),
    )


def broken_leg() -> Column:
    """The leg that exceeded its p95.

    Depot and dispatch must also be at least as long as both other legs (a missing
    leg counts as 0); the last mile need not.
    """
    hours = {leg: F.col(c) for leg, c in LEGS.items()}
    late = {leg: h > F.col(f"p95_{leg}") for leg, h in hours.items()}
    zero = {leg: F.coalesce(h, F.lit(0.0)) for leg, h in hours.items()}

    def longest(leg: str) -> Column:
        others = [z for name, z in zero.items() if name != leg]
        return hours[leg] >= F.greatest(*others)

    return (
        F.when(late["deposito"] & longest("deposito"), "deposito")
        .when(late["despacho"] & longest("despacho"), "despacho")
        .when(late["ultima_milla"], "ultima_milla")
        .otherwise(NO_LEG)
    )


def fact_orders(timeline: DataFrame, baselines: DataFrame, items: DataFrame) -> DataFrame:
    """Timeline with deviations from the month's p95, broken leg, actor and disruption flag.

    ``baselines`` should be a staged table (one row per month): its true size then
    lets the planner broadcast it, so the orders are not shuffled by month.
    """
    p95 = baselines.select("year_month", *[f"p95_{leg}" for leg in LEGS])
    joined = timeline.join(p95, "year_month", "left").withColumn("tramo_disruptivo", broken_leg())
    leg = F.col("tramo_disruptivo")
    actor = (
        F.when(leg == "deposito", F.col("packed_by"))
        .when(leg == "despacho", F.col("dispatched_by"))
        .when(leg == "ultima_milla", F.col("completed_by"))
    )
    late_somewhere = [F.col(c) > F.col(f"p95_{name}") for name, c in LEGS.items()]
    disrupted = F.lit(False)
    for test in (F.col("is_stuck"), F.col("is_sla_breach"), *late_somewhere):
        disrupted = disrupted | F.coalesce(test, F.lit(False))
    items = items.select(
        "logistic_order_id", F.col("main_seller_id").alias("seller_id"), "main_sku", "total_items",
        "distinct_skus", "has_insurance",
    )
    return joined.join(items, "logistic_order_id", "left").select(
        "logistic_order_id", "source_order_type", "fulfillment_order_type", "year_month",
        "service_category", "is_click_and_collect", "is_high_season",
        *[f"{m}_by" for m in ("created", "packed", "dispatched", "completed", "cancelled")],
        *[f"{m}_at" for m in ("created", "packed", "dispatched", "completed", "cancelled")],
        "last_event_at", "last_state", "promised_date_to", "promised_date_from",
        *[f"is_{f}" for f in ("completed", "cancelled", "dispatched", "packed", "stuck", "sla_breach")],
        "hours_sla_delta",
        *[F.round(c, 2).alias(f"hours_{name}") for name, c in LEGS.items()],
        F.round("hours_total_cycle", 2).alias("hours_total"),
        *[F.round(F.col(c) - F.col(f"p95_{n}"), 2).alias(f"delta_{n}_vs_p95") for n, c in LEGS.items()],
        leg, actor.alias("actor_responsable"), disrupted.alias("is_disrupted"),
        "total_events", "total_actors", "total_event_types",
        "seller_id", "main_sku", "total_items", "distinct_skus", "has_insurance",
    )


# Severities in rising order.
SEVERITIES = ("media", "alta", "critica")


def order_disruptions(orders: DataFrame, late_hours: float = 48.0) -> DataFrame:
    """Disrupted orders with the type and severity of the disruption."""
    breach = F.coalesce("is_sla_breach", F.lit(False))
    leg = F.col("tramo_disruptivo")
    kind = F.when(F.col("is_stuck"), "orden_atascada").when(breach, "sla_breach")
    for name in LEGS:
        kind = kind.when(leg == name, f"demora_{name}")
    worst = F.greatest(*[F.coalesce(f"delta_{name}_vs_p95", F.lit(0.0)) for name in LEGS])
    level = (
        F.when(F.col("is_stuck"), "critica")
        .when(breach & (F.col("hours_sla_delta") > late_hours), "alta")
        .when(~breach & (worst > late_hours), "alta")
        .otherwise("media")
    )
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severidad")).cast("int")
    return (
        orders.where("is_disrupted")
        .withColumn("tipo_disrupcion", kind.otherwise("otro"))
        .withColumn("severidad", level)
        .withColumn("severity_rank", rank)
        .select(
            "logistic_order_id", "year_month", "source_order_type", "service_category", "is_high_season",
            "tramo_disruptivo", "actor_responsable", "tipo_disrupcion", "severidad", "severity_rank",
            *[f"hours_{n}" for n in (*LEGS, "total")], "hours_sla_delta",
            *[f"delta_{n}_vs_p95" for n in LEGS],
            "created_at", "dispatched_at", "completed_at", "promised_date_to",
            "seller_id", "main_sku", "total_items",
            "is_completed", "is_cancelled", "is_stuck", "is_sla_breach",
        )
    )


def ranked_for_review(disruptions: DataFrame, by_rank: bool = False) -> DataFrame:
    """Severity descending, then longest first; by name as stored, or by true rank."""
    first = F.col("severity_rank" if by_rank else "severidad").desc()
    return disruptions.orderBy(first, F.col("hours_total").desc_nulls_last())
