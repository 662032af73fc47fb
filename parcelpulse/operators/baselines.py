"""Monthly percentile baselines of each leg."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.ordered import percentile_name, percentiles

LEGS = {
    "deposito": "hours_created_to_packed",
    "despacho": "hours_packed_to_dispatched",
    "ultima_milla": "hours_dispatched_to_completed",
}
LEG_PROBS = (0.50, 0.75, 0.90, 0.95)
TOTAL_PROBS = (0.50, 0.90, 0.95)


def stage_baselines(timeline: DataFrame, max_cycle: float = 720.0) -> DataFrame:
    """Percentiles over completed orders outside high season, plus the breach rate."""
    base = timeline.where(
        F.col("is_completed") & ~F.col("is_high_season")
        & F.col("hours_total_cycle").between(0.0, max_cycle)
        & F.col("hours_created_to_packed").isNotNull()
    )
    measures = {leg: F.col(c) for leg, c in LEGS.items()} | {"total": F.col("hours_total_cycle")}
    probs = dict.fromkeys(LEGS, LEG_PROBS) | {"total": TOTAL_PROBS}
    stats = percentiles(base, ["year_month"], measures, probs)
    # an unknown breach counts in the base but not as a breach
    breached = F.sum(F.when(F.col("is_sla_breach"), 1.0).otherwise(0.0))
    rates = base.groupBy("year_month").agg(
        F.round(100.0 * breached / F.count(F.lit(1)), 2).alias("pct_sla_breach"),
        F.count(F.lit(1)).alias("ordenes_base"),
    )
    named = [
        F.col(percentile_name(m, p)).alias(f"p{round(p * 100)}_{m}") for m, ps in probs.items() for p in ps
    ]
    return rates.join(stats, "year_month").select("year_month", *named, "pct_sla_breach", "ordenes_base")
