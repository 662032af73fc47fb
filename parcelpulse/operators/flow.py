"""Features of an order's sequence of package events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.sequences import HOT_KEY_ROWS, gap_hours, previous, sequence
from parcelpulse.functions.times import hours_between, parse_iso
from parcelpulse.sources import schemas as S

EVER = {
    "tuvo_delivery_attempted": S.DELIVERY_ATTEMPTED,
    "tuvo_exception": S.EXCEPTION,
    "tuvo_annulled": S.ANNULLED,
}
NOW = {
    "esta_en_transito": S.IN_TRANSIT,
    "esta_out_for_delivery": S.OUT_FOR_DELIVERY,
    "esta_shipment_confirmed": S.SHIPMENT_CONFIRMED,
}
REACHED = {
    "horas_a_shipment_confirmed": S.SHIPMENT_CONFIRMED,
    "horas_a_out_for_delivery": S.OUT_FOR_DELIVERY,
}


def last_status_flags(status: Column) -> list[Column]:
    return [F.coalesce((status == s).cast("int"), F.lit(0)).alias(name) for name, s in NOW.items()]


def flow_features(
    events: DataFrame, key: Sequence[str] = ("logistic_order_id",), ties: Sequence[str] = ("event_id",),
    limit: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Twelve numbers and the last status per order, from its events in time order.

    Only the largest gap needs neighbouring events. The mean gap is the whole span
    over the number of gaps, since sorted times leave no negative gap to drop. To
    match the month-wise view of an order, add ``year_month`` to ``key``.
    """
    clean = events.where(F.col(key[0]).isNotNull() & F.col("event_dt").isNotNull()).select(
        *key, "event_dt", "package_status", *ties
    )
    seq = previous(sequence(clean, key, "event_dt", ties, limit), ["event_dt"])
    status, at = F.col("package_status"), F.col("event_dt")
    agg = seq.df.groupBy(*key).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        *[F.min(F.when(status == s, at)).alias(f"at_{n}") for n, s in REACHED.items()],
        F.coalesce(F.max(gap_hours(F.col("prev_event_dt"), at)), F.lit(0.0)).alias("horas_entre_eventos_max"),
        F.count(F.lit(1)).alias("n_eventos_total"),
        F.count_distinct(status).alias("n_estados_distintos"),
        *[F.coalesce(F.max((status == s).cast("int")), F.lit(0)).alias(n) for n, s in EVER.items()],
        F.max_by(F.struct(status), F.struct(at, *ties)).alias("last"),
    )
    last = F.col("last.package_status")
    gaps = F.col("n_eventos_total") - 1
    return agg.select(
        *key,
        *[F.coalesce(hours_between(F.col("first_at"), F.col(f"at_{n}")), F.lit(-1.0)).alias(n) for n in REACHED],
        "horas_entre_eventos_max",
        F.when(gaps > 0, hours_between(F.col("first_at"), F.col("last_at")) / gaps).otherwise(0.0)
        .alias("horas_entre_eventos_avg"),
        "n_eventos_total", "n_estados_distintos", *EVER, *last_status_flags(last), last.alias("ultimo_estado"),
    )


def attach_flow(base: DataFrame, flow: DataFrame, key: Sequence[str] = ("logistic_order_id",)) -> DataFrame:
    """Left join; an order without events gets -1 everywhere and an unknown last status."""
    return base.join(flow, list(key), "left").fillna(-1, S.FLOW_NUMERIC).fillna(S.UNKNOWN, ["ultimo_estado"])


def flow_from_array(df: DataFrame, events: str = "eventos") -> DataFrame:
    """The same features from an array of (timestamp, estado) given in one row.

    The array is taken in the order given, so gaps may be negative; these are left
    out. An empty or missing array yields the vector of an order before its first
    event. An array is one row's value, hence bounded, and stays in its row.
    """
    times = F.transform(events, lambda e: parse_iso(e["timestamp"]))
    states = F.transform(events, lambda e: e["estado"])
    df = df.withColumn("__t", times).withColumn("__s", states).withColumn(
        "__n", F.coalesce(F.size(events), F.lit(0))
    )
    df = df.withColumn("__n", F.when(F.col("__n") < 0, 0).otherwise(F.col("__n")))
    t, s, n = F.col("__t"), F.col("__s"), F.col("__n")
    some = n > 0
    pairs = F.zip_with(
        F.slice(t, 1, F.greatest(n - 1, F.lit(0))), F.slice(t, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: hours_between(a, b),
    )
    # a column of its own: in the branches below it would be computed once for each use
    df = df.withColumn("__gaps", F.filter(pairs, lambda g: g >= 0))
    gaps = F.col("__gaps")
    first = F.get(t, F.lit(0))

    def reached(state: str) -> Column:
        at = F.array_position(s, state).cast("int")
        return F.when(at > 0, hours_between(first, F.get(t, at - 1))).otherwise(-1.0)

    total = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)
    n_gaps = F.size(gaps)
    last = F.when(some, F.get(s, n - 1)).otherwise(S.SHIPMENT_CONFIRMED)
    none = F.lit(-1.0)
    return df.select(
        *[c for c in df.columns if not c.startswith("__")],
        *[F.when(some, reached(state)).otherwise(none).alias(n_) for n_, state in REACHED.items()],
        F.when(~some, none).when(n_gaps > 0, F.array_max(gaps)).otherwise(0.0).alias("horas_entre_eventos_max"),
        F.when(~some, none).when(n_gaps > 0, total / n_gaps).otherwise(0.0).alias("horas_entre_eventos_avg"),
        n.cast("long").alias("n_eventos_total"),
        F.when(some, F.size(F.array_distinct(s))).otherwise(1).cast("long").alias("n_estados_distintos"),
        *[F.coalesce(F.array_contains(s, st) & some, F.lit(False)).cast("int").alias(n_) for n_, st in EVER.items()],
        *[F.when(some, F.coalesce((last == st).cast("int"), F.lit(0))).otherwise(0).alias(n_) for n_, st in NOW.items()],
        last.alias("ultimo_estado"),
    )
