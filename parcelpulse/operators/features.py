"""Feature tables for the risk models: creation features, labels and historical rates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.text import strip
from parcelpulse.functions.times import day_band, hours_between, weekday
from parcelpulse.operators.orders import NO_LEG
from parcelpulse.session import staged


@dataclass(frozen=True)
class SplitRule:
    """Months before ``val_from`` train, before ``test_from`` validate, the rest test."""

    val_from: str = "2025-12"
    test_from: str = "2026-02"

    def column(self, month: Column) -> Column:
        return F.when(month < self.val_from, "train").when(month < self.test_from, "val").otherwise("test")


def ml_dataset(orders: DataFrame, split: SplitRule, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of the facts: what is known at creation, the labels, and the columns in ``keep``."""
    created = F.col("created_at")
    flags = ["is_click_and_collect", "is_high_season", "has_insurance"]
    return orders.select(
        "logistic_order_id", "year_month", split.column(F.col("year_month")).alias("split_set"),
        *[F.col(f).cast("int").alias(f) for f in flags],
        "total_items", "distinct_skus",
        weekday(created).alias("dia_semana_creacion"),
        F.hour(created).alias("hora_creacion"),
        F.dayofmonth(created).alias("dia_mes_creacion"),
        hours_between(created, F.col("promised_date_to")).alias("sla_horas_prometidas"),
        "service_category", "source_order_type", "seller_id", "created_by",
        F.when(created.isNotNull(), day_band(F.hour(created))).alias("franja_horaria"),
        F.col("is_disrupted").cast("int").alias("target_binario"),
        F.col("tramo_disruptivo").alias("target_tramo"),
        F.col("actor_responsable").alias("target_actor"),
        F.col("hours_total").alias("target_horas_totales"),
        F.col("hours_total").isNotNull().cast("int").alias("ciclo_completo"),
        *keep,
    )


def one_per_order(dataset: DataFrame) -> DataFrame:
    """The latest row of each order, of two of one month the one of the largest type.

    An order has a row per month and type it has events of; what is looked up by its id alone needs one.
    """
    rest = [c for c in dataset.columns if c != "logistic_order_id"]
    order = F.struct("year_month", "source_order_type", F.xxhash64(*rest))
    latest = dataset.groupBy("logistic_order_id").agg(F.max_by(F.struct(*rest), order).alias("r"))
    return latest.select("logistic_order_id", "r.*").select(*dataset.columns)


# Historical rates: output column, grouping columns.
RATES: dict[str, list[str]] = {
    "seller_tasa_disrupcion": ["seller_id"],
    "categoria_tasa_disrupcion": ["service_category"],
    "categoria_cac_tasa_disrupcion": ["service_category", "is_click_and_collect"],
    "dia_semana_tasa_disrupcion": ["dia_semana_creacion"],
    "franja_tasa_disrupcion": ["franja_horaria"],
}


def rate_tables(train: DataFrame) -> dict[str, DataFrame]:
    """Disruption rate per key, from the training rows only; stored, so their size is known."""
    out = {}
    for name, keys in RATES.items():
        rate = F.avg(F.col("target_binario").cast("double")).alias(name)
        extra = [F.count(F.lit(1)).alias("seller_n_ordenes")] if keys == ["seller_id"] else []
        present = train
        for k in keys:
            present = present.where(F.col(k).isNotNull())
        out[name] = staged(present.groupBy(*keys).agg(*extra, rate), f"rate-{name}")
    return out


def historical_features(dataset: DataFrame, rates: dict[str, DataFrame]) -> DataFrame:
    """Rates of each order's seller, category, weekday and band; NULL for unseen keys.

    Each rate table is a staged table, broadcast by the planner when its files are
    small. A seller table too large for that is joined by shuffle, where a seller
    with very many orders is split by the adaptive skew join.
    """
    df = with_rates(dataset, rates)
    return df.select("logistic_order_id", "year_month", "seller_n_ordenes", "franja_horaria", *RATES)


def with_rates(dataset: DataFrame, rates: dict[str, DataFrame]) -> DataFrame:
    """All columns of the dataset with its rates: each row gets its own, whatever its key, and none is doubled."""
    df = dataset
    for name, on in RATES.items():
        df = df.join(rates[name], on, "left")
    return df.select(*dataset.columns, "seller_n_ordenes", *RATES)


def dataset_with_history(dataset: DataFrame, history: DataFrame) -> DataFrame:
    """Inner join of a history that is another table; columns both sides have are taken from the dataset.

    The history must have one row per order and month. Rates of the dataset's own rows need no join: ``with_rates``.
    """
    extra = [c for c in history.columns if c not in dataset.columns]
    return null_safe_join(
        dataset, history.select("logistic_order_id", "year_month", *extra), ["logistic_order_id", "year_month"]
    )


def leg_population(orders: DataFrame, split: SplitRule, columns: Sequence[str]) -> DataFrame:
    """Completed orders with a leg label, with the hours of each leg.

    Features, label and hours come from one row of the facts, so nothing is joined and no row doubled
    where an order has two types in one month.
    """
    known = ml_dataset(orders.where(F.col("hours_total") > 0), split, columns)
    return known.where((F.col("ciclo_completo") == 1) & F.col("target_tramo").isNotNull())


def hours_population(dataset: DataFrame) -> DataFrame:
    """Completed orders with a positive total, and their deviation from the promise."""
    return dataset.where(
        (F.col("ciclo_completo") == 1) & F.col("target_horas_totales").isNotNull() & (F.col("target_horas_totales") > 0)
    ).withColumn("desvio_sla", F.col("target_horas_totales") - F.col("sla_horas_prometidas"))


def leg_class(leg: Column) -> Column:
    """Three classes of the leg label."""
    text = strip(leg)
    low = F.lower(text)
    none = leg.isNull() | text.isin("", "nan", "None") | low.isin(NO_LEG, "sin disrupcion")
    return F.when(none, NO_LEG).when(low.contains("milla"), "ultima_milla").otherwise("deposito_despacho")
