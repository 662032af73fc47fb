"""The layers as views and stored tables over one input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelpulse.operators import baselines as bl
from parcelpulse.operators import carriers as ca
from parcelpulse.operators import features as ft
from parcelpulse.operators import flow
from parcelpulse.operators import orders as fo
from parcelpulse.operators import staging as stg
from parcelpulse.operators import timeline as tl
from parcelpulse.operators.models import Fitted
from parcelpulse.session import drop_staged, staged, tune
from parcelpulse.sources import bindings as B
from parcelpulse.sources import schemas as S
from parcelpulse.sources.readers import conform, read_features

_OPEN: dict[tuple[str, str], "Warehouse"] = {}


class Warehouse:
    """Staging layers are lazy views; timeline, baselines and facts are stored once.

    Stored tables live in the shared folder for the life of the session, so that a
    layer used by several queries is computed once, and a lost executor costs no
    recomputation of what came before.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self.vars = B.VARS
        self._tables: dict[str, DataFrame] = {}
        self._rates: dict[str, DataFrame] | None = None
        self._models: dict[str, Fitted] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = staged(build(), name, codec="zstd")
        return self._tables[name]

    def source(self, name: str) -> DataFrame:
        return B.table(self.spark, self.sf_dir, name)

    @property
    def stg_events(self) -> DataFrame:
        return stg.stg_events(B.raw_events(self.spark, self.sf_dir), self.vars)

    @property
    def stg_packages(self) -> DataFrame:
        return stg.stg_packages(B.raw_packages(self.spark, self.sf_dir), self.vars)

    @property
    def stg_items(self) -> DataFrame:
        return stg.stg_items(B.raw_items(self.spark, self.sf_dir), self.vars)

    @property
    def package_events(self) -> DataFrame:
        return B.package_events(self.spark, self.sf_dir)

    @property
    def package_log(self) -> DataFrame:
        """The raw package log conformed to the columns of the status log."""
        return conform(B.raw_packages(self.spark, self.sf_dir), S.PACKAGE_EVENTS)

    @property
    def timeline(self) -> DataFrame:
        return self.stored(
            "timeline",
            lambda: tl.order_timeline(self.stg_events, self.stg_packages, self.vars.high_season),
        )

    @property
    def baselines(self) -> DataFrame:
        return self.stored("baselines", lambda: bl.stage_baselines(self.timeline))

    @property
    def orders(self) -> DataFrame:
        return self.stored(
            "fact-orders",
            lambda: fo.fact_orders(self.timeline, self.baselines, fo.item_summary(self.stg_items)),
        )

    @property
    def disruptions(self) -> DataFrame:
        return fo.order_disruptions(self.orders)

    @property
    def dataset(self) -> DataFrame:
        return ft.ml_dataset(self.orders, B.SPLITS)

    @property
    def train(self) -> DataFrame:
        return read_features(self.dataset, split="train")

    @property
    def rates(self) -> dict[str, DataFrame]:
        if self._rates is None:
            self._rates = ft.rate_tables(self.train)
        return self._rates

    @property
    def history(self) -> DataFrame:
        return ft.historical_features(self.dataset, self.rates)

    @property
    def dataset_with_history(self) -> DataFrame:
        return self.stored("dataset", lambda: ft.with_rates(self.dataset, self.rates))

    @property
    def flow(self) -> DataFrame:
        return self.stored("flow", lambda: flow.flow_features(self.package_events))

    @property
    def dataset_with_flow(self) -> DataFrame:
        return flow.attach_flow(self.dataset_with_history, self.flow)

    @property
    def envelopes(self) -> DataFrame:
        return B.carrier_envelopes(self.spark, self.sf_dir)

    @property
    def carriers(self) -> DataFrame:
        """One row per envelope with a carrier: parsing JSON is dear, so it is stored."""
        return self.stored("carriers", lambda: ca.first_carrier(self.envelopes, self.vars.country))

    @property
    def carrier_per_order(self) -> DataFrame:
        return ca.carrier_per_order(self.carriers)

    def model(self, name: str, build: Callable[[], Fitted]) -> Fitted:
        if name not in self._models:
            self._models[name] = build()
        return self._models[name]


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this session and folder; stored tables are kept between calls."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, sf_dir)
    return _OPEN[key]


def close_warehouses() -> None:
    """Forget stored tables and delete their files, so that the next query computes them again."""
    for spark in {id(w.spark): w.spark for w in _OPEN.values()}.values():
        drop_staged(spark)
    _OPEN.clear()
