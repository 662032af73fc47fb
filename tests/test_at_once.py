"""Ordinary keys are combined in one aggregation, hot ones by their values, with the same results."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from parcelpulse.functions.sequences import hot_keys
from parcelpulse.operators import orders, timeline
from parcelpulse.plans import catalog
from parcelpulse.plans.warehouse import Warehouse
from parcelpulse.sources import schemas as S

EVENT = "logistic_order_id string, source_order_type string, fulfillment_order_type string, year_month string, " \
        "event_at timestamp_ntz, event_type string, order_state string, executed_by string"
LINE = "logistic_order_id string, sku string, seller_id string, quantity_number double, has_insurance boolean"


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    kinds = [S.CREATED, S.PACKED, S.DISPATCHED, S.ITEM_DISPATCHED, S.ANNULLED_ITEMS, "OTHER"]
    rows = []
    for i in range(900):
        order = rng.choice(["hot", "hot", None, f"o{rng.randrange(40)}"])
        at = dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randrange(60))
        rows.append((order, rng.choice(["A", None]), "F", "2025-01", at, rng.choice(kinds), rng.choice(["NEW", S.COMPLETED, "ZZ", None]), rng.choice(["x", "y", f"z{i}", None])))
    return spark.createDataFrame(rows, EVENT).repartition(3)


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice(["hot", "hot", None, f"o{rng.randrange(40)}"]), rng.choice(["a", "b", "c", None]), rng.choice(["s", "t", None]),
         rng.choice([1.0, 2.0, None]), rng.choice([True, False, None]))
        for _ in range(600)
    ]
    return spark.createDataFrame(rows, LINE).repartition(3)


@pytest.mark.parametrize("limit", [1, 20, 1000])
def test_milestones_of_hot_and_other_keys(events, limit):
    by_trait = timeline._milestones_by_trait(events, timeline.MILESTONES, timeline.ORDER_KEYS)
    got = timeline.milestones(events, limit=limit)
    assert got.dtypes == by_trait.dtypes
    assert _sorted(got) == _sorted(by_trait)


@pytest.fixture(scope="module")
def few_names(spark):
    """Types, states and 100 actors, few enough to be numbered, with nulls in every column and order types in other letters."""
    rng = random.Random(5)
    kinds = [S.CREATED, S.PACKED, S.DISPATCHED, S.ITEM_DISPATCHED, S.ANNULLED_ITEMS, "OTHER", None]
    rows = []
    for _ in range(1500):
        at = dt.datetime(1969, 12, 30) + dt.timedelta(hours=rng.randrange(60), microseconds=rng.choice([0, 1]))
        actor = rng.choice([None, "é", "Z", "\U0001f600", "\uffee", *[f"a{i:03d}" for i in range(96)]])
        state = rng.choice(["NEW", S.COMPLETED, "ZZ", "é", None])
        order = rng.choice(["hot", None, f"o{rng.randrange(60)}", "quiet"])
        if order == "quiet":
            actor = state = None
        rows.append((order, rng.choice(["A", None]), "F", rng.choice(["2025-01", None]), rng.choice([at, at, at, None]), rng.choice(kinds), state, actor))
    return spark.createDataFrame(rows, EVENT).repartition(3)


@pytest.mark.parametrize("keys", [timeline.ORDER_KEYS, ("logistic_order_id",)])
def test_few_names_are_aggregated_as_numbers(few_names, keys):
    """In buffers that are hashed: nothing is sorted or held as objects, so nothing spills as it grows."""
    got, sets = timeline.milestones(few_names, keys=keys), timeline._milestones_at_once(few_names, timeline.MILESTONES, keys)
    assert got.dtypes == sets.dtypes
    assert _sorted(got) == _sorted(sets)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_many_names_and_far_times_are_not_numbered(spark, events, few_names):
    assert timeline._few_traits(events) is None  # an actor to each event
    assert len(timeline._few_traits(few_names)["executed_by"]) == 100
    far = few_names.limit(1).withColumn("event_at", F.lit("+20000-01-01 00:00:00").cast("timestamp_ntz"))
    assert timeline._few_traits(few_names.unionByName(far)) is None
    none = timeline.milestones(few_names.limit(0))
    assert none.dtypes == timeline._milestones_at_once(few_names, timeline.MILESTONES, timeline.ORDER_KEYS).dtypes and none.isEmpty()


@pytest.mark.parametrize("limit", [1, 20, 1000])
def test_items_of_hot_and_other_orders(lines, limit):
    got, by_value = orders.item_summary(lines, limit=limit), orders._items_by_value(lines)
    assert got.dtypes == by_value.dtypes
    assert _sorted(got) == _sorted(by_value)


def test_ordinary_keys_are_shuffled_once(events, lines):
    for df in (timeline.milestones(events), orders.item_summary(lines)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_hot_keys_are_those_above_the_limit(events):
    key = ["logistic_order_id", "source_order_type"]
    counts = events.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 60").select(*key)
    assert _sorted(hot_keys(events, key, 60)) == _sorted(counts)
    assert hot_keys(events, key, 900) is None


def test_models_that_need_nothing_of_each_other_are_fitted_side_by_side(spark, monkeypatch):
    """Each fit waits until the others have begun; one after the other, the first would wait in vain."""
    both, three = threading.Barrier(2), threading.Barrier(3)
    monkeypatch.setattr(catalog, "_risk", lambda w: both.wait(20) * 0 or "risk")
    monkeypatch.setattr(catalog, "_flow_risk", lambda w: both.wait(20) * 0 or "flow-risk")
    rows = spark.createDataFrame([("train", 5.0), ("train", 7.0), ("val", 6.0)], "split_set string, target_horas_totales double")
    rows = rows.withColumn("desvio_sla", F.col("target_horas_totales") - 4)
    asked = []

    def fit(df, encoder, target, offset):
        three.wait(20)
        asked.append(target)
        return target

    monkeypatch.setattr(catalog.ft, "hours_population", lambda df: df)
    monkeypatch.setattr(catalog.ml, "fit_encoder", lambda *a: None)
    monkeypatch.setattr(catalog.ml, "fit_hours", fit)
    monkeypatch.setattr(catalog.ml, "hours_predictions", lambda fitted, df, keep: df.withColumn("horas_pred", F.col("horas") + 1))

    class Own(Warehouse):
        dataset_with_history = dataset_with_flow = orders = dataset = rows

    w = Own(spark, "none")
    scored = []
    monkeypatch.setattr(catalog.ml, "predictions", lambda fitted, df: scored.append(fitted) or rows)
    monkeypatch.setattr(catalog.ev, "binary_metrics", lambda df: df)
    monkeypatch.setattr(catalog.ev, "compare", lambda reports: reports)
    assert set(catalog.classifier_quality(w)) == {"creacion", "flujo"} and scored == ["risk", "flow-risk"]
    done = catalog.experiment_grid(w)
    assert {r.experimento for r in done.collect()} == {"reg_v2a", "reg_v2b", "reg_v2c"} and len(asked) == 3
