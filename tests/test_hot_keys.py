"""A key cut into slices gives the same result as one handled whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parcelpulse.functions.sequences import previous, running, sequence
from parcelpulse.operators import flow, lookups, replay

STATUSES = ["SHIPMENT_CONFIRMED", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERY_ATTEMPTED", "EXCEPTION", "ANNULLED", None]
SCHEMA = """logistic_order_id string, package_id string, shipment_id string, promised_date string,
            package_status string, event_type string, event_dt timestamp_ntz, event_id long"""


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(7)
    start = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(600):
        order = "hot" if i % 3 else f"o{i % 20}"
        at = start + dt.timedelta(minutes=rng.randint(0, 4000) if i % 5 else 1000)
        rows.append((order, rng.choice(["p1", "p2", None]), "s", "d", rng.choice(STATUSES), "E", at, i))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def _same(a, b):
    def key(r):
        return tuple(str(round(x, 6) if isinstance(x, float) else x) for x in r)

    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    assert a.columns == b.columns


def test_hot_key_is_cut(events):
    cut = sequence(events, ["logistic_order_id"], "event_dt", ["event_id"], limit=50)
    assert cut.hot
    sizes = {(r.logistic_order_id, r["__slice"]): r["count"]
             for r in cut.df.groupBy("logistic_order_id", "__slice").count().collect()}
    assert sum(1 for k in sizes if k[0] == "hot") >= 8
    assert all(k[1] == 0 for k in sizes if k[0] != "hot")
    assert sum(sizes.values()) == 600


@pytest.mark.parametrize("limit", [5, 50, 150])
def test_flow_features(events, limit):
    _same(flow.flow_features(events), flow.flow_features(events, limit=limit))


@pytest.mark.parametrize("limit", [5, 50])
def test_journey(events, limit):
    _same(lookups.journey(events), lookups.journey(events, limit=limit))
    _same(lookups.event_digest(events), lookups.event_digest(events, limit=limit))


@pytest.mark.parametrize("limit", [5, 50])
def test_replay(events, limit):
    _same(replay.status_changes(events), replay.status_changes(events, limit=limit))
    _same(replay.prefix_features(events), replay.prefix_features(events, limit=limit))


@pytest.mark.parametrize("kind", ["burst", "instant"])
def test_a_burst_is_cut_by_rank(spark, kind):
    second = F.col("id") if kind == "burst" else F.lit(0)
    at = F.timestamp_micros(F.when(F.col("id") == 0, 10**15).otherwise(second)).cast("timestamp_ntz")
    rows = spark.range(20_000).select(F.lit("k").alias("k"), at.alias("t"), F.col("id").alias("tie"))
    seq = sequence(rows, ["k"], "t", ["tie"], limit=1000)
    sizes = seq.df.groupBy("__slice").count()
    assert seq.hot and sizes.agg(F.max("count")).first()[0] <= 2000
    whole = sequence(rows, ["k"], "t", ["tie"])
    runs = [running(previous(x.replace(x.df.withColumn("one", F.lit(1))), ["tie"]), sums=["one"]).df.select("tie", "prev_tie", "run_one") for x in (seq, whole)]
    assert sorted(map(tuple, runs[0].collect()), key=str) == sorted(map(tuple, runs[1].collect()), key=str)


# One order's day and a lone event without a status, with what they come to, worked out by hand.
DAY = [("10:00", "SHIPMENT_CONFIRMED"), ("12:00", "IN_TRANSIT"), ("18:00", "DELIVERY_ATTEMPTED"), ("18:00", "DELIVERY_ATTEMPTED"), ("18:30", "OUT_FOR_DELIVERY")]
NAMES = [
    "horas_a_shipment_confirmed", "horas_a_out_for_delivery", "horas_entre_eventos_max", "horas_entre_eventos_avg", "n_eventos_total",
    "n_estados_distintos", "tuvo_delivery_attempted", "tuvo_exception", "tuvo_annulled", "esta_en_transito", "esta_out_for_delivery",
    "esta_shipment_confirmed", "ultimo_estado",
]
STONES = [
    ("10:00", 0.0, -1.0, 0.0, 0.0, 1, 1, 0, 0, 0, 0, 0, 1, "SHIPMENT_CONFIRMED"),
    ("12:00", 0.0, -1.0, 2.0, 2.0, 2, 2, 0, 0, 0, 1, 0, 0, "IN_TRANSIT"),
    ("18:00", 0.0, -1.0, 6.0, 8 / 3, 4, 3, 1, 0, 0, 0, 0, 0, "DELIVERY_ATTEMPTED"),
    ("18:30", 0.0, 8.5, 6.0, 2.125, 5, 4, 1, 0, 0, 0, 1, 0, "OUT_FOR_DELIVERY"),
]
LONE = (-1.0, -1.0, 0.0, 0.0, 1, 0, 0, 0, 0, 0, 0, 0, None)


@pytest.fixture(scope="module")
def day(spark):
    at = lambda t: dt.datetime.fromisoformat(f"2025-03-01T{t}")
    rows = [("a", "p", "s", "d", status, "E", at(t), i) for i, (t, status) in enumerate(DAY)]
    return spark.createDataFrame([*rows, ("b", "p", "s", "d", None, "E", at("09:00"), 99)], SCHEMA)


@pytest.mark.parametrize("limit", [2, 1000])
def test_flow_features_by_hand(day, limit):
    got = {r.logistic_order_id: [r[n] for n in NAMES] for r in flow.flow_features(day, limit=limit).collect()}
    assert got == {"a": [pytest.approx(x) if isinstance(x, float) else x for x in STONES[-1][1:]], "b": list(LONE)}


@pytest.mark.parametrize("limit", [2, 1000])
def test_prefix_features_by_hand(day, limit):
    got = {r.n_hito: r for r in replay.prefix_features(day, limit=limit).where("logistic_order_id = 'a'").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for n, (at, *values) in enumerate(STONES, start=1):
        assert got[n].event_dt.strftime("%H:%M") == at
        assert [got[n][c] for c in NAMES] == [pytest.approx(x) if isinstance(x, float) else x for x in values]


def test_last_prefix_equals_whole_sequence(events):
    moments = replay.moments(events, limit=50)
    last = moments.groupBy("logistic_order_id").agg(F.max_by(F.struct(*moments.columns[2:]), "event_dt").alias("m"))
    flat = last.select("logistic_order_id", "m.*")
    _same(flat, flow.flow_features(events).select(*flat.columns))
