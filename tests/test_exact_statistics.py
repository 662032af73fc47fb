"""Percentiles, running totals, AUC and samples against brute force, with skewed groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelpulse.functions.ordered import RANGE, in_ranges, most_frequent, percentiles, running_totals
from parcelpulse.operators import diagnostics as dg
from parcelpulse.operators import evaluation as ev
from parcelpulse.operators import models


def _sample(seed=3):
    rng = random.Random(seed)
    rows = [("hot", rng.choice([rng.lognormvariate(3, 2), 7.0, -rng.random(), 0.0])) for _ in range(3000)]
    rows += [("one", 5.0), ("pair", 1.0), ("pair", 2.0), (None, 4.0), (None, 8.0), ("hot", None), ("hot", float("nan"))]
    return rows


def test_percentiles_match_numpy(spark):
    rows = _sample()
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.05, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {r.g: r for r in percentiles(df, ["g"], {"v": F.col("v")}, {"v": probs}).collect()}
    for g in {"hot", "one", "pair", None}:
        values = [v for k, v in rows if k == g and v is not None and v == v]
        for p in probs:
            assert got[g][f"v__{round(p * 100):02d}"] == pytest.approx(np.percentile(values, p * 100), rel=1e-12), (g, p)


def test_percentiles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert percentiles(df, [], {"v": F.col("v")}, {"v": [0.5]}).first()["v__50"] == 2.0
    assert percentiles(df.where("v > 99").withColumn("g", F.lit("a")), ["g"], {"v": F.col("v")}, {"v": [0.5]}).count() == 0


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_close_values_are_spread_over_ranges(spark, many_ranges):
    close = spark.range(1_000_000).select((5000 + F.col("id") / 1_000_000).alias("v"))
    held = in_ranges(close, ["v"]).groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("z"))
    held = held.orderBy(RANGE).collect()
    assert len(held) == 100 and max(r.n for r in held) < 2 * 10_000
    assert all(x.z < y.a for x, y in zip(held, held[1:]))
    got = percentiles(close, [], {"v": F.col("v")}, {"v": [0.25, 0.5]}).first()
    assert got["v__25"] == pytest.approx(5000 + 249_999.75 / 1e6, rel=1e-12)


def test_labels_with_one_beginning_are_ranked_in_ranges(spark, many_ranges):
    labels = spark.range(100_000).select(F.lit("seller").alias("feature"), F.format_string("seller_%09d", "id").alias("value"), "id")
    assert models._ranked(labels).join(labels, ["feature", "value"]).where("code <> id").count() == 0
    held = in_ranges(labels, ["feature", "value"]).groupBy(RANGE).count().collect()
    assert len(held) == 100 and max(r["count"] for r in held) < 2 * 1_000


def test_running_totals_over_two_columns(spark):
    rows = [("a", 1, "y", 3), ("a", 1, "x", 2), ("a", 0, "z", 5), (None, 9, "q", 7), ("b", 4, None, 1), ("b", 4, "r", 6)]
    df = spark.createDataFrame(rows, "g string, u int, v string, n long")
    got = {(r.g, r.u, r.v): (r.cum_n, r.tot_n) for r in running_totals(df, ["g"], ["u", "v"], ["n"], descending=False).collect()}
    assert got == {("a", 0, "z"): (5, 10), ("a", 1, "x"): (7, 10), ("a", 1, "y"): (10, 10), (None, 9, "q"): (7, 7), ("b", 4, None): (1, 7), ("b", 4, "r"): (7, 7)}


def test_running_totals(spark):
    rng = random.Random(5)
    counts = {(g, round(rng.random(), 3)): rng.randint(1, 9) for g in "ab" for _ in range(300)}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in counts.items()], "g string, v double, n long")
    for r in running_totals(df, ["g"], "v", ["n"]).collect():
        assert r.cum_n == sum(n for (g, v), n in counts.items() if g == r.g and v >= r.v)
        assert r.tot_n == sum(n for (g, v), n in counts.items() if g == r.g)


def _scores(seed=11, n=400):
    rng = random.Random(seed)
    return [("s", round(rng.random(), 1) if i % 2 else rng.random(), rng.randint(0, 1)) for i in range(n)]


def test_auc_and_average_precision_with_ties(spark):
    rows = _scores()
    df = spark.createDataFrame(rows, "split_set string, prob double, target int")
    pos = [p for _, p, t in rows if t]
    neg = [p for _, p, t in rows if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert ev.roc_auc(df).first().auc == pytest.approx(auc, abs=1e-6)
    ap, before = 0.0, 0
    for cut in sorted({p for _, p, _ in rows}, reverse=True):
        hits = sum(1 for p in pos if p >= cut)
        ap += (hits - before) / len(pos) * hits / (hits + sum(1 for p in neg if p >= cut))
        before = hits
    assert ev.avg_precision(df).first().avg_precision == pytest.approx(ap, abs=1e-6)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([("s", 0.2, 1), ("s", 0.8, 1)], "split_set string, prob double, target int")
    assert ev.roc_auc(df).first().auc is None


def test_most_frequent_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (2, "z")], "k int, v string")
    assert {r.k: r.v for r in most_frequent(df, ["k"], "v").collect()} == {1: "a", 2: "z"}


def test_sample_is_exact_in_size_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("string").alias("c"))
    got = dg.sample_per_class(df, "c", "k", 700)
    first = sorted(r.k for r in got.collect())
    assert {r.c: r["count"] for r in got.groupBy("c").count().collect()} == {"false": 700, "true": 500}
    again = sorted(r.k for r in dg.sample_per_class(df.repartition(7), "c", "k", 700).collect())
    assert first == again


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([("OK", float(i)) for i in range(100)] + [("DISRUPTED", 3.0)], "clase string, h double")
    got = dg.histogram(df, "h", "clase", bins=10).collect()
    for scale in ("lineal", "log1p"):
        assert sum(r.n for r in got if r.escala == scale and r.clase == "OK") == 100
        assert [(r.bin, r.n) for r in got if r.escala == scale and r.clase == "DISRUPTED"] == [(0, 1)]


def test_regression_report_drops_and_counts_what_is_not_finite(spark):
    rows = [("s", 10.0, 12.0), ("s", 20.0, 70.0), ("s", 30.0, float("nan")), ("s", None, 1.0), ("s", 5.0, float("inf"))]
    r = ev.regression_report(spark.createDataFrame(rows, "split_set string, horas double, horas_pred double")).first()
    assert (r.n, r.n_descartadas, r.mae_horas, r.dentro_24h, r.dentro_48h) == (5, 3, 26.0, 50.0, 50.0)
    assert r.rmse_horas == pytest.approx(35.38, abs=0.01)
    assert r.r2 == pytest.approx(1 - (4 + 2500) / 50, abs=1e-4)


def test_class_report_handles_a_class_never_predicted(spark):
    df = spark.createDataFrame([("s", "a", "a"), ("s", "b", "a"), ("s", "c", "c")], "split_set string, target string, pred string")
    got = {r.clase: r for r in ev.class_report(df).collect()}
    assert (got["a"].precision, got["a"].recall, got["b"].f1, got["c"].f1) == (0.5, 1.0, 0.0, 1.0)
    assert got["accuracy"].f1 == pytest.approx(0.6667)
    assert got["macro avg"].recall == pytest.approx(0.6667)
