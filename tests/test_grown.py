"""Trees grown within one stage: the trees themselves, and what a fit does not depend on."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from parcelpulse.operators import boosting, grown, models


def _rows(spark, n=3000):
    rows = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split_set"), F.lit("2025-01").alias("year_month"),
        (F.col("id") * 37 % 29).cast("double").alias("x"), (F.col("id") * 53 % 23).cast("double").alias("y"),
        F.concat(F.lit("c"), F.col("id") * 7 % 11).alias("c"), F.col("id").alias("k"),
    )
    cause = F.col("x") + F.col("y") + 20 * F.col("c").isin("c1", "c7", "c10").cast("int") + F.col("k") % 13
    return rows.withColumn("target_binario", (cause > 40).cast("int")).withColumn("hours", cause.cast("double"))


def _vectors(spark, label="target_binario", weight=None):
    rows = _rows(spark)
    enc = models.fit_encoder(rows, ["x", "y"], ["c"])
    return enc, models.boosting_rows(rows, enc, [], F.col(label), weight)


def test_a_tree_is_that_of_spark(spark):
    """All rows, all features, no more values than bins: one tree is Spark's regression tree, weights counted in."""
    enc, rows = _vectors(spark, "hours", 1 + F.col("k") % 3)
    kinds = [0, 0, enc.sizes["c"]]
    settings = models.TreeSettings(rounds=1, depth=4, min_rows=20, feature_share=1.0, row_share=1.0)
    [(model, curve)] = grown.fit_grown(rows, settings, kinds, 32, weighted=True)
    attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": 0}, {"idx": 1}], "nominal": [{"idx": 2, "num_vals": enc.sizes["c"]}]}, "num_attrs": 3}}
    train = rows.where("not is_val").withColumn("features", F.col("features").alias("features", metadata=attrs))
    spark_tree = DecisionTreeRegressor(labelCol="label", weightCol="w", maxDepth=4, minInstancesPerNode=20, maxBins=32).fit(train)
    both = spark_tree.setPredictionCol("b").transform(model.setPredictionCol("a").transform(train)).agg(
        F.max(F.abs(F.col("a") - F.col("b"))).alias("off"), F.countDistinct("a").alias("n")
    ).first()
    assert both.off < 1e-4 and both.n > 8
    assert np.allclose(model.trees[0].featureImportances.toArray(), spark_tree.featureImportances.toArray(), atol=1e-4)
    assert len(curve) == 1


def test_trees_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    _, rows = _vectors(spark)
    settings = models.TreeSettings(rounds=6, step=0.2, depth=3, min_rows=5)
    fits = []
    for least in (25_000, 500):
        monkeypatch.setattr(grown, "TASK_ROWS", least)
        monkeypatch.setattr(grown, "BLOCK_ROWS", 200)
        fits.append(grown.fit_grown(rows, settings, [0, 0, 12], 32, [1, 0]))
    (one, mirrored), several = fits
    assert [t.toDebugString.split("\n", 1)[1] for t in one[0].trees] == [t.toDebugString.split("\n", 1)[1] for t in several[0][0].trees]
    assert one[1] == several[0][1] and mirrored[1] == several[1][1] and len(one[1]) == 6


def test_a_fit_takes_no_more_jobs_for_more_rounds_and_ends_with_patience(spark):
    """Rounds are no Spark jobs; the curve ends ``patience`` rounds after its least, and is Spark's own of the same trees."""
    enc = models.fit_encoder(_rows(spark), ["x", "y"], ["c"])
    jobs, fits = [], []
    for n in (2, 8, 400):
        spark.sparkContext.setJobGroup(f"rounds-{n}", "a fit")
        fits.append(models.fit_risk(_rows(spark), enc, models.TreeSettings(rounds=n, step=0.5, depth=3, min_rows=5, patience=7)))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and jobs[0] > 0
    curve, kept = fits[2].curves[0], fits[2].model.getNumTrees
    assert len(curve) == kept + 7 < 400 and min(curve) == curve[kept - 1]
    val = models.boosting_rows(_rows(spark), enc, [], F.col("target_binario")).where("is_val").withColumn("w", F.lit(1.0))
    assert fits[2].model.evaluateEachIteration(val) == pytest.approx(curve[:kept], abs=1e-5)


def test_no_validation_rows_keep_all_rounds(spark):
    _, rows = _vectors(spark, "hours")
    [(model, curve)] = grown.fit_grown(rows.where("not is_val"), models.TreeSettings(rounds=5, depth=2, min_rows=5), [0, 0, 12])
    assert model.getNumTrees == 5 and curve == ()


def test_split_candidates_have_even_weights():
    at, weight = grown.merged(np.array([3.0, 1.0, 3.0, 2.0]), np.array([1.0, 2.0, 3.0, 4.0]), 10)
    assert at.tolist() == [1, 2, 3] and weight.tolist() == [2, 4, 4]
    assert grown.thresholds(at, weight, 32).tolist() == [1.5, 2.5]
    at, weight = grown.merged(np.arange(10_000.0), np.ones(10_000), 500)
    assert len(at) == 500 and weight.sum() == 10_000 and at[-1] == 9_999
    cuts = grown.thresholds(at, weight, 4)
    assert np.abs(cuts - [2500, 5000, 7500]).max() < 41
    assert grown.thresholds(np.array([7.0]), np.ones(1), 32).size == 0


def test_tasks_add_up_their_sums(tmp_path):
    """Three tasks by turns of threads; files go once they are read."""
    from concurrent.futures import ThreadPoolExecutor

    def task(me):
        all_tasks = grown.Exchange(f"file:{tmp_path}/sums", me, 3)
        return [all_tasks.added_up([np.array([me, nth]), np.full((2, 2), me)])[0].tolist() for nth in range(20)]

    with ThreadPoolExecutor(3) as side_by_side:
        got = list(side_by_side.map(task, range(3)))
    assert got == [[[3, 3 * nth] for nth in range(20)]] * 3
    assert len(list((tmp_path / "sums").iterdir())) == 3


def test_executors_that_come_and_go_use_sparks_learner(spark, monkeypatch):
    enc, rows = _vectors(spark)
    monkeypatch.setattr(grown, "can_grow", lambda spark: False)
    asked = []
    monkeypatch.setattr(boosting, "fit_patient", lambda kind, own, *a: asked.append((kind.__name__, own.agg(F.sum("label")).first()[0])) or ("m", ()))
    weights = models._boosted(rows, enc, models.TreeSettings(), [0, 1], True)
    ones = _rows(spark).agg(F.sum("target_binario")).first()[0]
    assert weights == [("m", ())] * 2 and sorted(asked) == sorted([("GBTClassifier", 3000 - ones), ("GBTClassifier", ones)])
