"""Boosting with patience, and boosting that goes on.

``fit_patient`` looks at the whole validation curve: rounds end when the best one lies ``patience``
rounds back, not at the first dip, and the model is cut to its best prefix of trees. Spark's learner
does the rounds in one go, over vectors that are stored and persisted. If patience has not run out at
the end of a fit, more rounds are fitted, and the first trees come out the same: all that are allowed
if the loss was still falling, as no shorter fit is likely to see patience run out, or else twice as many.

``go_on`` starts from an ensemble: each round fits one tree to the gradients of the margin so far,
weighted by their curvature, so that a leaf's value is a Newton step. The rounds of a later month so
continue those of an earlier one. After each block of rounds the margins are computed anew from the
vectors and the ensemble, so a lost executor costs one pass, not the rounds before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.session import new_folder

#: Least curvature of the loss: bounds the step of rows that are all but decided.
FLAT = 1e-6
#: Rounds of ``go_on`` between two computations of the margins from the vectors.
BLOCK = 10


@dataclass(frozen=True)
class TreeSettings:
    """At most ``rounds``; fewer once the best round on the validation split is ``patience`` rounds old."""

    rounds: int = 1000
    step: float = 0.05
    depth: int = 6
    min_rows: int = 200
    feature_share: float = 0.8
    row_share: float = 0.8
    seed: int = 42
    patience: int = 50


Model = GBTClassificationModel | GBTRegressionModel


def of_trees(kind: type, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]) -> Model:
    """Spark's boosted model of these trees and weights, by its public constructor."""
    spark = SparkSession.active()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    java_trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    java_weights = gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        java_trees[i], java_weights[i] = tree._java_obj, float(weight)
    package = jvm.org.apache.spark.ml.classification if kind is GBTClassificationModel else jvm.org.apache.spark.ml.regression
    return kind(getattr(package, kind.__name__)(f"boosted-{uuid.uuid4().hex[:12]}", java_trees, java_weights))


def best_round(curve: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds of the least loss seen until patience ran out, whether it did); the earlier of equal ones."""
    at = 1
    for n, value in enumerate(curve, 1):
        if value < curve[at - 1]:
            at = n
        elif n - at >= patience:
            return at, True
    return at, False


def next_rounds(n: int, at: int, settings: TreeSettings) -> int:
    """Rounds of the fit after one of ``n``, whose best round is ``at`` and which patience did not end."""
    falling = n - at < settings.patience / 5
    return settings.rounds if falling else min(2 * n, settings.rounds)


def cut(model: Model, rounds: int) -> Model:
    """The model of the first rounds."""
    return of_trees(type(model), model.trees[:rounds], model.treeWeights[:rounds])


def fit_patient(kind: type, rows: DataFrame, settings: TreeSettings, max_bins: int = 32) -> tuple[Model, tuple[float, ...]]:
    """(the best prefix of a boosted fit, validation loss after each round) of (features, label, w, is_val).

    ``kind`` is Spark's classifier of two classes or its regressor. Weights count in training only.
    Without validation rows all rounds are done and kept, and there is no curve.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # the learner cuts its lineage there
        context.setCheckpointDir(new_folder(rows.sparkSession, "boosting"))
    train = rows.where(~F.col("is_val")).drop("is_val").persist()
    val = rows.where("is_val").withColumn("w", F.lit(1.0)).persist()
    watched = not val.isEmpty()
    n = min(settings.rounds, 3 * settings.patience) if watched else settings.rounds
    try:
        while True:
            learner = kind(
                featuresCol="features", labelCol="label", weightCol="w", maxIter=n, stepSize=settings.step, maxDepth=settings.depth,
                minInstancesPerNode=settings.min_rows, featureSubsetStrategy=str(settings.feature_share),
                subsamplingRate=settings.row_share, maxBins=max_bins, seed=settings.seed,
            )
            model = learner.fit(train)
            if not watched:
                return model, ()
            curve = model.evaluateEachIteration(val) if kind is GBTClassifier else model.evaluateEachIteration(val, "squared")
            at, over = best_round(curve, settings.patience)
            if over or n == settings.rounds:
                return cut(model, at), tuple(curve)
            n = next_rounds(n, at, settings)
    finally:
        train.unpersist()
        val.unpersist()


@dataclass(frozen=True)
class Ensemble:
    """Trees whose weighted sum is the log odds of class 1, in the order they were added."""

    trees: tuple[DecisionTreeRegressionModel, ...] = ()
    weights: tuple[float, ...] = ()

    def plus(self, other: Ensemble) -> Ensemble:
        return Ensemble(self.trees + other.trees, self.weights + other.weights)

    def regression(self, margin: str = "margin") -> GBTRegressionModel:
        """Spark's model whose prediction is the margin."""
        return of_trees(GBTRegressionModel, self.trees, self.weights).setPredictionCol(margin)

    def classifier(self) -> GBTClassificationModel:
        """Spark's model of two classes, whose margin is half the log odds."""
        return of_trees(GBTClassificationModel, self.trees, [w / 2 for w in self.weights])


def log_loss(margin: Column) -> Column:
    signed = margin * (2 * F.col("label") - 1)
    return F.greatest(-signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))


def mean_loss(rows: DataFrame, ensemble: Ensemble) -> float | None:
    return ensemble.regression("__m").transform(rows).agg(F.avg(log_loss(F.col("__m")))).first()[0]


def constant(rows: DataFrame) -> Ensemble:
    """The one log odds that fits the rows best, as a tree of a single leaf."""
    mean = rows.agg(F.avg("label")).first()[0]
    odds = 0.0 if mean in (None, 0.0, 1.0) else log(mean / (1 - mean))
    leaf = rows.sparkSession.createDataFrame([(Vectors.dense([0.0]), odds)], ["features", "label"])
    return Ensemble((DecisionTreeRegressor(maxDepth=0).fit(leaf),), (1.0,))


def go_on(rows: DataFrame, begin: Ensemble, rounds: int, settings: TreeSettings, max_bins: int = 32) -> Ensemble:
    """What so many more rounds on (features, label) add to ``begin``: the new trees only."""
    added = Ensemble()
    while len(added.trees) < rounds:
        now = begin.plus(added).regression("__m").transform(rows).persist()
        held, margin, block = now, F.col("__m"), []
        for nth in range(min(BLOCK, rounds - len(added.trees))):
            p = 1 / (1 + F.exp(-margin))
            bend = F.greatest(p * (1 - p), F.lit(FLAT))
            learner = RandomForestRegressor(
                labelCol="__z", weightCol="__h", numTrees=1, bootstrap=False, subsamplingRate=settings.row_share,
                featureSubsetStrategy=str(settings.feature_share), maxDepth=settings.depth, minInstancesPerNode=settings.min_rows,
                maxBins=max_bins, seed=settings.seed + len(begin.trees) + len(added.trees) + nth,
            )
            slopes = now.select("features", ((F.col("label") - p) / bend).alias("__z"), bend.alias("__h"))
            tree = learner.fit(slopes).trees[0]
            block.append(tree)
            now = tree.setPredictionCol(f"__t{nth}").transform(now)
            margin = margin + settings.step * F.col(f"__t{nth}")
        held.unpersist()
        added = added.plus(Ensemble(tuple(block), (settings.step,) * len(block)))
    return added
