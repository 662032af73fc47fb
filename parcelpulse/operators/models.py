"""Risk, leg and hours models with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.functions.ordered import running_totals
from parcelpulse.operators import boosting, grown
from parcelpulse.operators.boosting import Ensemble, TreeSettings
from parcelpulse.session import new_folder, staged
from parcelpulse.sources.schemas import UNKNOWN

# Up to this many labels a category is nominal to the trees; the codes of a larger one are ranks to them.
NOMINAL_LABELS = 1_000
DEVIATION_OFFSET = 200.0


@dataclass(frozen=True)
class Encoder:
    """Numeric columns, and the stored table (feature, value, code) of the categories' labels.

    A code is the label's place in sorted order. ``sizes`` and ``unknown`` have one number per
    category: how many labels it has, and the code of the unknown one.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    table: DataFrame | None = None
    sizes: dict[str, int] = field(default_factory=dict)
    unknown: dict[str, int] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))


def _ranked(values: DataFrame) -> DataFrame:
    """Labels with their place in sorted order, from 0, counted by ranges of labels."""
    placed = running_totals(values.withColumn("one", F.lit(1)), ["feature"], "value", ["one"], descending=False)
    return placed.select("feature", "value", (F.col("cum_one") - 1).cast("int").alias("code"))


def fit_encoder(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], months: Sequence[str] | None = None
) -> Encoder:
    """Learn the labels of each category, always with one for unknown values.

    ``months`` restricts the fit to some months of training. The labels stay in a stored table,
    however many they are; one row per category comes to the driver.
    """
    if not categorical:
        return Encoder(tuple(numeric))
    base = train if months is None else train.where(F.col("year_month").isin(list(months)))
    pairs = [F.struct(F.lit(c).alias("feature"), _text(c).alias("value")) for c in categorical]
    always = train.sparkSession.createDataFrame([(c, UNKNOWN) for c in categorical], "feature string, value string")
    values = base.select(F.inline(F.array(*pairs))).unionByName(always).distinct()
    table = staged(_ranked(values), "labels")
    return _encoder(numeric, categorical, table)


def _encoder(numeric: Sequence[str], categorical: Sequence[str], table: DataFrame) -> Encoder:
    unknown = F.max(F.when(F.col("value") == UNKNOWN, F.col("code")))
    rows = table.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), unknown.alias("u")).collect()
    return Encoder(tuple(numeric), tuple(categorical), table, {r.feature: r.n for r in rows}, {r.feature: r.u for r in rows})


def encode(df: DataFrame, encoder: Encoder, keep: Sequence[str]) -> DataFrame:
    """Numbers as float with -1 for bad or missing ones; labels as their rank, unseen as unknown.

    Each category is a join with its labels; the size of their file decides on a broadcast.
    """
    out = [F.coalesce(F.col(c).try_cast("float"), F.lit(-1.0).cast("float")).alias(c) for c in encoder.numeric]
    for c in encoder.categorical:
        labels = encoder.table.where(F.col("feature") == c)
        labels = labels.select(F.col("value").alias(f"__value_{c}"), F.col("code").alias(f"__code_{c}"))
        df = df.withColumn(f"__text_{c}", _text(c)).join(labels, F.col(f"__text_{c}") == F.col(f"__value_{c}"), "left")
        nominal = {"ml_attr": {"type": "nominal", "name": c, "num_vals": encoder.sizes[c]}}
        code = F.coalesce(f"__code_{c}", F.lit(encoder.unknown[c]))
        out.append(code.alias(f"{c}_code", metadata=nominal if encoder.sizes[c] <= NOMINAL_LABELS else {}))
    return df.select(*keep, *out)


def _vector(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    columns = [*encoder.numeric, *[f"{c}_code" for c in encoder.categorical]]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(encoded)


def _max_bins(encoder: Encoder) -> int:
    return max([32, *[n + 1 for n in encoder.sizes.values() if n <= NOMINAL_LABELS]])


def _train_and_val(df: DataFrame) -> DataFrame:
    return df.where(F.col("split_set").isin("train", "val")).withColumn("is_val", F.col("split_set") == "val")


@dataclass(frozen=True)
class Fitted:
    """``models`` has one model, or one per class that tells it from the rest; ``curves`` their validation losses."""

    models: tuple[Model, ...]
    encoder: Encoder
    classes: tuple[str, ...] = ()
    offset: float | None = None
    curves: tuple[tuple[float, ...], ...] = ()

    @property
    def model(self) -> Model:
        return self.models[0]

    def vectors(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return _vector(encode(df, self.encoder, keep), self.encoder)


_ENCODER = "numeric array<string>, categorical array<string>"
_FITTED = f"{_ENCODER}, classes array<string>, offset double, kind string, n_models int, curves array<array<double>>"
_MONTHLY = f"{_ENCODER}, months array<string>, losses array<double>"


def _save_encoder(encoder: Encoder, folder: str) -> tuple[list[str], list[str]]:
    if encoder.table is not None:
        encoder.table.write.parquet(f"{folder}/labels")
    return list(encoder.numeric), list(encoder.categorical)


def _load_encoder(spark: SparkSession, folder: str, numeric: Sequence[str], categorical: Sequence[str]) -> Encoder:
    if not categorical:
        return Encoder(tuple(numeric))
    return _encoder(numeric, categorical, spark.read.parquet(f"{folder}/labels"))


def save_fitted(fitted: Fitted, folder: str) -> None:
    """Models, label table, validation curves and settings as files, for another session to score with."""
    for k, model in enumerate(fitted.models):
        model.save(f"{folder}/model-{k}")
    kind = type(fitted.model).__name__
    row = (*_save_encoder(fitted.encoder, folder), list(fitted.classes), fitted.offset, kind, len(fitted.models), [list(c) for c in fitted.curves])
    SparkSession.active().createDataFrame([row], _FITTED).write.json(f"{folder}/settings")


def load_fitted(spark: SparkSession, folder: str) -> Fitted:
    kept = spark.read.schema(_FITTED).json(f"{folder}/settings").first()
    kind = {k.__name__: k for k in (GBTClassificationModel, GBTRegressionModel)}[kept.kind]
    models = tuple(kind.load(f"{folder}/model-{k}") for k in range(kept.n_models))
    encoder = _load_encoder(spark, folder, kept.numeric, kept.categorical)
    return Fitted(models, encoder, tuple(kept.classes or ()), kept.offset, tuple(map(tuple, kept.curves or ())))


def curve_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """(model, round, loss, kept): the validation loss after each round and whether the model has it."""
    rows = [
        (k, n, loss, n <= model.getNumTrees) for k, (model, curve) in enumerate(zip(fitted.models, fitted.curves)) for n, loss in enumerate(curve, 1)
    ]
    return spark.createDataFrame(rows, "model int, round int, loss double, kept boolean")


def boosting_rows(rows: DataFrame, encoder: Encoder, keep: Sequence[str], label: Column, weight: Column | None = None) -> DataFrame:
    """(features, label, w, is_val and ``keep``) of the train and val rows; stored, as every round reads them."""
    known = _train_and_val(rows).withColumn("label", label.cast("double"))
    known = known.withColumn("w", (F.lit(1.0) if weight is None else weight).cast("double"))
    kept = ["label", "w", "is_val", *keep]
    return staged(_vector(encode(known, encoder, kept), encoder).select("features", *kept), "vectors")


def _boosted(
    rows: DataFrame, encoder: Encoder, settings: TreeSettings, classes: Sequence[int] = (), weighted: bool = False
) -> list[tuple[Model, tuple[float, ...]]]:
    """A model and its curve for each class against the rest, or of the label if there are none.

    Executors that come and go can't hold the rows of a fit; Spark's own learner works with them.
    """
    if grown.can_grow(rows.sparkSession):
        sizes = [encoder.sizes[c] for c in encoder.categorical]
        nominal = [0] * len(encoder.numeric) + [n if n <= NOMINAL_LABELS else 0 for n in sizes]
        return grown.fit_grown(rows, settings, nominal, _max_bins(encoder), classes, weighted)

    def one(k: int | None) -> tuple[Model, tuple[float, ...]]:
        own = rows if k is None else rows.withColumn("label", (F.col("label") == k).cast("double"))
        return boosting.fit_patient(GBTRegressor if k is None else GBTClassifier, own, settings, _max_bins(encoder))

    with ThreadPoolExecutor(max(1, len(classes))) as side_by_side:
        return list(side_by_side.map(one, classes or [None]))


def fit_risk(dataset: DataFrame, encoder: Encoder, settings: TreeSettings = TreeSettings()) -> Fitted:
    """Boosted trees for the disruption label; the validation split decides how many rounds are kept."""
    rows = boosting_rows(dataset, encoder, [], F.col("target_binario"))
    [(model, curve)] = _boosted(rows, encoder, settings, [1])
    return Fitted((model,), encoder, curves=(curve,))


@dataclass(frozen=True)
class Continued:
    """A fit continued period by period: the trees that each added and the validation loss after it."""

    periods: tuple[str, ...]
    parts: tuple[Ensemble, ...]
    losses: tuple[float | None, ...]
    fitted: Fitted

    @property
    def whole(self) -> Ensemble:
        return reduce(Ensemble.plus, self.parts, Ensemble())


def fit_risk_continued(
    dataset: DataFrame, numeric: Sequence[str], categorical: Sequence[str], settings: TreeSettings = TreeSettings(),
    first: int = 200, more: int = 50, period: str = "year_month",
) -> Continued:
    """Boosting continued over the periods of training, the oldest first.

    Labels are learned from the first period. It gets ``first`` rounds and each later one ``more``,
    on its own rows alone and from the margins of all trees so far; nothing is cut. The
    validation rows, of which later periods are never trained on, say what each was good for.
    """
    train = dataset.where(F.col("split_set") == "train")
    periods = [r[0] for r in train.select(period).distinct().orderBy(period).collect()]  # periods, no rows
    encoder = fit_encoder(train.where(F.col(period) == periods[0]), numeric, categorical)
    rows = boosting_rows(dataset, encoder, [period], F.col("target_binario"))
    val = rows.where("is_val").persist()
    parts, losses, whole = [], [], Ensemble()
    for nth, p in enumerate(periods):
        own = rows.where((F.col(period) == p) & ~F.col("is_val"))
        part = boosting.constant(own) if nth == 0 else Ensemble()
        part = part.plus(boosting.go_on(own, whole.plus(part), first if nth == 0 else more, settings, _max_bins(encoder)))
        whole = whole.plus(part)
        parts.append(part)
        losses.append(boosting.mean_loss(val, whole))
    val.unpersist()
    return Continued(tuple(periods), tuple(parts), tuple(losses), Fitted((whole.classifier(),), encoder))


def save_continued(continued: Continued, folder: str) -> None:
    """The part of each period in a folder of its own, beside labels, settings and losses."""
    for nth, part in enumerate(continued.parts):
        part.regression().save(f"{folder}/part-{nth}")
    row = (*_save_encoder(continued.fitted.encoder, folder), list(continued.periods), list(continued.losses))
    SparkSession.active().createDataFrame([row], _MONTHLY).write.json(f"{folder}/settings")


def load_continued(spark: SparkSession, folder: str) -> Continued:
    """The parts put together again."""
    kept = spark.read.schema(_MONTHLY).json(f"{folder}/settings").first()
    models = [GBTRegressionModel.load(f"{folder}/part-{nth}") for nth in range(len(kept.months))]
    parts = tuple(Ensemble(tuple(m.trees), tuple(m.treeWeights)) for m in models)
    encoder = _load_encoder(spark, folder, kept.numeric, kept.categorical)
    whole = reduce(Ensemble.plus, parts, Ensemble())
    return Continued(tuple(kept.months), parts, tuple(kept.losses), Fitted((whole.classifier(),), encoder))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_clase"))
    all_rows = counts.agg(F.sum("n_clase").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(all_rows.n or 0)) / (F.lit(float(all_rows.k)) * F.col("n_clase"))
    return counts.withColumn("peso", F.round(weight, 9))


def fit_leg(
    dataset: DataFrame, encoder: Encoder, label: str, classes: Sequence[str], settings: TreeSettings = TreeSettings()
) -> Fitted:
    """Boosted trees for the class of the broken leg, of three or four, with balanced class weights.

    Boosting of Spark ML knows two classes, so each class is told from the rest, and stops by its own
    validation curve. The classes are fitted in one go, over the same rows.
    """
    names = F.array(*[F.lit(c) for c in classes])
    known = dataset.where(F.col(label).isin(*classes))
    weights = {r[label]: r.peso for r in class_weights(known.where(F.col("split_set") == "train"), label).collect()}  # one row per class
    weight = F.lit(0.0)
    for c, w in weights.items():
        weight = F.when(F.col(label) == c, float(w)).otherwise(weight)
    rows = boosting_rows(known, encoder, [], F.array_position(names, F.col(label)) - 1, weight)
    fits = _boosted(rows, encoder, settings, range(len(classes)), weighted=True)
    return Fitted(tuple(m for m, _ in fits), encoder, tuple(classes), curves=tuple(c for _, c in fits))


def fit_hours(
    dataset: DataFrame, encoder: Encoder, target: str = "target_horas_totales", offset: float = 0.0,
    settings: TreeSettings = TreeSettings(),
) -> Fitted:
    """Boosted regression on log1p(target + offset); rows outside its domain are left out of the fit."""
    shifted = F.col(target) + F.lit(offset)
    rows = boosting_rows(dataset.where(shifted > -1), encoder, [], F.log1p(shifted))
    [(model, curve)] = _boosted(rows, encoder, settings)
    return Fitted((model,), encoder, offset=offset, curves=(curve,))


def score(fitted: Fitted, df: DataFrame, keep: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Probability rounded to four digits, and the class at the threshold on the exact probability."""
    p = vector_to_array(F.col("probability"))[1]
    scored = fitted.model.transform(fitted.vectors(df, keep))
    return scored.select(*keep, F.round(p, 4).alias("prob"), (p >= threshold).cast("int").alias("pred"))


def predictions(fitted: Fitted, dataset: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scores of every order with its label and whether the class was right."""
    keep = ["logistic_order_id", "year_month", "split_set"]
    base = dataset.withColumn("__category", F.col("service_category"))
    out = score(fitted, base, [*keep, "__category", "target_binario"], threshold)
    target = F.col("target_binario").cast("smallint")
    return out.select(
        *keep, F.col("__category").alias("service_category"), F.col("prob").cast("decimal(6,4)").alias("prob"),
        F.col("pred").cast("smallint").alias("pred"), target.alias("target"),
        (F.col("pred") == F.col("target_binario")).cast("smallint").alias("hit"),
    )


def leg_predictions(fitted: Fitted, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The class that its model is surest of, the first of equal ones."""
    scored = fitted.vectors(df, keep)
    for k, model in enumerate(fitted.models):
        of_class = model.copy().setProbabilityCol(f"__p{k}").setRawPredictionCol("").setPredictionCol("")
        scored = of_class.transform(scored)
    chances = F.array(*[F.struct(vector_to_array(F.col(f"__p{k}"))[1].alias("p"), F.lit(-k).alias("k")) for k in range(len(fitted.classes))])
    names = F.array(*[F.lit(c) for c in fitted.classes])
    return scored.select(*keep, F.get(names, -F.array_max(chances)["k"]).alias("pred"))


def hours_predictions(fitted: Fitted, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Back to hours; a plain duration is never negative, a deviation may be."""
    offset = fitted.offset or 0.0
    hours = F.expm1("prediction") - F.lit(offset)
    scored = fitted.model.transform(fitted.vectors(df, keep))
    return scored.select(*keep, (hours if offset else F.greatest(hours, F.lit(0.0))).alias("horas_pred"))


def importance(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Gain-based importance and number of splits per feature, highest gain first."""
    spark = df.sparkSession
    names = fitted.encoder.features
    known = fitted.model.featureImportances.toArray()  # ends with the last feature that a tree splits on
    gains = [*known, *[0.0] * (len(names) - len(known))]
    with_model = new_folder(spark, "model-nodes")
    fitted.model.save(with_model)
    nodes = spark.read.parquet(f"{with_model}/data").select("nodeData.*").where(F.col("split.featureIndex") >= 0)
    splits = {r.featureIndex: r.n for r in nodes.groupBy("split.featureIndex").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(n, float(g), splits.get(i, 0)) for i, (n, g) in enumerate(zip(names, gains))]
    return spark.createDataFrame(rows, "feature string, importance_gain double, importance_split int").orderBy(
        F.col("importance_gain").desc(), "feature"
    )


# Risk levels by least probability.
RISK_LEVELS = [(0.8, "CRÍTICO"), (0.6, "ALTO"), (0.4, "MODERADO")]


def risk_level(prob: Column) -> Column:
    level = F.lit("BAJO")
    for least, name in reversed(RISK_LEVELS):
        level = F.when(prob >= least, name).otherwise(level)
    return level
