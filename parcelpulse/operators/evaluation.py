"""Exact model metrics as aggregations over a table of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.ordered import percentile_name, percentiles, running_totals

SPLIT_ORDER = ("train", "val", "test")


def confusion(df: DataFrame, by: Sequence[str] = ("split_set",), label: str = "target", pred: str = "pred") -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence[object], **kw: object) -> DataFrame:
    """The same with one column per predicted class."""
    cells = confusion(df, **kw)  # type: ignore[arg-type]
    by = [c for c in cells.columns if c not in ("pred", "n")]
    return cells.groupBy(*by).agg(
        *[F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"pred_{c}") for c in classes]
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(0.0)


def class_scores(cells: DataFrame, by: Sequence[str] = ("split_set",)) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion cells."""
    roles = F.array(
        F.struct(F.col("label").alias("clase"), F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred").alias("clase"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    sums = cells.select(*by, F.explode(roles).alias("r")).groupBy(*by, F.col("r.clase").alias("clase")).agg(
        *[F.sum(f"r.{c}").alias(c) for c in ("tp", "support", "predicted")]
    )
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    return sums.withColumn("p", p).withColumn("r", r).withColumn(
        "f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    )


def class_report(df: DataFrame, by: Sequence[str] = ("split_set",), **kw: str) -> DataFrame:
    """One row per class, plus accuracy, macro and weighted averages."""
    scores = class_scores(confusion(df, by, **kw), by)
    kind = scores.select(
        *by, F.col("clase").cast("string").alias("clase"), F.col("p").alias("precision"), F.col("r").alias("recall"),
        F.col("f").alias("f1"), "support",
    )
    n = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / n

    def averages(name: str, columns: Sequence[Column]) -> DataFrame:
        return scores.groupBy(*by).agg(*columns, n.alias("support")).select(
            *by, F.lit(name).alias("clase"), "precision", "recall", "f1", "support"
        )

    macro = averages("macro avg", [F.avg(c).alias(o) for c, o in (("p", "precision"), ("r", "recall"), ("f", "f1"))])
    wtd = averages("weighted avg", [weighted(c).alias(o) for c, o in (("p", "precision"), ("r", "recall"), ("f", "f1"))])
    acc = averages("accuracy", [(F.sum("tp") / n).alias(o) for o in ("precision", "recall", "f1")])
    rows = kind.unionByName(macro).unionByName(wtd).unionByName(acc)
    return rows.select(
        *by, "clase", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _score_counts(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score, running from the highest score down."""
    counts = df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    return running_totals(counts, by, "score", ["pos", "neg"])


def roc_auc(df: DataFrame, by: Sequence[str] = ("split_set",), score: str = "prob", label: str = "target") -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half."""
    c = _score_counts(df, by, score, label)
    below = F.col("tot_neg") - F.col("cum_neg")
    wins = F.sum(F.col("pos") * (below.cast("double") + F.col("neg") / 2.0))
    return c.groupBy(*by).agg(
        F.max("tot_pos").alias("n_pos"), F.max("tot_neg").alias("n_neg"),
        F.round(F.try_divide(wins, F.max("tot_pos").cast("double") * F.max("tot_neg")), 6).alias("auc"),
    )


def avg_precision(df: DataFrame, by: Sequence[str] = ("split_set",), score: str = "prob", label: str = "target") -> DataFrame:
    """Step-wise average precision: precision at each score times the recall gained there."""
    c = _score_counts(df, by, score, label)
    step = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return c.groupBy(*by).agg(
        F.max("tot_pos").alias("n_pos"),
        F.round(F.try_divide(F.sum(step), F.max("tot_pos").cast("double")), 6).alias("avg_precision"),
    )


def finite(*columns: str) -> Column:
    """Neither NULL, NaN nor infinite in any of the columns."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return ok


ERROR_PROBS = (0.25, 0.50, 0.75, 0.90, 0.95)


def regression_report(
    df: DataFrame, by: Sequence[str] = ("split_set",), label: str = "horas", pred: str = "horas_pred"
) -> DataFrame:
    """Errors in hours and days, R2, shares within a day or two, and error percentiles.

    Rows that are not finite are left out of the metrics but counted in ``n``.
    """
    ok = finite(label, pred)
    y, e = F.when(ok, F.col(label)), F.when(ok, F.col(pred) - F.col(label))
    x = df.select(*by, y.alias("y"), e.alias("e"), ok.alias("ok"))
    near = {h: F.avg(F.when(F.col("e").isNull(), None).when(F.abs("e") <= h, 100.0).otherwise(0.0)) for h in (24, 48)}
    stats = x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("n_descartadas"),
        F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        (1 - F.try_divide(F.avg(F.col("e") * F.col("e")), F.var_pop("y"))).alias("r2"),
        near[24].alias("near24"), near[48].alias("near48"),
    )
    exact = percentiles(x, by, {"e": F.abs("e")}, {"e": ERROR_PROBS})
    return null_safe_join(stats, exact, list(by), "left").select(
        *by, "n", "n_descartadas",
        F.round("mae", 2).alias("mae_horas"), F.round("rmse", 2).alias("rmse_horas"),
        F.round(F.col("mae") / 24, 2).alias("mae_dias"), F.round(F.col("rmse") / 24, 2).alias("rmse_dias"),
        F.round("r2", 4).alias("r2"),
        F.round("near24", 2).alias("dentro_24h"), F.round("near48", 2).alias("dentro_48h"),
        *[F.round(percentile_name("e", p), 1).alias(f"error_p{round(p * 100)}") for p in ERROR_PROBS],
    )


def risk_shares(df: DataFrame, by: Sequence[str] = ("split_set",), levels: Sequence[float] = (0.7, 0.9)) -> DataFrame:
    """Share of orders at or above each probability."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.round(F.avg(F.when(F.col("prob") >= F.lit(p), 100.0).otherwise(0.0)), 2).alias(f"pct_ge_{round(p * 100)}")
            for p in levels
        ],
    )


def split_report(df: DataFrame) -> DataFrame:
    """Size, mean probability, predicted, real and hit percentages per split, in split order."""
    def pct(c: str) -> Column:
        return F.round(F.lit(100.0) * F.sum(c) / F.count(F.lit(1)), 2)

    order = F.array_position(F.array(*[F.lit(s) for s in SPLIT_ORDER]), F.col("split_set"))
    return (
        df.groupBy("split_set")
        .agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("prob").cast("double")), 4).alias("prob_media"),
            pct("pred").alias("pct_pred"), pct("target").alias("pct_real"), pct("hit").alias("accuracy"),
        )
        .orderBy(order)
    )


def category_report(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        df.groupBy("service_category")
        .agg(
            n.alias("n"), F.round(F.lit(100.0) * F.sum("target") / n, 2).alias("pct_real"),
            F.round(F.lit(100.0) * F.sum("hit") / n, 2).alias("accuracy"),
        )
        .orderBy(F.col("n").desc(), "service_category")
        .withColumn("service_category", F.coalesce("service_category", F.lit("(vacío)")))
    )


def split_sizes(dataset: DataFrame) -> DataFrame:
    """Rows and positive rate per split; mean, median and maximum of the hours."""
    hours = "target_horas_totales"
    exact = percentiles(dataset, ["split_set"], {"h": F.col(hours)}, {"h": [0.5]})
    base = dataset.groupBy("split_set").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("target_binario").cast("double")) * 100, 2).alias("pct_disrupted"),
        F.round(F.avg(hours), 4).alias("media_h"), F.max(hours).alias("max_h"),
    )
    return base.join(exact, "split_set", "left").select(
        *base.columns, F.round(percentile_name("h", 0.5), 4).alias("mediana_h")
    )


def class_distribution(df: DataFrame, target: Column, by: Sequence[str] = ("split_set",)) -> DataFrame:
    counts = df.groupBy(*by, target.alias("clase")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total, 2))


def binary_metrics(df: DataFrame, by: Sequence[str] = ("split_set",)) -> DataFrame:
    """Accuracy, and precision, recall, F1 of the positive class, with AUC: one row per metric."""
    scores = class_scores(confusion(df, by), by)
    one = F.col("clase") == 1
    flat = scores.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        *[F.max(F.when(one, F.col(c))).alias(o) for c, o in (("p", "precision"), ("r", "recall"), ("f", "f1"))],
    )
    flat = null_safe_join(flat, roc_auc(df, by).select(*by, "auc"), list(by))
    names = ["accuracy", "precision", "recall", "f1", "auc"]
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 4).alias("value")) for m in names])
    return flat.select(*by, F.explode(pairs).alias("m")).select(*by, "m.metric", "m.value")


def compare(versions: Mapping[str, DataFrame], by: Sequence[str] = ("split_set",)) -> DataFrame:
    """Metric tables of two versions side by side, with the change."""
    (old, a), (new, b) = versions.items()
    left = a.withColumnRenamed("value", old)
    right = b.withColumnRenamed("value", new)
    return null_safe_join(left, right, [*by, "metric"]).withColumn("delta", F.round(F.col(new) - F.col(old), 4))
