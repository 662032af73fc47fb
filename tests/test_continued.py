"""Boosting period by period is judged whatever the number of validation rows."""

import pytest
from pyspark.sql import functions as F
from test_grown import _rows

from parcelpulse.operators import models
from parcelpulse.plans import catalog
from parcelpulse.plans.warehouse import Warehouse


@pytest.mark.parametrize("wrong", [False, True])
def test_few_validation_rows_are_judged(spark, monkeypatch, wrong):
    """120 validation rows whose labels are the other way round are worse than chance, however few they are."""
    rows = _rows(spark).where("split_set = 'train' or k % 25 = 0").withColumn("p", F.when(F.col("k") % 2 == 0, "a").otherwise("b"))
    if wrong:
        rows = rows.withColumn("target_binario", F.when(F.col("split_set") == "val", 1 - F.col("target_binario")).otherwise(F.col("target_binario")))
    fit = models.fit_risk_continued(rows, ["x", "y"], ["c"], models.TreeSettings(step=0.3, depth=3, min_rows=5), first=12, more=6, period="p")
    monkeypatch.setattr(catalog, "CONTINUED", (12, 6))
    monkeypatch.setattr(catalog, "_continued", lambda w: fit)

    class Own(Warehouse):
        dataset_with_history = rows

    got = [(r.arboles, r.perdida_ok) for r in catalog.continued_boosting_checked(Own(spark, "none")).collect()]
    assert got == [(13, not wrong), (6, not wrong)]
