"""Joins on columns that may hold NULL as a group value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join where NULL matches NULL; the key columns come from the left."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in on], *[c for c in right.columns if c not in on]
    )
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in on])
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{k}" for k in on])
