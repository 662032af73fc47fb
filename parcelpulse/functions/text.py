"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(" \t\r\n\f\v"))
