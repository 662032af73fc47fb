"""Durations and calendar features of timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000


def hours_between(start: Column, end: Column) -> Column:
    """Signed hours from start to end; NULL when either is missing."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(HOUR_MICROS).cast("double")


def parse_time(text: Column) -> Column:
    """Text to timestamp without zone; unreadable text becomes NULL."""
    return text.try_cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """ISO text with an optional trailing Z."""
    return parse_time(F.regexp_replace(text, "Z$", ""))


def weekday(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def day_band(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "manana").when(hour.between(12, 19), "tarde").otherwise("madrugada")
    )


# Weekday names, 0 = Sunday.
WEEKDAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]


def weekday_name(day: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.coalesce(F.get(names, day), day.cast("string"))
