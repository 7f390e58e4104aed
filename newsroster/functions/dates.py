"""Date texts of search settings and results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip


def compact_date(text: Column) -> Column:
    """``YYYY-MM-DD`` (unpadded allowed) or ``YYYYMMDD`` to ``YYYYMMDD``; null if invalid."""
    value = strip(text)
    dashed = F.when(
        value.rlike(r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"),
        F.try_to_timestamp(value, F.lit("yyyy-M-d")))
    packed = F.when(value.rlike(r"^(?!0000)[0-9]{8}\z"), F.try_to_timestamp(value, F.lit("yyyyMMdd")))
    return F.date_format(F.when(value.contains("-"), dashed).otherwise(packed), "yyyyMMdd")


def iso_day(text: Column) -> Column:
    """First ten characters if they are a real day, else null."""
    day = F.left(text, F.lit(10))
    return F.when(
        day.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
        & F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull(), day)
