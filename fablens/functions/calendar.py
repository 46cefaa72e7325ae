"""Time columns of a production run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fablens import constants as K

# Accepted text layouts, tried in this order: day first, then ISO.
TIMESTAMP_LAYOUTS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "dd/MM/yyyy",
    "yyyy-MM-dd",
)


def parse_ts_mixed(text: Column) -> Column:
    """Text in any of ``TIMESTAMP_LAYOUTS`` to a zone-free timestamp, NULL if none fits."""
    tries = [F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def assign_shift(ts: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when((hour >= 6) & (hour < 14), K.DAY_SHIFT)
        .when((hour >= 14) & (hour < 22), K.EVENING_SHIFT)
        .when(hour.isNotNull(), K.NIGHT_SHIFT)
    )


def run_date(ts: Column) -> Column:
    return F.to_date(ts)


def run_hour(ts: Column) -> Column:
    return F.hour(ts)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def week_of_year(day: Column) -> Column:
    """ISO week number."""
    return F.weekofyear(day)


def iso_year(day: Column) -> Column:
    """Year that the ISO week belongs to (2008-12-29 is in week 1 of 2009)."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def day_of_week(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day)
