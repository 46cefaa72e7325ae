"""Ratios, rounding, codes and grid positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fablens import constants as K


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or ``default`` where b is 0 or either is NULL."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(default))


def pct(a: Column, b: Column, digits: int = 2) -> Column:
    """Share of a in b as a percentage; NULL when b is 0.

    Double arithmetic, divided first: every engine then sees the same ties.
    """
    return F.round(F.try_divide(a.cast("double"), b.cast("double")) * 100, digits)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def nan_to_null(value: Column) -> Column:
    """Missing readings are NULL everywhere; NaN would sort above every number."""
    return F.when(~F.isnan(value), value)


def is_unscored(p: Column) -> Column:
    """A risk that is NULL or NaN. Such a lot counts as flagged everywhere: it is held, not released."""
    return p.isNull() | F.isnan(p)


def sensor_alias(sensor_id: Column) -> Column:
    return F.format_string("sensor_%03d", sensor_id)


def sensor_code(sensor_id: Column) -> Column:
    return F.concat(F.lit("Attribute "), sensor_id.cast("string"))


def lot_code(production_id: Column) -> Column:
    """LOT_0001 style; ids above 9999 keep all their digits.

    Same text as ``LOT_%04d``, without a formatter call per row for the usual ids.
    """
    digits = production_id.cast("string")
    return (
        F.when(production_id > 9999, F.concat(F.lit("LOT_"), digits))
        .when(production_id >= 0, F.concat(F.lit("LOT_"), F.lpad(digits, 4, "0")))
        .otherwise(F.format_string("LOT_%04d", production_id))
    )


def percent_text(share: Column, digits: int) -> Column:
    """0.98 to '98.0%'."""
    return F.format_string(f"%.{digits}f%%", share * 100)


def grid_threshold(index: Column) -> Column:
    """Threshold number ``index`` (0-based) of the search grid."""
    return (index + F.lit(K.GRID_FIRST)) / F.lit(100.0)


def grid_index(p: Column) -> Column:
    """Index of the highest grid threshold that is <= p, -1 below the grid.

    The floor is only a first guess: float edges (0.29 * 100 is 28.999..) are
    settled by comparing p with the grid values themselves.
    """
    last = K.GRID_STEPS - 1
    guess = F.least(F.greatest(F.floor(p * 100).cast("int") - K.GRID_FIRST, F.lit(-1)), F.lit(last))
    return (
        F.when((guess < last) & (p >= grid_threshold(guess + 1)), guess + 1)
        .when((guess >= 0) & (p < grid_threshold(guess)), guess - 1)
        .otherwise(guess)
    )
