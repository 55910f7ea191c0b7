"""Conditions shared by several reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from convoy.functions.numeric import finite_or

# Speed limits in km/h.
MOVING_ABOVE = 5.0
POPUP_MOVING_FROM = 10.0
OVERSPEED_ABOVE = 70.0


def same_word(value: Column | str, word: str) -> Column:
    """Case-insensitive match with a lower-case word."""
    return F.lower(value) == F.lit(word)


def is_blank(value: Column | str) -> Column:
    """NULL or empty text."""
    column = F.col(value) if isinstance(value, str) else value
    return column.isNull() | (column.cast("string") == "")


def motion_status(speed: Column | str, moving_above: float = MOVING_ABOVE) -> Column:
    value = finite_or(F.col(speed) if isinstance(speed, str) else speed, 0.0)
    return F.when(value > moving_above, "Moving").when(value > 0, "Idle").otherwise("Stopped")


def popup_status(speed: Column | str, moving_from: float = POPUP_MOVING_FROM) -> Column:
    """The map's own rule: only exactly 0 is stopped, so a negative reading shows as idle."""
    value = F.coalesce(F.col(speed) if isinstance(speed, str) else speed, F.lit(0.0))
    return F.when(value == 0, "Stopped").when(value < moving_from, "Idle").otherwise("Moving")


def overspeed(speed: Column | str, limit: float = OVERSPEED_ABOVE) -> Column:
    """Above the limit, as two plain comparisons, so that the first reaches the files. NULL for a missing speed."""
    value = F.col(speed) if isinstance(speed, str) else speed
    return (value > limit) & ~F.isnan(value)
