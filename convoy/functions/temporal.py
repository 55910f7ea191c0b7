"""ISO-8601 reading and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. Spark's own cast also takes "2024", "12:30" and named zones, which are not ISO-8601 instants.
ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
ISO_COMPACT = r"^\d{8}(T\d{2}(\d{2}(\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def _from_compact(text: Column) -> Column:
    day = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    minutes = F.regexp_replace(day, r"T(\d{2})(\d{2})", "T$1:$2")
    return F.regexp_replace(minutes, r"(T\d{2}:\d{2})(\d{2})", "$1:$2")


def iso_timestamp(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, NULL where it is none."""
    known = F.when(text.rlike(ISO), text).when(text.rlike(ISO_COMPACT), _from_compact(text))
    return F.try_to_timestamp(F.replace(known, F.lit(","), F.lit(".")))


def date_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def hours_between(start: Column, end: Column) -> Column:
    """Hours from start to end, two decimals."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    # Hundredths of an hour are 36 million microseconds; half of that makes the division round half away from zero.
    hundredths = F.floor((F.abs(micros) + 18_000_000) / F.lit(36_000_000.0))
    return F.signum(micros.cast("double")) * hundredths / F.lit(100.0) + F.lit(0.0)


def date_parts(day: Column) -> dict[str, Column]:
    """Columns of the date dimension for a DATE column."""
    return {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "date": date_text(day),
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
    }
