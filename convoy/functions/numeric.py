"""Exact sums, guarded ratios and two-decimal rounding.

Double sums depend on the order in which partitions arrive, and past about 1e13 they no longer hold cents. Sums are
therefore taken over whole numbers: the integer part and the millionths of every value, each as a 64-bit sum. Partial
sums merge to the same value in any order, and the per-row work is two long additions. A double holds millionths up to
about four billion; a larger value counts with what its double holds. A group with a value that this form can't carry is
summed as doubles instead, so that no reading is left out or cut.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(28,6)"
# A double such as 2.675 is stored a little below its text. Eight decimals bring it back before the half-up rounding.
RATIO = "decimal(38,8)"


def exact_sum(value: Column | str) -> Column:
    """The double next to the exact sum, or the plain double sum of a group that the exact form can't carry.

    It carries no value of 9e18 or more, none finer than a millionth, none that is not finite, and no total beyond 64 bits.
    """
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    carried = F.abs(number) < 9e18
    finite = F.when(carried, number)
    whole = finite.cast("bigint")  # towards zero, which leaves the fraction exact
    scaled = (finite - whole) * 1e6
    millionths = F.rint(scaled).cast("bigint")
    # a few units in the last place of a double are no finer value
    fine = F.abs(scaled - millionths) > F.abs(finite) * 1e-9
    odd = F.count_if(~carried | fine | F.isnan(number))
    wholes, rest = F.try_sum(whole), F.try_sum(millionths).cast("decimal(28,0)") * F.lit(Decimal("0.000001"))
    exact = (wholes.cast(TOTAL) + rest.cast(TOTAL)).cast("double")
    return F.when((odd > 0) | exact.isNull(), F.sum(number)).otherwise(exact)


def round2(value: Column) -> Column:
    """Half-up to two decimals, as a double. What has no place for cents, or is not finite, stays as it is."""
    return F.coalesce(F.round(value.try_cast(RATIO), 2).cast("double"), value.cast("double"))


def sum2(value: Column | str) -> Column:
    return round2(exact_sum(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals, NULL where there is nothing to share."""
    return round2(ratio(F.lit(100.0) * part, whole))


def mean2(total: Column, count: Column) -> Column:
    """Rounded mean from a carried total and count, so it can be merged over several levels."""
    return round2(ratio(total, count))


def finite_or(value: Column, default: float) -> Column:
    """Value, or the default where it is NULL or NaN. Spark sorts NaN above every number, so thresholds need this."""
    return F.nanvl(F.coalesce(value, F.lit(default)), F.lit(default))
