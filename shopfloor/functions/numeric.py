"""Exact ratios and means.

Dividing decimals and rounding afterwards rounds twice (once to the scale of the quotient, once to
the wanted places), and ``avg`` of an integer goes through floating point. The ratio is therefore
taken in whole numbers: ``(2 * scale * num ± den) div (2 * den)`` is the half-up quotient, as ``div``
cuts towards zero and the sign of the middle term is that of the result.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quotient(num: Column, den: Column, factor: Column, two: Column) -> Column:
    half = F.when((num < 0) == (den < 0), den).otherwise(-den)
    # A zero denominator gives NULL, never an error, as NULLIF(den, 0) would.
    return F.call_function("div", num * factor + half, F.nullif(den, F.lit(0)) * two)


def _shift(units: Column, places: int) -> Column:
    # At most 18 digits, which Spark keeps in 8 bytes.
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(18,{places})")


def row_ratio(num: Column, den: Column, places: int = 2, percent: bool = False) -> Column:
    """Half-up ``num / den`` of whole numbers of single rows; NULL where ``den`` is 0 or either side is NULL."""
    scale = 10**places * (100 if percent else 1)
    return _shift(_quotient(num.cast("bigint"), den.cast("bigint"), F.lit(2 * scale), F.lit(2)), places)


# Whole numbers below this bound can be multiplied by any scale used here within 64 bits.
_SAFE = 10**12


def ratio(num: Column, den: Column, places: int = 2, percent: bool = False) -> Column:
    """``row_ratio`` for sums of any size: beyond 64-bit arithmetic it goes on in wide decimals."""
    scale = 10**places * (100 if percent else 1)
    wide_num, wide_den = num.cast("decimal(28,0)"), den.cast("decimal(28,0)")
    wide = _shift(_quotient(wide_num, wide_den, F.lit(Decimal(2 * scale)), F.lit(Decimal(2))), places)
    safe = num.between(-_SAFE, _SAFE) & den.between(-_SAFE, _SAFE)
    return F.when(safe, row_ratio(num, den, places, percent)).otherwise(wide)


def percent(num: Column, den: Column, places: int = 2) -> Column:
    return ratio(num, den, places, percent=True)


def percent_half_even(num: Column, den: Column, places: int = 1) -> Column:
    """Percent of two non-negative counts, ties to the even digit."""
    scale = Decimal(100 * 10**places)
    n = num.cast("decimal(20,0)") * F.lit(scale)
    d = F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    units = F.call_function("div", n, d)
    twice = F.lit(Decimal(2)) * (n - units.cast("decimal(20,0)") * d)
    up = (twice > d) | ((twice == d) & (units % 2 == 1))
    return _shift(units + up.cast("bigint"), places)


def hundredths(value: Column) -> Column:
    """A two-place decimal as a whole number of hundredths."""
    return (value * F.lit(Decimal(100))).cast("bigint")


def sum_of_hundredths(pct: Column) -> Column:
    """Sum of a decimal(5,2) in hundredths.

    Added up as decimal(18,2), which takes 8 bytes and holds 10^14 values; the decimal(15,2) that
    ``sum`` would choose by itself fails after some 10^11.
    """
    return hundredths(F.sum(pct.cast("decimal(8,2)")))


def mean_of_hundredths(total: Column, count: Column, places: int = 2) -> Column:
    """Half-up mean from a sum of ``hundredths`` and the count of non-null values."""
    return ratio(total, count * 100, places)
