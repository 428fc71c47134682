"""Order-independent aggregates for decimal-valued measures.

A floating-point sum depends on the order in which partial sums meet, and that
order changes with the number of input splits and shuffle partitions.  Money
amounts, durations in whole seconds and published means of rounded values are
decimal at heart, and their exact totals often fall precisely on a rounding
tie (``x.xx5``), so a double sum can round either way from one cluster layout
to the next.  These helpers quantise each value to integer units (micro-units
by default), add them as ``DECIMAL`` and round the exact fraction half away
from zero in integer arithmetic.  The result is identical for every
partitioning.

Nothing is clipped: units hold 28 digits, sums and products 38, and a value
beyond them raises under ANSI mode.  NaN and the infinities are kept out of the
units; their own plain sum is carried beside and, where there is one, is the
result, as it is that of a plain ``sum`` or ``avg``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_DIGITS = 6
RATIO_DIGITS = 9
_UNITS_TYPE = "decimal(28,0)"
_WIDE = "decimal(38,0)"
#: Below this a double times a power of ten still has room for the half that rounds it.
_PLAIN = float(2 ** 51)


def is_special(value: Column) -> Column:
    """Whether ``value`` is NaN or infinite (false for NULL)."""
    x = value.cast("double")
    return F.coalesce(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(False))


def special(value: Column) -> Column:
    """``value`` where it is NaN or infinite, else NULL: summed, it is what a plain sum of all values would be."""
    return F.when(is_special(value), value.cast("double"))


def wide(count: Column) -> Column:
    """A count or sum as a 38-digit integer, so that multiplying it can't overflow 64 bits."""
    return count.cast(_WIDE)


def units(value: Column, unit_digits: int = UNIT_DIGITS) -> Column:
    """``value`` as a whole number of ``10**-unit_digits`` units (exact integer decimal); NULL for NaN and infinities.

    ``floor(x * 10**d + 0.5)`` is plain floating-point arithmetic, several
    times cheaper per row than ``round`` (which goes through a decimal).  It
    passes through a 64-bit integer, so larger values, whole numbers of units
    already, go to the decimal directly.
    """
    scaled = value.cast("double") * float(10 ** unit_digits)
    plain = F.floor(scaled + 0.5).cast(_UNITS_TYPE)
    return F.when(F.abs(scaled) < _PLAIN, plain).when(~is_special(value), scaled.cast(_UNITS_TYPE))


def half_away_div(num: Column, den: Column) -> Column:
    """``num / den`` for integer-valued columns, rounded half away from zero; NULL unless ``den > 0``.

    ``a - pmod(a, b)`` is an exact multiple of ``b``, so the division is exact.
    """
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    a = F.abs(n) * 2 + d
    b = d * 2
    quotient = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    return F.when(d > 0, F.when(n < 0, -quotient).otherwise(quotient))


def rounded_ratio(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` (half away from zero) for integer-valued ``num``, ``den``, as double."""
    return half_away_div(num.cast("decimal(38,0)") * (10 ** digits), den).cast("double") / float(10 ** digits)


def exact_sum(value: Column, digits: int, unit_digits: int = UNIT_DIGITS) -> Column:
    """Aggregate: ``round(sum(value), digits)`` computed exactly; NULL when no value is set."""
    exact = rounded_ratio(F.sum(units(value, unit_digits)), F.lit(10 ** unit_digits), digits)
    return F.coalesce(F.sum(special(value)), exact)


def exact_avg(value: Column, digits: int, unit_digits: int = UNIT_DIGITS) -> Column:
    """Aggregate: ``round(avg(value), digits)`` computed exactly; NULL when no value is set."""
    u = units(value, unit_digits)
    exact = rounded_ratio(F.sum(u), wide(F.count(u)) * (10 ** unit_digits), digits)
    return F.coalesce(F.sum(special(value)), exact)


def exact_avg_minutes(seconds: Column, digits: int) -> Column:
    """Aggregate: mean of whole-second durations, in minutes, rounded exactly."""
    return rounded_ratio(F.sum(seconds.cast(_UNITS_TYPE)), wide(F.count(seconds)) * 60, digits)


def exact_avg_scaled(value: Column, scale: int, digits: int, unit_digits: int = RATIO_DIGITS) -> Column:
    """Aggregate: ``round(avg(value) * scale, digits)`` from ``10**-unit_digits`` units, exactly.

    For means of per-row ratios (shares, rates, speeds): each ratio is
    quantised to nanounits (error at most 5e-10 per row, far below the
    published digits), so the mean no longer depends on summation order.
    """
    u = units(value, unit_digits)
    exact = rounded_ratio(wide(F.sum(u)) * scale, wide(F.count(u)) * (10 ** unit_digits), digits)
    return F.coalesce(F.sum(special(value)), exact)
