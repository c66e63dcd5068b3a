"""Null-safe arithmetic that gives the same answer on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is added up as whole ten-thousandths. A float sum depends on the order in
# which partial sums arrive, so a re-run after a lost executor could print another
# last digit; an integer sum cannot. The decimal type keeps it from overflowing.
PLACES, DIGITS = 4, 18

# Values are snapped to millionths before rounding, so that 0.1449999999999 and
# 0.145 (one computation, two summation orders) round the same way.
SNAP_PLACES = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ticks(c: Column | str, places: int, digits: int) -> Column:
    if digits > 28:  # a sum needs ten digits more
        raise ValueError("at most 28 digits")
    whole = F.rint(_col(c).cast("double") * 10**places)
    # Rounding through a long is several times cheaper than a double-to-decimal cast.
    return (whole.cast("bigint") if digits <= 18 else whole).cast(f"decimal({digits},0)")


def exact_sum(c: Column | str, places: int = PLACES, digits: int = DIGITS) -> Column:
    """Order-independent total, as a double.

    Every addend counts with ``places`` decimals; ask for more where a column is of finer
    grain than money. ``digits`` is the width of one addend in those units, up to 28: an
    addend that is wider raises an error, it is never cut.
    """
    return F.sum(_ticks(c, places, digits)).cast("double") / 10**places


def exact_sum_if(
    condition: Column | str, c: Column | str, places: int = PLACES, digits: int = DIGITS
) -> Column:
    """Total over the rows that satisfy ``condition`` (0 when none do)."""
    ticks = _ticks(c, places, digits)
    chosen = F.when(_col(condition), ticks).otherwise(F.lit(0).cast(f"decimal({digits},0)"))
    return F.sum(chosen).cast("double") / 10**places


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double; NULL when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def snap(c: Column | str) -> Column:
    """A double without its float noise: the nearest millionth."""
    return F.rint(_col(c) * 10**SNAP_PLACES) / 10**SNAP_PLACES


def round_to(c: Column | str, places: int) -> Column:
    """Half-up rounding of a double, stable against the last float digits.

    One rule for all sizes: the value as a decimal of six places, then rounded. What a
    decimal cannot hold (NaN, infinity, 32 digits before the point) has no digits to
    round and passes as it is.
    """
    value = _col(c).cast("double")
    snapped = value.try_cast(f"decimal(38,{SNAP_PLACES})")
    return F.coalesce(F.round(snapped, places).cast("double"), value)


def percent(numerator: Column | str, denominator: Column | str, places: int = 2) -> Column:
    """``numerator`` as a percentage of ``denominator``, rounded."""
    return round_to(ratio(numerator, denominator) * 100, places)


def zero_as(c: Column | str, replacement: Column | float | None) -> Column:
    """Replace zero (commonly a divisor) by ``replacement``; other values pass."""
    value = _col(c)
    substitute = replacement if isinstance(replacement, Column) else F.lit(replacement)
    return F.when(value == 0, substitute).otherwise(value)


def flag(condition: Column) -> Column:
    """0/1 integer from a predicate; an unknown (NULL) predicate counts as 0."""
    return F.when(condition, 1).otherwise(0)
