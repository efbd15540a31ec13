"""Number parsing and rounding as built-in column expressions.

Spark 4 runs with ANSI mode on: a bad cast or a zero divisor raises.  The
pipelines rely on the pre-ANSI behaviour (null instead), so every cast of
text here is a ``try_cast`` and every division a ``try_divide``; ANSI mode
itself is left on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Rounding is done on a decimal copy of the value: ``round(double)`` in Spark
# rounds the shortest decimal text of the double, other engines round the
# binary value, and the two disagree on ties such as 1.005.  A decimal with
# ten places absorbs last-bit noise from summation order, then HALF_UP
# (away from zero) rounding gives one answer everywhere.  Values outside the
# decimal's range, NaN and infinities are rounded as doubles.
ROUNDING_TYPE = "decimal(38,10)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: ColumnOrName, dtype: str = "double") -> Column:
    """Text (or any type) -> number, null when the text is not a number."""
    return _col(c).try_cast(dtype)


def parse_decimal_comma(c: ColumnOrName, dtype: str = "float") -> Column:
    """'1234,5' -> 1234.5 (F1).

    Every comma becomes a dot before the cast, so '1.234,5' (two
    separators), '///' and '' all give null.  ``translate`` is a per-char
    map and cheaper than a regex replace.
    """
    return F.translate(_col(c), ",", ".").try_cast(dtype)


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """Round half away from zero to ``scale`` places, result double (F2)."""
    exact = F.round(_col(c).try_cast(ROUNDING_TYPE), scale).cast("double")
    return F.coalesce(exact, F.round(_col(c).cast("double"), scale))


def scale_and_round_col(c: ColumnOrName, factor: ColumnOrName, scale: int = 2) -> Column:
    """``round(c * factor, scale)`` with the product taken in decimal (F8).

    The factor is used as the decimal written, so 0.1 is exactly one tenth.
    """
    number, by = _col(c), _col(factor).cast("decimal(12,6)")
    exact = F.round(F.try_multiply(number.try_cast(ROUNDING_TYPE), by), scale).cast("double")
    return F.coalesce(exact, F.round(number.cast("double") * by.cast("double"), scale))


def truncate_to_long(c: ColumnOrName) -> Column:
    """Number -> long, truncating towards zero like Python's ``int``.

    Text is read as a double first, so '2.9' and '"69"'-style values that a
    long schema would null out are kept.
    """
    col = _col(c)
    return col.try_cast("double").try_cast("long")


def percent_change(current: ColumnOrName, previous: ColumnOrName, scale: int = 2) -> Column:
    """``round((current - previous) / previous * 100, scale)``; null for a
    missing or zero base (F9, W2).

    The difference is taken in the input type (exact for decimals); the
    ratio in double.  A decimal quotient of two wide decimals keeps only six
    places in Spark, which would round values next to a tie twice.
    """
    cur, prev = _col(current), _col(previous)
    ratio = F.try_divide((cur - prev).cast("double"), prev.cast("double"))
    return round_half_up(ratio * F.lit(100.0), scale)


def default_zero(c: ColumnOrName) -> Column:
    """Null -> 0, value kept otherwise."""
    return F.coalesce(_col(c), F.lit(0).cast("float"))
