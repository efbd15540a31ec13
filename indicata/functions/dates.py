"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed output formats.
DAY_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: ColumnOrName, dtype: str = "timestamp") -> Column:
    """Text date -> timestamp, null when unreadable.

    Read in the session time zone; sessions made by :mod:`indicata.session`
    use UTC.  ``dtype='timestamp_ntz'`` keeps wall-clock values with no zone.
    """
    return _col(c).try_cast(dtype)


def year_month_keys(c: ColumnOrName) -> tuple[Column, Column]:
    """(year, month) of a date or timestamp."""
    col = _col(c)
    return F.year(col), F.month(col)


def format_day(c: ColumnOrName) -> Column:
    """Timestamp -> 'yyyy-MM-dd' text."""
    return F.date_format(_col(c), DAY_FORMAT)


def format_month(c: ColumnOrName) -> Column:
    """Timestamp -> 'yyyy-MM' period text."""
    return F.date_format(_col(c), MONTH_FORMAT)
