"""Sorts and first-n (O1-O3).  A global sort plans as a range-partitioned
exchange; ``orderBy(...).limit(n)`` plans as a per-task top-n followed by one
merge of n rows per task (TakeOrderedAndProject)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, key: str, *tie_break: str) -> DataFrame:
    """Descending on ``key`` with nulls last, then ascending tie-breaks (O1)."""
    return df.orderBy(F.col(key).desc_nulls_last(), *[F.col(t).asc() for t in tie_break])


def sort_asc(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending, nulls first (O2)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First ``n`` rows of a sort (O3, K4)."""
    return df.orderBy(*order).limit(n)
