"""Row filters (R1-R3).  All are plain predicates, so Catalyst pushes them
into Parquet scans and they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_all_null(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop a row only when every measure is null."""
    any_present = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures])
    return df.filter(any_present)


def keep_present(df: DataFrame, column: str) -> DataFrame:
    """Keep rows where ``column`` has a value (R2)."""
    return df.filter(F.col(column).isNotNull())


def non_empty_key(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose key is a non-empty text; null keys go too."""
    return df.filter(F.col(column) != F.lit(""))
