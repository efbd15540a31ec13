"""Column selection, exclusion, renaming and computed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame


def keep(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Keep the named columns, in the given order (P1).  Catalyst prunes the
    rest from the scan."""
    return df.select(*columns)


def exclude(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns, order of the rest kept; names that are not
    present are ignored (P2, P5)."""
    return df.drop(*list(names))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; the new name may be built from data, e.g. '<stem> 2023' (P3)."""
    return df.withColumnsRenamed(dict(mapping))

