"""First-n report (K4).  Returns a DataFrame; nothing is printed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from indicata.operators.ordering import top_n


def first_n(df: DataFrame, n: int = 20, order: Sequence | None = None) -> DataFrame:
    """The first ``n`` rows; after a sort this is a top-n (K4)."""
    return top_n(df, n, order) if order else df.limit(n)
