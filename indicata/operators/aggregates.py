"""Grouped aggregation (A1-A3).

Every aggregate here is algebraic (sum, count, avg, min_by, first), so
Spark computes a partial aggregate in each map task before the shuffle:
a key that holds a third of all rows still sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.numbers import round_half_up, to_number


def period_totals(df: DataFrame, period: str | Sequence[str], total: tuple[str, str],
                  averages: Mapping[str, str], scale: int = 2,
                  counts: Mapping[str, str] | None = None) -> DataFrame:
    """Group by period: the sum of one column and rounded averages of others (A1).

    ``total`` is (input column, output name); ``averages`` maps output name to
    input column.  Nulls are skipped; a group whose values are all null sums
    to null.  ``counts`` (output name -> count column) marks an average's
    input as partial sums over that many values, so rows pre-aggregated on a
    finer key combine exactly.
    """
    keys = [period] if isinstance(period, str) else list(period)
    counts = counts or {}
    aggs = [F.sum(total[0]).alias(total[1])]
    for out, src in averages.items():
        avg = F.try_divide(F.sum(src), F.sum(counts[out])) if out in counts else F.avg(src)
        aggs.append(round_half_up(avg, scale).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def group_average(df: DataFrame, keys: Sequence[str], value: str, alias: str, scale: int = 2) -> DataFrame:
    """Rounded average of a (possibly text) column per group.

    Text is read as double with ``try_cast``: unreadable values are skipped
    like nulls.  Null keys form their own group.
    """
    return df.groupBy(*keys).agg(round_half_up(F.avg(to_number(value, "double")), scale).alias(alias))


def one_row_per_key(df: DataFrame, keys: Sequence[str],
                    order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key (A3).

    Without ``order_by`` any row of the key is kept (``dropDuplicates``), which
    is repeatable when the other columns depend on the key only.  With
    ``order_by`` the row with the smallest ordering value is kept, computed
    as a partial ``min_by`` aggregate so the choice is repeatable.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    others = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in others]),
                      F.struct(*[F.col(c) for c in order_by])).alias("_row")
    return (df.groupBy(*keys).agg(picked)
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
            .select(*df.columns))
