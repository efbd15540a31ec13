"""Window operators.

A window with no partition key sends every row to one task.  That is only
acceptable on an input that is already aggregated to one row per period
(bounded by the calendar); give ``partition_by`` for one series per key, or
take ``previous_row`` for one series of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.functions.numbers import percent_change
from indicata.session import scratch_path


def previous_value(df: DataFrame, value: str, order_by: str, alias: str,
                   partition_by: Sequence[str] | None = None) -> DataFrame:
    """Value of the previous period; null on the first period."""
    w = Window.orderBy(order_by) if not partition_by else \
        Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(alias, F.lag(value).over(w))


def previous_row(df: DataFrame, value: str, order_by: Sequence[str], alias: str) -> DataFrame:
    """``previous_value`` over one ordering of all rows, however many.

    The rows are cut into ranges of the ordering, written once, so that a range stays
    what it is; ``lag`` runs inside each range, and a range's first row gets the
    last value of the range before it (one row per range: those are collected, at most
    as many as there are shuffle partitions, and joined back by broadcast).  Rows that
    agree in all of ``order_by`` (nulls first) are ordered by a hash of the row, so that
    equal rows alone are interchangeable.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns))
    order = [*order_by, "_tie"]
    path = scratch_path(spark, "ranges")
    keyed.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    lasts = ranged.groupBy("_range").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("last"))
    found = sorted(((r["_range"], r["last"]["v"]) for r in lasts.collect()), key=lambda r: r[0])
    kind = df.schema[value].dataType.simpleString()
    handed = spark.createDataFrame([(after[0], before[1]) for before, after in zip(found, found[1:])],
                                   f"_range int, _handed {kind}")
    w = Window.partitionBy("_range").orderBy(*order)
    inside = ranged.withColumn(alias, F.lag(value).over(w)).withColumn("_place", F.row_number().over(w))
    return inside.join(F.broadcast(handed), "_range", "left").select(
        *df.columns, F.when(F.col("_place") == 1, F.col("_handed")).otherwise(F.col(alias)).alias(alias))


def period_change(df: DataFrame, value: str, order_by: str, previous_alias: str,
                  change_alias: str, partition_by: Sequence[str] | None = None,
                  scale: int = 2) -> DataFrame:
    """Percent change against the previous period, rounded (W1 + W2).

    The first period and a zero base give null.
    """
    with_prev = previous_value(df, value, order_by, previous_alias, partition_by)
    return with_prev.withColumn(change_alias, percent_change(value, previous_alias, scale))
