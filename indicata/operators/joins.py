"""Joins (J1-J3).

Strategy: the joins here are equi-joins, so Spark hashes or sorts on the
keys and never falls back to a nested loop.  No side is hinted: the planner
broadcasts at run time (AQE, ``spark.sql.autoBroadcastJoinThreshold``) only
a side measured to be small and otherwise sort-merge joins, splitting skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.dates import year_month_keys


def join_on_key(left: DataFrame, right: DataFrame, key: str | Sequence[str],
                how: str = "inner") -> DataFrame:
    """Equi-join on shared key column(s), kept once; null keys never match."""
    return left.join(right, on=key, how=how)


def join_year_month(monthly: DataFrame, monthly_ts: str, daily: DataFrame, daily_ts: str,
                    how: str = "inner") -> DataFrame:
    """Each monthly row joined to every daily row of the same year and month.

    The condition is an equality of expressions, which Catalyst extracts as
    hash/sort keys.  ``how='left_semi'`` keeps the months that have a daily row.
    """
    (ly, lm), (ry, rm) = year_month_keys(monthly[monthly_ts]), year_month_keys(daily[daily_ts])
    return monthly.join(daily, (ly == ry) & (lm == rm), how)


def join_all_on_key(frames: Sequence[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """Fold ``join`` over n frames on one key, left to right.

    All joins share the key, so after the first shuffle the running result is
    already hash-partitioned on it and each later join exchanges only the
    newly added side.
    """
    if not frames:
        raise ValueError("join_all_on_key needs at least one frame")
    return reduce(lambda a, b: a.join(b, on=key, how=how), frames)


GROUP_ROWS = 100_000  # rows of one key that are joined as one group
GROUP_PRODUCT = 1_000_000  # result rows of one key that are made from one group


def join_stems(long: DataFrame, stems: Sequence[str], key: str, value: str, names: Sequence[str], stem: str = "stem",
               group_rows: int = GROUP_ROWS, group_product: int = GROUP_PRODUCT) -> DataFrame:
    """The inner join of one frame per stem on ``key`` (J3), from a long table (stem, key, value)
    in one grouped pass: per key the values of each stem, then their product.

    A key has as many result rows as ``join_all_on_key`` gives it; null keys never match.  Keys of
    more than ``group_rows`` rows, or of more than ``group_product`` result rows, would make large
    groups: they are folded join by join."""
    which = F.array_position(F.array(*(F.lit(s) for s in dict.fromkeys(stems))), F.col(stem))
    rows = long.where(F.col(f"`{key}`").isNotNull() & F.col(stem).isin(list(stems))).select(
        F.col(f"`{key}`").alias("_key"), which.alias("_stem"), F.col(f"`{value}`").alias("_value"))
    large = _large_keys(rows, len(set(stems)), len(stems), group_rows, group_product)
    some = large is not None
    out = _grouped(rows.join(large, "_key", "left_anti") if some else rows, stems)
    if some:
        rest = rows.join(large, "_key", "left_semi")
        order = list(dict.fromkeys(stems))
        out = out.unionByName(join_all_on_key(
            [rest.where(F.col("_stem") == order.index(s) + 1).select("_key", F.col("_value").alias(f"_v{i}"))
             for i, s in enumerate(stems)], "_key"))
    return out.toDF(key, *names)


def _large_keys(rows: DataFrame, distinct: int, stems: int, group_rows: int, group_product: int) -> DataFrame | None:
    """The keys that are not to be joined as one group; None if there are none."""
    # Of n rows of k stems at most (n / k) ** k results can be made, so the number of rows per
    # key clears nearly all keys; the rows per stem are counted for the others alone.
    n, repeats = F.col("n"), -(-stems // distinct)
    most = repeats * distinct * F.log(n / distinct)
    doubtful = rows.groupBy("_key").agg(F.count("*").alias("n")).where(
        (n > group_rows) | (most > F.log(F.lit(group_product)))).select("_key")
    if doubtful.isEmpty():
        return None
    counts = rows.join(doubtful, "_key", "left_semi").groupBy("_key", "_stem").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("_key").agg(F.sum("n").alias("n"), (repeats * F.sum(F.log("n"))).alias("log_product"))
    large = sizes.where((n > group_rows) | (F.col("log_product") > F.log(F.lit(group_product)))).select("_key")
    return None if large.isEmpty() else large


def _grouped(rows: DataFrame, stems: Sequence[str]) -> DataFrame:
    """One shuffle on the key serves both groupings: values per (key, stem), then stems per key."""
    order = list(dict.fromkeys(stems))
    # Null values count as values: they are kept inside a struct.
    per_stem = rows.repartition("_key").groupBy("_key", "_stem").agg(F.collect_list(F.struct("_value")).alias("held"))
    per_key = per_stem.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_stem", "held"))).alias("held"))
    whole = per_key.where(F.size("held") == len(order))
    # Row i of a key's product takes value (i div stride) mod size of each stem.
    sizes = F.transform("held", lambda h: F.size(h["held"]).cast("long"))
    picked = F.transform(F.array(*(F.lit(order.index(s)) for s in stems)), lambda k: F.get("sizes", k))
    strides = F.aggregate(picked, F.array(F.lit(1).cast("long")),
                          lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) * n)))
    placed = whole.withColumn("sizes", sizes).withColumn("strides", strides)
    each = placed.select("_key", "held", "sizes", "strides",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.element_at("strides", -1) - 1)).alias("i"))
    columns = []
    for i, s in enumerate(stems):
        k = order.index(s)
        at = F.floor(F.col("i") / F.col("strides")[i]) % F.col("sizes")[k]
        columns.append(F.col("held")[k]["held"][at.cast("int")]["_value"].alias(f"_v{i}"))
    return each.select("_key", *columns)
