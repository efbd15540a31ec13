"""A join whose left side holds much of its rows under a few keys.

The frequent keys are found first: Spark's frequent-item summary (a bounded
number per task, no shuffle) names the candidates, an exact count of these
keeps those with more than ``HOT_SHARE`` of the rows, so there are at most
1 / ``HOT_SHARE`` of them.  Their rows are dealt over salts and the right
side's rows of these keys alone are copied to each salt; all other rows join
plainly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01
SALTS = 4  # per shuffle partition, so that the hash of (key, salt) spreads them evenly


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[str, list]:
    """Per key column, the values that more than ``share`` of the rows have (null is none)."""
    summary = df.stat.freqItems(list(keys), share).first()
    candidates = {k: [v for v in summary[i] if v is not None] for i, k in enumerate(keys)}
    # One row: the number of rows and of each candidate's.
    counts = [F.count(F.when(F.col(k) == F.lit(v), 1)).alias(f"{k}:{i}") for k in keys for i, v in enumerate(candidates[k])]
    row = df.agg(F.count("*").alias("rows"), *counts).first()
    return {k: [v for i, v in enumerate(candidates[k]) if row[f"{k}:{i}"] > share * row["rows"]] for k in keys}


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark will broadcast ``df`` in an equi-join by its own size check (estimated size
    under ``spark.sql.autoBroadcastJoinThreshold``); the keys' frequencies do not matter then."""
    session = df.sparkSession
    limit = session._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def join_spread(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``key``: plainly where ``right`` is broadcast, else with the
    hot keys of ``left`` found and dealt out."""
    hot = [] if is_broadcast(right) else hot_keys(left, [key])[key]
    return join_hot_keys(left, right, key, hot, how)


def join_hot_keys(left: DataFrame, right: DataFrame, key: str, hot: Sequence, how: str = "inner",
                  spread: Sequence[str] | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``key`` (inner or left), the rows of the ``hot`` keys of
    ``left`` dealt over ``SALTS`` parts a shuffle partition by a hash of the columns ``spread`` (all of them
    if not given)."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no salted join for {how}")
    if not hot:
        return left.join(right, key, how)
    salts = SALTS * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zero = F.lit(0).cast("long")
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    dealt = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*(spread or left.columns)), F.lit(salts))).otherwise(zero))
    copies = F.when(is_hot, F.sequence(zero, F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
    return dealt.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], how).drop("_salt")
