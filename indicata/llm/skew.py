"""A join to a table of per-key values in which a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 1000  # a key is hot with more than 1/1000 of the rows, so at most 1000 keys are


def salted_join(rows: DataFrame, values: DataFrame, key: str, count: str, spread: str) -> DataFrame:
    """``rows`` left-joined to ``values`` on ``key``.

    ``values`` (a written table, one row per key) says in ``count`` how many rows
    each key has.  The hot keys, at most ``HOT_PARTS`` by their definition, are
    broadcast to mark their rows; these, and rows without a key, are dealt by a hash
    of ``spread`` over the shuffle partitions, and only the hot keys' values are
    copied to them."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = values.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT_PARTS > total
    marked = rows.join(F.broadcast(values.where(hot).select(key, F.lit(True).alias("_hot"))), key, "left")
    marked = marked.withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(parts)))
                               .otherwise(F.lit(0).cast("long"))).drop("_hot")
    copies = F.when(hot, F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))) \
        .otherwise(F.array(F.lit(0).cast("long")))
    dealt = values.withColumn("_salt", F.explode(copies)).drop(count)
    return marked.join(dealt, [key, "_salt"], "left").drop("_salt")
