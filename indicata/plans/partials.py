"""Averages over landed files, refreshed from the new files only.

For every landed file the state folder holds partial totals per key group (sum,
number of values, rows without one), written once when the file is first seen.
A refresh lists the files, reads those that are new or have changed (other size
or time), writes their partials as one run and then their lines in the list of
files, which makes them count: a run that fails in between leaves nothing that
counts.  A file landed again under its name replaces its partials.  Files that
have gone keep their share.  The result adds up partials, not rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicata.functions.numbers import round_half_up, to_number

FILES_DDL = "path string, length bigint, modified timestamp, run bigint"


def _files(spark: SparkSession, state: str) -> DataFrame:
    """The latest line of each file seen so far."""
    try:
        seen = spark.read.schema(FILES_DDL).parquet(f"{state}/files")
    except AnalysisException:  # the first run: no list yet
        seen = spark.createDataFrame([], FILES_DDL)
    newest = Window.partitionBy("path").orderBy(F.desc("run"))
    return seen.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def refresh(spark: SparkSession, landed: str, state: str, read: Callable[[list[str]], DataFrame],
            keys: Sequence[str], value: str) -> int:
    """Partials of the files under ``landed`` that are new or have changed; their number.

    ``read`` reads a list of paths; its rows must come from files (the source's
    ``_metadata.file_path`` tells which)."""
    listed = spark.read.format("binaryFile").load(landed).select(
        F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    seen = _files(spark, state)
    run = (seen.agg(F.max("run")).first()[0] or 0) + 1
    # Collected before they are read: a file that changes meanwhile has another time and is taken up again.
    found = listed.join(seen, ["path", "length", "modified"], "left_anti").orderBy("path").collect()
    if not found:
        return 0
    new = [r.path for r in found]
    number = to_number(value, "double")
    rows = read(new).select("*", F.col("_metadata.file_path").alias("_path"))
    rows.groupBy("_path", *keys).agg(
        F.sum(number).alias("total"), F.count(number).alias("n"), F.count(F.when(number.isNull(), 1)).alias("without")
    ).withColumnRenamed("_path", "path").write.mode("overwrite").parquet(f"{state}/partials/run={run}")
    lines = spark.createDataFrame([(r.path, r.length, r.modified, run) for r in found], FILES_DDL)
    lines.write.mode("append").parquet(f"{state}/files")
    return len(new)


def merged_average(spark: SparkSession, state: str, keys: Sequence[str], alias: str, scale: int = 2) -> DataFrame:
    """The rounded average per key group over all files seen, from their partials."""
    partials = spark.read.parquet(f"{state}/partials")
    valid = partials.join(_files(spark, state).select("path", "run"), ["path", "run"], "left_semi")
    mean = F.try_divide(F.sum("total"), F.sum("n"))
    return valid.groupBy(*keys).agg(round_half_up(mean, scale).alias(alias))
