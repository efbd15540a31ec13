"""Rows with a fault: raised, or set aside in one pass.

A checked frame has a ``fault`` column, null for sound rows.  By default a
fault fails the job.  ``set_aside`` writes sound and faulty rows in one run of
the plan, to two parts of one table, so that a bad file does not hold up the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.session import scratch_path


def raise_faults(checked: DataFrame, *columns: str) -> DataFrame:
    """``checked``, in which a faulty row fails the job.  The check hangs on the
    columns that are used (``columns``, else the fault itself)."""
    failed = F.raise_error(F.concat(F.col("fault"), F.lit(" in "), F.coalesce("file", F.lit("?"))))
    guarded = set(columns or ["fault"])
    return checked.select(*(
        F.when(F.col("fault").isNotNull(), failed.cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in guarded else F.col(f.name) for f in checked.schema.fields))


def set_aside(checked: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sound rows, faulty rows), both read from the table written at ``path`` (a fresh folder
    of the shared space if not given); the plan runs once."""
    spark = checked.sparkSession
    path = path or scratch_path(spark, "set-aside")
    checked.withColumn("_faulty", F.col("fault").isNotNull()).write.partitionBy("_faulty").parquet(path)
    back = spark.read.schema(checked.withColumn("_faulty", F.lit(True)).schema).parquet(path)
    sound = back.where(~F.col("_faulty")).drop("_faulty", "fault")
    return sound, back.where("_faulty").drop("_faulty")


def fault_report(faulty: DataFrame, *keys: str) -> DataFrame:
    """(file, reason, n): the faults counted per file and kind (the text before the colon)."""
    keys = keys or ("file",)
    return faulty.groupBy(*keys, F.substring_index("fault", ":", 1).alias("reason")).agg(F.count("*").alias("n"))
