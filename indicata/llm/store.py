"""Written tables in the cluster's shared folder, used to cut lineage.

A frame is written once as Parquet under ``spark.checkpoint.dir`` and read
back: every later use scans the files, so a lost executor costs a re-read
and never a recomputation of the steps before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, MapType, StructType

from indicata.session import scratch_path


BATCH_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts are long: hand them to Python in batches of at most ``BATCH_ROWS`` rows
    (the session's setting is lowered if it is larger), so that an executor holds
    a few MB of them per task outside its heap."""
    rows = int(spark.conf.get(BATCH_ROWS_CONF))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(BATCH_ROWS_CONF, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared scratch space, reread."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(kind):
    """The type with every field nullable, as files are read."""
    if isinstance(kind, StructType):
        out = StructType()
        for f in kind.fields:
            out.add(f.name, _nullable(f.dataType), True)
        return out
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind
