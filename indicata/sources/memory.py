"""In-memory rows -> DataFrame (S9).  For small lookup data only (factor
tables, fixtures); anything that grows with the input is read from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_to_frame(spark: SparkSession, rows: Sequence, schema: StructType | str | Sequence[str] | None = None) -> DataFrame:
    """``createDataFrame`` with an explicit schema or header list."""
    return spark.createDataFrame(list(rows), schema=schema)
