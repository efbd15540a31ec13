"""Row-level pipelines run incrementally over newly landed files.

The reference rebuilds every output in full on each daily run.  For the
pipelines whose work is row by row (E5's filter and projection, E6/E7's
column exclusion) the same operators can instead run on the files that
arrived since the last run: a file-source stream with an ``availableNow``
trigger processes each landed file exactly once (tracked in the stream's
checkpoint in the shared folder) and stops.  Sorting (E5's newest-first
order) is not a streaming operation; it is applied when the sink is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from indicata.operators.filters import drop_all_null
from indicata.operators.projection import exclude, keep
from indicata.plans.pipelines import CASE_COLUMNS, CASE_MEASURES, INCIDENT_CODE_COLUMNS


def text_schema(columns: Sequence[str]) -> StructType:
    """All-text schema of a header CSV (streams need the schema up front)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def run_available(spark: SparkSession, source: str, schema: StructType,
                  transform: Callable[[DataFrame], DataFrame], sink: str,
                  checkpoint: str | None = None, sep: str = ",",
                  sink_format: str = "parquet") -> StreamingQuery:
    """Apply ``transform`` to every CSV file landed under ``source`` since the
    previous run, append the rows to ``sink``, and stop.

    The stream's progress is kept in ``checkpoint``, by default
    ``<sink>/_checkpoint`` (a hidden folder readers of the sink skip), so
    successive runs with the same sink see each landed file once.
    """
    stream = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
              .csv(source))
    query = (transform(stream).writeStream.format(sink_format).outputMode("append")
             .option("path", sink)
             .option("checkpointLocation", checkpoint or f"{sink.rstrip('/')}/_checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def cases_increment(df: DataFrame) -> DataFrame:
    """E5 without the sort: keep the case columns, drop rows with no count."""
    return drop_all_null(keep(df, *CASE_COLUMNS), CASE_MEASURES)


def incidents_increment(df: DataFrame) -> DataFrame:
    """The incident rows without the code columns."""
    return exclude(df, INCIDENT_CODE_COLUMNS)
