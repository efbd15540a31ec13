"""indicata — indicator and time-series tables built as Spark DataFrame plans.

Sub-packages:
  sources    typed readers for landed CSV, JSON, preamble-headed and zipped files
  functions  column expressions (number/date parsing, rounding, tokenising)
  operators  DataFrame -> DataFrame building blocks (projection, filters, joins,
             aggregation, windows, ordering)
  sinks      CSV, JDBC and first-n outputs
  plans      the eight end-to-end pipelines and the driver-table queries
  streaming  the row-level pipelines run incrementally over newly landed files
"""

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming"]


def _ship_by_value() -> None:
    """Functions of this package that run on executors (``mapInArrow``,
    ``applyInPandas``) are pickled with their code, so executors need not
    have the package on their path."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark always ships it
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
