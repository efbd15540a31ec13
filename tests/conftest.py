import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from indicata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir is taken from the session's configuration;
    # local_session sets a fresh local folder only when it is unset.
    s = local_session("*", shuffle_partitions=8, app="indicata-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="indicata-test-")


def rows(df, *cols):
    """Rows as plain tuples, in the frame's order."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


# Spark type name -> DuckDB type name of the same values.
DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def norm(v):
    """A value in a form that compares exactly across Spark and DuckDB
    results (floats by their repr, timestamps as ISO text)."""
    import datetime as dt
    import math
    from decimal import Decimal

    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v
