"""File names and files by URI."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(name: Column) -> Column:
    """'pbi.csv' -> 'pbi': the text before the first dot."""
    return F.split_part(name, F.lit("."), F.lit(1))


def file_system(uri: str):
    """(pyarrow file system, path in it) of a path or URI (local, HDFS, S3, ...)."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+://", uri):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def open_input(uri: str):
    """A file opened for reading at any place."""
    fs, path = file_system(uri)
    return fs.open_input_file(path)
