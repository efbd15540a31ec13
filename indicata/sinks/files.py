"""CSV sink and the CSV hand-off between stages (K1, K2)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.sources.csv import read_csv_text

# Fixed text format for dates written to CSV.
DATE_TEXT_FORMAT = "yyyy-MM-dd"


_TIMESTAMPS = ("timestamp", "timestamp_ntz")


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """A folder replaced by what ``write`` writes, which gets a staging folder next to it.

    Only when that has succeeded are the two swapped: the old folder is renamed, the new
    one takes its name, the old one is deleted.  A run that fails leaves the old output as it
    was; between the two renames there is none (a moment on a file system, longer in an object
    store, where renaming copies), and a failed second one puts the old folder back."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    mark = uuid.uuid4().hex[:12]
    # Names with an underscore in front are not seen by readers of the parent folder.
    staged, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{kind}-{target.getName()}-{mark}")
                   for kind in ("staged", "replaced"))
    try:
        write(staged.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"{path} cannot be renamed")
        if not fs.rename(staged, target):
            if had:
                fs.rename(old, target)
            raise OSError(f"{staged.toString()} cannot be renamed to {path}")
        if had:
            fs.delete(old, True)
    finally:
        if fs.exists(staged):
            fs.delete(staged, True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",",
              header: bool = True) -> None:
    """Header CSV directory, replaced on every run (K1): the old one stays until the new
    one is whole.  One file per task;
    timestamps written as 'yyyy-MM-dd HH:mm:ss', with the fraction of a second
    if there is one.  A table without columns lands as an empty file."""
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, lambda staged: write_csv(df, staged, "errorifexists", sep, header))
        return
    if not df.columns:
        df.sparkSession.createDataFrame([], "line string").coalesce(1).write.mode(mode).text(path)
        return
    cols = [F.col(f"`{f.name}`").cast("string").alias(f.name) if f.dataType.typeName() in _TIMESTAMPS
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    (df.select(*cols).write.mode(mode).option("header", header).option("sep", sep)
     .option("dateFormat", DATE_TEXT_FORMAT)
     .csv(path))


def csv_roundtrip(spark: SparkSession, df: DataFrame, path: str, sep: str = ",") -> DataFrame:
    """Write ``df`` as CSV and read it back: every column text, empty text
    and null both null (K1 + S1 = K2)."""
    write_csv(df, path, sep=sep)
    return read_csv_text(spark, path, sep=sep)


def as_text_table(df: DataFrame) -> DataFrame:
    """What a CSV round trip yields, without the files: every column cast to
    text (dates in the sink's formats), empty text -> null (K2)."""
    cols = []
    for field in df.schema.fields:
        name = field.name
        type_name = field.dataType.typeName()
        if type_name == "date":
            text = F.date_format(F.col(name), DATE_TEXT_FORMAT)
        else:
            text = F.col(name).cast("string")
        cols.append(F.nullif(text, F.lit("")).alias(name))
    return df.select(*cols)
