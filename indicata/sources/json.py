"""JSON readers.

Every record is a row (file, offset, text) first: an element of an array file
(read by byte ranges, see :mod:`indicata.sources.json_arrays`) or a line.  Its
text is parsed by Spark together with a mark put behind it, so that text after
the record is seen.  What is wrong is a ``fault``, by default raised; see
``json_records_checked`` and :mod:`indicata.sources.faults` to set it aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.numbers import truncate_to_long
from indicata.sources.faults import raise_faults
from indicata.sources.json_arrays import NO_LIST, SHOWN, SPLIT_BYTES, array_elements, array_ranges

NO_RECORD = "a JSON element is not a record: "
OUTSIDE = "record has keys outside the header: "
# Names around and behind a record's text; a text cannot close them without knowing them.
_AROUND, _BEHIND = "record-5e1c7a", "behind-90b2d4"


def json_texts(spark: SparkSession, path: str, multi_line: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, offset, text, fault): a row per array element, or per line that is not blank
    (offset: the place of the element, or of the line's split)."""
    if multi_line:
        return array_elements(spark, array_ranges(spark, path, split_bytes))
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
                        F.col("value").alias("text"), F.lit(None).cast("string").alias("fault")).where(F.trim("text") != "")


def _parsed(texts: DataFrame, kind: str) -> DataFrame:
    """``texts`` with ``rec`` of the Spark type ``kind``, null where there is a fault."""
    wrapped = F.concat(F.lit(f'{{"{_AROUND}":['), "text", F.lit(f'],"{_BEHIND}":1}}'))
    parsed = texts.withColumn("_p", F.from_json(wrapped, f"`{_AROUND}` array<{kind}>, `{_BEHIND}` int"))
    around, behind = F.col("_p").getField(_AROUND), F.col("_p").getField(_BEHIND)
    sound = parsed.withColumn("rec", F.when((F.size(around) == 1) & (behind == 1), F.get(around, F.lit(0))))
    bad = F.when(F.col("rec").isNull(), F.concat(F.lit(NO_RECORD), F.left("text", F.lit(SHOWN))))
    return sound.select("file", "offset", "rec", F.coalesce("fault", bad).alias("fault"))


def read_json_series(spark: SparkSession, path: str, value_type: str = "double",
                     multi_line: bool = True, date_field: str = "fecha",
                     value_field: str = "valor", tolerant: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``[{fecha, valor, ...}, ...]`` -> rows (fecha text, valor number).

    Extra keys are dropped.  ``valor`` is read as text and converted with
    ``try_cast`` so quoted numbers are accepted; ``value_type='long'``
    truncates towards zero (2.9 -> 2).  Text that is no JSON list of records fails the
    job, as does text after a record, and a missing or unreadable value unless
    ``tolerant`` (null then).  Array files are read by byte ranges, JSON Lines
    (``multi_line=False``) by Spark's splits.
    """
    texts = json_texts(spark, path, multi_line, split_bytes)
    df = raise_faults(_parsed(texts, f"struct<`{date_field}`:string,`{value_field}`:string>"), "rec").select("rec.*")
    value = truncate_to_long(value_field) if value_type == "long" else \
        F.col(value_field).try_cast(value_type)
    if not tolerant:
        shown = F.coalesce(F.col(value_field), F.lit("null"))
        value = F.coalesce(value, F.raise_error(F.concat(
            F.lit(f"unreadable {value_field}: "), shown, F.lit(" on "), F.coalesce(F.col(date_field), F.lit("null"))))
            .cast(value_type))
    return df.select(F.col(date_field), value.alias(value_field))


def first_record_keys(spark: SparkSession, path: str, multi_line: bool = True,
                      split_bytes: int = SPLIT_BYTES) -> list[str] | None:
    """The keys of the first record of the first file, by name, that has one; only
    its first range is read unless it holds no record."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), "path", "length").where("length > 0")
    after = None
    while True:
        left = files if after is None else files.where(F.col("path") > after)
        one = left.orderBy("path").first()
        if one is None:
            return None
        after = one.path
        if multi_line:
            ranges = array_ranges(spark, path, split_bytes).where(F.col("path") == after)
            parts = [array_elements(spark, r) for r in (ranges.where("start = 0"), ranges)]
        else:
            lines = json_texts(spark, path, False).where(F.col("file") == one.file)
            parts = [lines.where("offset = 0")]
        for texts in parts:
            found = _parsed(texts, "map<string,string>").where("rec is not null").orderBy("offset") if multi_line else \
                _parsed(texts, "map<string,string>").where("rec is not null")
            first = found.select(F.map_keys("rec").alias("keys")).first()
            if first is not None:
                return list(first["keys"])


def json_records_checked(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True,
                         strict: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The rows of ``read_json_records`` with file, offset and fault: a row per sound record
    (fault null) and per fault (columns null).  Nothing is raised."""
    texts = json_texts(spark, path, multi_line, split_bytes)
    recs = _parsed(texts.where(~F.coalesce(F.startswith("fault", F.lit(NO_LIST)), F.lit(False))), "map<string,string>")
    fault = F.col("fault")
    if strict:
        unknown = F.array_except(F.map_keys("rec"), F.array(*[F.lit(c) for c in columns]).cast("array<string>"))
        fault = F.coalesce(fault, F.when(F.size(unknown) > 0, F.concat(F.lit(OUTSIDE), F.array_join(unknown, ", "))))
        recs = recs.withColumn("fault", fault)

    def value(name: str) -> Column:
        return F.when(F.col("fault").isNull(), F.col("rec").getItem(name)).alias(name)

    return recs.select("file", "offset", "fault", *[value(c) for c in columns])


def read_json_records(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      multi_line: bool = True, strict: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """JSON records -> a table of text columns.

    Columns are ``columns`` or, when not given, the keys of the first record of the
    first file by name.  A record missing a key gives null there.  With
    ``strict`` a record with a key outside the columns fails the job, as do text
    that is not JSON, text after a record and an element that is no record.  A
    payload that is valid JSON but no list has no records.  Array files are read
    by byte ranges, JSON Lines (``multi_line=False``) by Spark's splits.
    """
    if columns is None:
        columns = first_record_keys(spark, path, multi_line, split_bytes)
        if columns is None:  # no records: only faults can be left
            faults = json_records_checked(spark, path, [], multi_line, False, split_bytes).where("fault is not null")
            return raise_faults(faults).where("fault is not null").select()
    checked = json_records_checked(spark, path, list(columns), multi_line, strict, split_bytes)
    return raise_faults(checked, *columns).select(*columns)
