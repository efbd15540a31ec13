"""Land data derived from the driver tables in the shapes the sources read.

Everything is written by Spark jobs into the shared folder
(``spark.checkpoint.dir``), a fresh location per call.  A task streams its rows
to the file it writes; archives and array files are rolled at a number of
bytes, so there are more of them, not larger ones, as the data grows.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pcsv
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.files import file_system
from indicata.session import scratch_path
from indicata.sinks.files import write_csv


ROLL_BYTES = 32 * 1024 * 1024


def _open_output(target: str):
    fs, path = file_system(target)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def _run(written: DataFrame) -> None:
    written.agg(F.sum("rows")).collect()  # one row: runs the writes


def land_csv(spark: SparkSession, df: DataFrame, name: str, sep: str = ",") -> str:
    path = scratch_path(spark, name)
    write_csv(df, path, sep=sep)
    return path


def land_lines(spark: SparkSession, lines: DataFrame, name: str, column: str = "line") -> str:
    """Write one text column as lines (e.g. JSON Lines)."""
    path = scratch_path(spark, name)
    lines.select(column).write.mode("overwrite").text(path)
    return path


def _indicator_lines(spark: SparkSession, long: DataFrame, key: str, year: str,
                     preamble: list[str], code: str | None,
                     repeat_header_for: str | None) -> DataFrame:
    """(stem, ord, line): the lines of one preamble-headed CSV per stem.

    Every field is quoted and each line ends with a comma, like the source
    format.  ``repeat_header_for`` appends a copy of the header line at the
    end of that stem's file.
    """
    header = ",".join(f'"{h}"' for h in [key, "Country Code", year]) + ","
    head = [(i, line) for i, line in enumerate(preamble)] + [(len(preamble), header)]
    fixed = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(line).alias("line")) for i, line in head])
    top = long.select("stem").distinct().select("stem", F.inline(fixed))
    q = lambda c: F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'))
    body = long.select(
        "stem",
        F.lit(len(preamble) + 1).alias("ord"),
        F.concat_ws(",", q(key), q(code) if code else F.lit('""'), q(year), F.lit("")).alias("line"),
    )
    lines = top.select("stem", "ord", "line").unionByName(body)
    if repeat_header_for is not None:
        lines = lines.unionByName(spark.createDataFrame([(repeat_header_for, 1_000_000, header)],
                                                        "stem string, ord int, line string"))
    return lines


def _stem_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[pa.Array]]]:
    """The rows of a task, sorted by stem, as (stem, line arrays) one by one."""
    held: list = []

    def lines(stem):
        while held or fill():
            first = held[0]
            n = int((first["stem"].to_numpy(zero_copy_only=False) == stem).sum())  # sorted: the first n
            if n:
                yield first["line"].slice(0, n)
            if n < first.num_rows:
                held[0] = first.slice(n)
                return
            held.pop(0)

    def fill() -> bool:
        for b in batches:
            if b.num_rows:
                held.append(b)
                return True
        return False

    while held or fill():
        stem = held[0]["stem"][0].as_py()
        yield stem, lines(stem)


def _stem_file_writer(base: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        for stem, arrays in _stem_runs(batches):
            with _open_output(f"{base}/{stem}.csv") as out:
                for a in arrays:
                    out.write(("\n".join(a.to_pylist()) + "\n").encode())
                    rows += len(a)
        yield pa.RecordBatch.from_pydict({"rows": [rows]})
    return write


def _stem_archive_writer(base: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        for stem, arrays in _stem_runs(batches):
            with _open_output(f"{base}/{stem}.zip") as out, \
                    zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
                zf.writestr(f"Metadata_{stem}.csv", "note\nmetadata only\n")
                with zf.open(f"API_{stem}_DS2.csv", "w") as member:
                    for a in arrays:
                        member.write(("\n".join(a.to_pylist()) + "\n").encode())
                        rows += len(a)
        yield pa.RecordBatch.from_pydict({"rows": [rows]})
    return write


def _by_stem(lines: DataFrame) -> DataFrame:
    """One stem's lines in order inside one task: a file has one writer, which
    streams them."""
    return lines.repartition("stem").sortWithinPartitions("stem", "ord", "line").select("stem", "line")


def land_preamble_folder(spark: SparkSession, long: DataFrame, key: str, year: str,
                         name: str, preamble: list[str], code: str | None = None,
                         repeat_header_for: str | None = None) -> str:
    """Write a (stem, key, code, value) table as one preamble-headed CSV per
    stem, ``<folder>/<stem>.csv``."""
    path = scratch_path(spark, name)
    lines = _indicator_lines(spark, long, key, year, preamble, code, repeat_header_for)
    _run(_by_stem(lines).mapInArrow(_stem_file_writer(path), schema="rows long"))
    return path


def land_indicator_archives(spark: SparkSession, long: DataFrame, key: str, year: str,
                            name: str, preamble: list[str], code: str | None = None,
                            repeat_header_for: str | None = None) -> str:
    """One zip archive per stem, holding the stem's preamble-headed CSV as
    its 'API' member next to a metadata member, as the source ships them."""
    path = scratch_path(spark, name)
    lines = _indicator_lines(spark, long, key, year, preamble, code, repeat_header_for)
    _run(_by_stem(lines).mapInArrow(_stem_archive_writer(path), schema="rows long"))
    return path


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    # An explicit partition count (AQE keeps it), hashed on every column so a
    # retried task sees the same rows.
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *df.columns)


def _zip_writer(base: str, label: str, member_prefix: str, extra_member: str, roll_bytes: int, members: int, turn_odd: bool,
                blank_lines: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = files = 0
        batch = next(batches, None)
        while batch is not None:
            name = f"{label}{part:05d}_{files:04d}"
            columns = batch.schema.names[::-1] if turn_odd and (part + files) % 2 else batch.schema.names
            with _open_output(f"{base}/archive_{name}.zip") as out, \
                    zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
                zf.writestr(f"{extra_member}_{name}.csv", "note\nmetadata only\n")
                if blank_lines:
                    zf.writestr(f"{member_prefix}_{name}_empty.csv", "")
                for k in range(members):
                    if batch is None:
                        break
                    size = 0
                    with zf.open(f"{member_prefix}_{name}_{k:05d}.csv", "w") as member:
                        if blank_lines:
                            member.write(b"\n \n")
                        writer = pcsv.CSVWriter(member, batch.select(columns).schema)
                        while batch is not None and size < roll_bytes:
                            writer.write_batch(batch.select(columns))
                            if blank_lines:
                                member.write(b"\n  \n")
                            rows, size = rows + batch.num_rows, size + batch.nbytes
                            batch = next(batches, None)
                        writer.close()
            files += 1
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    return write


def land_zip_archives(spark: SparkSession, df: DataFrame, name: str, member_prefix: str = "API",
                      extra_member: str = "Metadata", roll_bytes: int = ROLL_BYTES, turn_odd: bool = False,
                      blank_lines: bool = False, members: int = 1, path: str | None = None, label: str = "") -> str:
    """Zip archives of ``members`` CSV members (``<member_prefix>_...csv``) of about
    ``roll_bytes`` of rows each, and a member to be ignored.

    Streamed by the executors (``mapInArrow``, Arrow's CSV writer); a retried
    task rewrites the same archives.  ``turn_odd`` writes the columns of every
    other archive in reverse, ``blank_lines`` adds empty lines before the header and between
    records and a member without any.  More archives go to the same ``path`` under another ``label``.
    """
    path = path or scratch_path(spark, name)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // members)
    # An explicit partition count (AQE keeps it), hashed on every column so a
    # retried task sees the same rows.
    dealt = text.repartition(parts, *text.columns)
    _run(dealt.mapInArrow(_zip_writer(path, label, member_prefix, extra_member, roll_bytes, members, turn_odd, blank_lines),
                          schema="rows long"))
    return path


def _json_array_writer(base: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = files = 0
        batch = next(batches, None)
        while batch is not None:
            with _open_output(f"{base}/records_{part:05d}_{files:04d}.json") as out:
                size, opening = 0, b"["
                while batch is not None and size < roll_bytes:
                    if batch.num_rows:
                        data = ",\n".join(batch["json"].to_pylist()).encode()
                        out.write(opening + data)
                        rows, size, opening = rows + batch.num_rows, size + len(data), b",\n"
                    batch = next(batches, None)
                out.write(b"]\n" if opening != b"[" else b"[]\n")
            files += 1
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    return write


def land_stem_files(spark: SparkSession, df: DataFrame, stem: str, name: str, path: str | None = None) -> str:
    """CSV files ``<folder>/<stem>.csv`` with a header, one per value of the column ``stem``; files of
    the same name are written anew."""
    path = path or scratch_path(spark, name)
    columns = [c for c in df.columns if c != stem]
    body = df.select(F.col(stem).cast("string").alias("stem"), F.lit(1).alias("ord"), F.to_csv(F.struct(*columns)).alias("line"))
    head = df.select(F.col(stem).cast("string").alias("stem")).distinct().select(
        "stem", F.lit(0).alias("ord"), F.lit(",".join(columns)).alias("line"))
    _run(_by_stem(head.unionByName(body)).mapInArrow(_stem_file_writer(path), schema="rows long"))
    return path


def land_lines_by_stem(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Lines (stem, line) as text files in one folder per stem, ``<folder>/stem=<stem>``."""
    path = scratch_path(spark, name)
    lines.select("stem", F.col("line").alias("value")).write.partitionBy("stem").text(path)
    return path


def land_json_arrays(spark: SparkSession, df: DataFrame, name: str, roll_bytes: int = ROLL_BYTES,
                     files: int | None = None) -> str:
    """JSON array files of about ``roll_bytes``, records with every key (null
    fields kept), as API payloads are landed.  Records are serialised by Spark
    (``to_json``) and streamed by ``files`` tasks (one per shuffle partition if not given)."""
    path = scratch_path(spark, name)
    rec = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json")
    dealt = _spread(spark, df) if files is None else df.repartition(files, *df.columns)
    _run(dealt.select(rec).mapInArrow(_json_array_writer(path, roll_bytes), schema="rows long"))
    return path
