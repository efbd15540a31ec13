"""Incremental runs process each landed file exactly once."""

import os

from indicata.operators.ordering import sort_desc
from indicata.streaming import cases_increment, incidents_increment, run_available, text_schema
from tests.conftest import rows

HEADER = "location,date,total_cases,new_cases,iso_code\n"


def _land(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(HEADER + body)


def test_cases_incremental_exactly_once(spark, workdir):
    src, sink, ckpt = f"{workdir}/in", f"{workdir}/out", f"{workdir}/ckpt"
    schema = text_schema(["location", "date", "total_cases", "new_cases", "iso_code"])
    _land(src, "day1.csv", "AR,2024-01-01,,,ARG\nAR,2024-01-01,5,1,ARG\n")
    run_available(spark, src, schema, cases_increment, sink, ckpt)
    _land(src, "day2.csv", "BR,2024-01-02,7,,BRA\n")
    run_available(spark, src, schema, cases_increment, sink, ckpt)
    run_available(spark, src, schema, cases_increment, sink, ckpt)  # nothing new
    out = sort_desc(spark.read.parquet(sink), "date")
    assert out.columns == ["location", "date", "total_cases", "new_cases"]
    assert rows(out) == [("BR", "2024-01-02", "7", None), ("AR", "2024-01-01", "5", "1")]


def test_incidents_incremental(spark, workdir):
    src, sink, ckpt = f"{workdir}/in", f"{workdir}/out", f"{workdir}/ckpt"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("DR_NO,Date Rptd,AREA,Mocodes\n1,2024-01-01,Central,0344\n")
    schema = text_schema(["DR_NO", "Date Rptd", "AREA", "Mocodes"])
    run_available(spark, src, schema, incidents_increment, sink, ckpt)
    assert rows(spark.read.parquet(sink)) == [("Central",)]


def test_default_checkpoint_is_kept_with_the_sink(spark, workdir):
    src, sink = f"{workdir}/in", f"{workdir}/out"
    schema = text_schema(["location", "date", "total_cases", "new_cases", "iso_code"])
    _land(src, "day1.csv", "AR,2024-01-01,5,1,ARG\n")
    run_available(spark, src, schema, cases_increment, sink)
    _land(src, "day2.csv", "BR,2024-01-02,7,,BRA\n")
    run_available(spark, src, schema, cases_increment, sink)
    assert spark.read.parquet(sink).count() == 2


def test_incremental_equals_batch_on_driver_data(spark, workdir):
    from pyspark.sql import functions as F

    from indicata.plans.driver_queries import _cases
    from indicata.plans.pipelines import cases_with_counts
    from indicata.sinks import write_csv

    cases = _cases(spark, "/root/testdata/sf0.001")
    src, sink = f"{workdir}/in", f"{workdir}/out"
    schema = text_schema(cases.columns)
    # Two arrivals that together hold the whole table.
    write_csv(cases.filter(F.col("date") < "2024-01-15"), f"{src}/arrival1")
    run_available(spark, f"{src}/*", schema, cases_increment, sink)
    write_csv(cases.filter(F.col("date") >= "2024-01-15"), f"{src}/arrival2")
    run_available(spark, f"{src}/*", schema, cases_increment, sink)
    batch = cases_with_counts(cases.select([F.col(c).cast("string") for c in cases.columns]))
    assert sorted(rows(spark.read.parquet(sink)), key=str) == sorted(rows(batch), key=str)
