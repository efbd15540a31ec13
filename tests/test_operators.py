"""DataFrame operators on small hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from indicata.operators import (drop_all_null, exclude, join_all_on_key, join_on_key,
                                join_year_month, keep_present, non_empty_key, one_row_per_key,
                                period_change, period_totals, sort_asc, sort_desc, top_n)
from tests.conftest import rows


def test_drop_all_null_keeps_rows_with_any_measure(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, None), ("c", None, 2.0), ("d", 3.0, 4.0)],
                               "k string, x double, y double")
    assert sorted(r[0] for r in rows(drop_all_null(df, ["x", "y"]))) == ["b", "c", "d"]


def test_keep_present_and_non_empty_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 2.0), (None, 3.0), ("d", None)], "k string, v double")
    assert sorted(r[0] for r in rows(non_empty_key(df, "k"))) == ["a", "d"]
    assert sorted(r[1] for r in rows(keep_present(df, "v"))) == [1.0, 2.0, 3.0]


def test_exclude_ignores_absent_names_and_keeps_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "DR_NO int, a int, `Crm Cd 1` int, b int")
    out = exclude(df, ["DR_NO", "Crm Cd 1", "Premis Cd"])
    assert out.columns == ["a", "b"]


def test_join_year_month_fans_out_within_month_only(spark):
    monthly = spark.createDataFrame(
        [(dt.datetime(2024, 1, 31), 1.0), (dt.datetime(2024, 2, 29), 2.0), (dt.datetime(2024, 3, 31), 3.0)],
        "m timestamp, v double")
    daily = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2), 10), (dt.datetime(2024, 1, 3), 11), (dt.datetime(2023, 1, 5), 12),
         (dt.datetime(2024, 2, 1), 13)], "d timestamp, r long")
    out = join_year_month(monthly, "m", daily, "d")
    got = sorted((r["v"], r["r"]) for r in out.collect())
    # March has no daily rows; January 2023 must not match January 2024.
    assert got == [(1.0, 10), (1.0, 11), (2.0, 13)]


def test_join_on_key_and_fold(spark):
    a = spark.createDataFrame([("AR", 1.0), ("BR", 2.0), ("CL", 3.0)], "k string, a double")
    b = spark.createDataFrame([("AR", 4.0), ("CL", 5.0), (None, 9.0)], "k string, b double")
    c = spark.createDataFrame([("CL", 6.0), ("AR", 7.0)], "k string, c double")
    assert sorted(rows(join_on_key(a, b, "k"))) == [("AR", 1.0, 4.0), ("CL", 3.0, 5.0)]
    out = sort_asc(join_all_on_key([a, b, c], "k"), "k")
    assert rows(out) == [("AR", 1.0, 4.0, 7.0), ("CL", 3.0, 5.0, 6.0)]


def test_period_totals_nulls_and_all_null_group(spark):
    df = spark.createDataFrame([("2017-01", 1.0, 1.0), ("2017-01", 2.0, None), ("2017-02", None, None)],
                               "p string, x double, y double")
    out = period_totals(df, "p", ("x", "total"), {"avg_y": "y"})
    assert sorted(rows(out, "p", "total", "avg_y")) == [("2017-01", 3.0, 1.0), ("2017-02", None, None)]


def test_period_change_first_period_and_zero_base(spark):
    df = spark.createDataFrame([("2017-01", 100.0), ("2017-02", 0.0), ("2017-03", 5.0), ("2017-04", 6.0)],
                               "p string, v double")
    out = period_change(df, "v", "p", "prev", "chg")
    assert rows(sort_asc(out, "p"), "p", "chg") == [("2017-01", None), ("2017-02", -100.0),
                                                    ("2017-03", None), ("2017-04", 20.0)]


def test_period_change_partitioned(spark):
    df = spark.createDataFrame([("a", "1", 10.0), ("a", "2", 11.0), ("b", "1", 20.0), ("b", "2", 10.0)],
                               "k string, p string, v double")
    out = period_change(df, "v", "p", "prev", "chg", partition_by=["k"])
    assert sorted(rows(out, "k", "p", "chg")) == [("a", "1", None), ("a", "2", 10.0),
                                                  ("b", "1", None), ("b", "2", -50.0)]


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("2024-01", 1.0, "x"), ("2024-01", 1.0, "y"), ("2024-02", 2.0, "z")],
                               "f string, v double, other string")
    assert sorted(rows(one_row_per_key(df, ["f"]), "f", "v")) == [("2024-01", 1.0), ("2024-02", 2.0)]
    picked = one_row_per_key(df, ["f"], order_by=["other"])
    assert picked.columns == df.columns
    assert sorted(rows(picked)) == [("2024-01", 1.0, "x"), ("2024-02", 2.0, "z")]


def test_sorts_and_top_n(spark):
    df = spark.createDataFrame([("2024-01-02", 1), (None, 2), ("2024-01-03", 3), ("2024-01-03", 0)],
                               "d string, i int")
    assert [r[0] for r in rows(sort_desc(df, "d", "i"), "d")] == ["2024-01-03", "2024-01-03", "2024-01-02", None]
    assert rows(sort_desc(df, "d", "i"), "i")[:2] == [(0,), (3,)]
    assert [r[0] for r in rows(sort_asc(df, "d"), "d")] == [None, "2024-01-02", "2024-01-03", "2024-01-03"]
    assert rows(top_n(df, 1, [F.col("i").desc()]), "i") == [(3,)]
