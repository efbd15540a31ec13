"""Column expressions: parsing, rounding, tokens, file names."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from indicata.functions import (clean_tokens, field_by_name, file_stem, format_day,
                                parse_decimal_comma, parse_timestamp, percent_change,
                                round_half_up, scale_and_round_col, split_quoted, to_number,
                                truncate_to_long)
from tests.conftest import rows

# Fixed value: the plain token pattern of the source format.
QUOTED_TOKEN_PATTERN = r'(?:[^,"]|"(?:\\.|[^"])*")+'


def test_decimal_comma(spark):
    df = spark.createDataFrame([("100,0",), ("1,5",), ("///",), ("1.234,5",), ("",), (None,)], "t string")
    got = [r[0] for r in rows(df.select(parse_decimal_comma("t")))]
    assert got == [pytest.approx(100.0), pytest.approx(1.5), None, None, None, None]
    assert df.select(parse_decimal_comma("t")).schema[0].dataType.typeName() == "float"


@pytest.mark.parametrize("value,expected", [(1.005, 1.01), (-1.005, -1.01), (2.675, 2.68),
                                            (0.125, 0.13), (1.004999, 1.0), (None, None)])
def test_round_half_up(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert rows(df.select(round_half_up("x")))[0][0] == expected


def test_rounding_outside_the_decimal_range(spark):
    df = spark.createDataFrame([(3e28,), (float("nan"),), (float("inf"),), (-1e300,)], "x double")
    got = [r[0] for r in rows(df.select(round_half_up("x")))]
    assert got[0] == 3e28 and got[1] != got[1] and got[2:] == [float("inf"), -1e300]
    scaled = [r[0] for r in rows(df.select(scale_and_round_col("x", F.lit("0.5"))))]
    assert scaled[0] == 1.5e28 and scaled[1] != scaled[1] and scaled[2:] == [float("inf"), -5e299]


def test_scale_and_round_exact_tenths(spark):
    df = spark.createDataFrame([(150.15,), (45.05,), (3.0,)], "x double")
    got = [r[0] for r in rows(df.select(scale_and_round_col("x", F.lit("0.1"))))]
    assert got == [15.02, 4.51, 0.3]


def test_percent_change_zero_and_missing_base(spark):
    df = spark.createDataFrame([(Decimal("110.00"), Decimal("100.00")), (Decimal("5.00"), Decimal("0.00")),
                                (Decimal("5.00"), None)], "cur decimal(18,2), prev decimal(18,2)")
    assert [r[0] for r in rows(df.select(percent_change("cur", "prev")))] == [10.0, None, None]


def test_truncate_to_long(spark):
    df = spark.createDataFrame([("2.9",), ("-2.9",), ("69",), ("abc",), (None,)], "v string")
    assert [r[0] for r in rows(df.select(truncate_to_long("v")))] == [2, -2, 69, None, None]


def test_to_number_text_to_double(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("x",)], "v string")
    assert [r[0] for r in rows(df.select(to_number("v")))] == [1.5, 2.0, None]


def test_timestamp_parse_and_format(spark):
    df = spark.createDataFrame([("2024-03-31",), ("2024-03-31 10:00:00",), ("31/03/2024",)], "t string")
    out = df.select(format_day(parse_timestamp("t")).alias("d"))
    assert [r[0] for r in rows(out)] == ["2024-03-31", "2024-03-31", None]


TOKEN_CASES = [
    ('"Bahamas, The","BHS","1.5",', ["Bahamas, The", "BHS", "1.5"]),
    ('"X","XXX","",', ["X", "XXX", ""]),
    ('a,,b', ["a", "b"]),
    ('"","YYY","3"', ["", "YYY", "3"]),
    ('  padded  , "q" ', ["padded", "q"]),
]


@pytest.mark.parametrize("line,expected", TOKEN_CASES)
def test_split_and_clean_tokens(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert rows(df.select(clean_tokens(split_quoted("line"))))[0][0] == expected


def test_tokens_match_python_rule_on_random_lines(spark):
    import random
    import re
    rnd = random.Random(7)
    lines = []
    for _ in range(300):
        fields = []
        for _ in range(rnd.randint(1, 6)):
            body = "".join(rnd.choice(['a', 'b', ' ', '1', '.', ',']) for _ in range(rnd.randint(0, 5)))
            fields.append(f'"{body}"' if rnd.random() < 0.5 else body.replace(",", ""))
        lines.append(",".join(fields))
    df = spark.createDataFrame([(ln,) for ln in lines], "line string")
    got = [r[0] for r in rows(df.select(split_quoted("line")))]
    want = [re.findall(QUOTED_TOKEN_PATTERN, ln) for ln in lines]
    assert got == want


def test_tokens_long_quoted_field(spark):
    long_field = "x" * 30_000
    df = spark.createDataFrame([(f'"{long_field}","b"',)], "line string")
    got = rows(df.select(clean_tokens(split_quoted("line"))))[0][0]
    assert got == [long_field, "b"]


def test_field_by_name(spark):
    df = spark.createDataFrame([(["a", "b"], ["Country Name", "2023"])],
                               "tokens array<string>, header array<string>")
    out = df.select(field_by_name("tokens", "header", "2023").alias("y"),
                    field_by_name("tokens", "header", "missing").alias("m"))
    assert rows(out) == [("b", None)]


def test_file_stem(spark):
    df = spark.createDataFrame([("pbi.csv",), ("pbi_percapita.2023.csv",), ("noext",)], "f string")
    assert [r[0] for r in rows(df.select(file_stem(F.col("f"))))] == ["pbi", "pbi_percapita", "noext"]


@pytest.mark.parametrize("line,expected", [
    ('a,,b', ["a", "", "b"]),
    ('"Bahamas, The","BHS","",', ["Bahamas, The", "BHS", "", ""]),
    ('"say ""hi""",x', ["say hi", "x"]),
    ('x', ["x"]),
    (',a,b', ["", "a", "b"]),
    (',', ["", ""]),
    ('', [""]),
    ('a"b,c', ["ab", "c"]),
])
def test_split_keep_empty_fields(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert rows(df.select(clean_tokens(split_quoted("line", keep_empty=True))))[0][0] == expected


def test_keep_empty_long_field(spark):
    long_field = "y" * 30_000
    df = spark.createDataFrame([(f'"{long_field}",,"b"',)], "line string")
    assert rows(df.select(clean_tokens(split_quoted("line", keep_empty=True))))[0][0] == [long_field, "", "b"]
