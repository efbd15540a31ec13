"""Property tests: Spark expressions against plain-Python statements of the
same rules, on generated inputs (one Spark job per generated batch)."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicata.functions import parse_decimal_comma, round_half_up, scale_and_round_col, split_quoted
from tests.conftest import rows

# Fixed value: the plain token pattern of the source format.
QUOTED_TOKEN_PATTERN = r'(?:[^,"]|"(?:\\.|[^"])*")+'

SETTINGS = settings(max_examples=15, deadline=None)

cents = st.integers(min_value=-10**9, max_value=10**9)


@SETTINGS
@given(st.lists(st.tuples(cents, st.integers(min_value=1, max_value=9)), min_size=1, max_size=50))
def test_round_half_up_of_exact_quotients(spark, pairs):
    # values with three decimals (ties at the third place happen often)
    values = [Decimal(a) / Decimal(10) ** (1 + b % 2) / Decimal(100) for a, b in pairs]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r[0] for r in rows(df.select(round_half_up("x")))]
    want = [float(Decimal(repr(float(v))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=50), st.sampled_from(["0.1", "0.2", "0.3"]))
def test_scale_and_round_is_exact_decimal(spark, values, factor):
    xs = [Decimal(v) / 100 for v in values]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in rows(df.select(scale_and_round_col("x", F.lit(factor))))]
    want = [float((x * Decimal(factor)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for x in xs]
    assert got == want


def _python_decimal_comma(text):
    t = text.replace(",", ".")
    if not re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)\s*", t):
        return None
    return float(t)


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789,.- /", max_size=8), min_size=1, max_size=50))
def test_decimal_comma_parse(spark, texts):
    import numpy as np
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows(df.select(parse_decimal_comma("t", "double")))]
    want = [_python_decimal_comma(t) for t in texts]
    assert [None if g is None else float(np.float64(g)) for g in got] == want


@SETTINGS
@given(st.lists(st.text(alphabet='ab ,"', max_size=25), min_size=1, max_size=40))
def test_tokens_equal_source_rule_on_quote_balanced_lines(spark, lines):
    # The possessive pattern equals the source rule wherever quotes pair up.
    lines = [ln for ln in lines if ln.count('"') % 2 == 0]
    if not lines:
        return
    df = spark.createDataFrame([(ln,) for ln in lines], "line string")
    got = [r[0] for r in rows(df.select(split_quoted("line")))]
    assert got == [re.findall(QUOTED_TOKEN_PATTERN, ln) for ln in lines]


@SETTINGS
@given(st.lists(st.lists(st.text(alphabet='ab ,"', max_size=6), min_size=1, max_size=6), min_size=1, max_size=30))
def test_keep_empty_fields_equal_pythons_csv(spark, records):
    import csv
    import io

    lines = []
    for r in records:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator="").writerow(r)
        lines.append(out.getvalue())
    df = spark.createDataFrame([(ln,) for ln in lines], "line string")
    got = [r[0] for r in rows(df.select(split_quoted("line", keep_empty=True)))]
    plain = [[f[1:-1].replace('""', '"') if f.startswith('"') else f for f in r] for r in got]
    assert plain == [next(csv.reader([ln]), [""]) or [""] for ln in lines]
