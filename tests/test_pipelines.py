"""The eight pipelines on fixture rows (FIXTURES.md edge cases)."""

import datetime as dt

import pytest

from indicata.plans.pipelines import (REGION_FACTORS, cases_with_counts, deposit_tables,
                                      incidents_without_codes, monthly_index_with_daily_risk,
                                      price_index_change, region_scaled_series, region_table,
                                      series_average)
from indicata.sources import read_csv_text
from tests.conftest import rows


def test_e3_price_index_change(spark, workdir):
    path = f"{workdir}/ipc.csv"
    with open(path, "w") as f:
        f.write("Periodo;Indice_IPC;v_m_IPC;v_i_a_IPC;Region\n"
                "2017-01;100,0;;;GBA\n"
                "2017-01;///;1,5;;NEA\n"
                "2017-02;1.234,5;1,5;2,0;GBA\n"      # unreadable index: null
                "2017-02;110,0;2,5;3,0;NEA\n"
                "2017-03;;;;GBA\n"                   # all null: no change, removed
                "2017-04;0,0;1,0;1,0;GBA\n"          # previous is null -> removed
                "2017-05;5,0;1,0;1,0;GBA\n")         # zero base -> removed
    out = price_index_change(read_csv_text(spark, path, sep=";"))
    assert out.columns == ["Periodo", "avg_ipc_mensual", "variacion_mensual", "avg_ipc_interanual"]
    assert rows(out) == [("2017-02", 2.0, 10.0, 2.5)]


def test_e1_month_join_and_formats(spark):
    monthly = spark.createDataFrame([("2024-01-31", 20.6), ("2024-02-29", 13.2), ("2024-03-31", 11.0)],
                                    "fecha string, valor double")
    yearly = spark.createDataFrame([("2024-01-31", 254.2), ("2024-02-29", 276.2)], "fecha string, valor double")
    risk = spark.createDataFrame([("2024-01-02", 1907), ("2024-01-03", 1920), ("2023-01-05", 2000),
                                  ("2024-02-01", 1500)], "fecha string, valor long")
    out = monthly_index_with_daily_risk(monthly, yearly, risk)
    got = rows(out)
    assert got[0] == ("2024-02-29", 13.2, 276.2, "2024-02-01", 1500)
    assert sorted(got[1:]) == [("2024-01-31", 20.6, 254.2, "2024-01-02", 1907),
                               ("2024-01-31", 20.6, 254.2, "2024-01-03", 1920)]


def test_e2_region_scaling(spark):
    e1 = spark.createDataFrame([("2024-01-31", 20.65, 254.2, "2024-01-02", 1907),
                                ("2024-01-31", 20.65, 254.2, "2024-01-03", 1920)],
                               "fecha_inflacion string, valor_mensual double, valor_anual double, "
                               "fecha_riesgo string, valor_riesgo long")
    out = region_scaled_series(e1)
    got = sorted(rows(out))
    assert got == [("cordoba", "2024-01-31", 6.2, 76.26), ("parana", "2024-01-31", 2.07, 25.42),
                   ("santafe", "2024-01-31", 4.13, 50.84)]
    assert [r for r, _ in REGION_FACTORS] == ["parana", "santafe", "cordoba"]
    assert region_table(out, "parana").columns == ["fecha_inflacion", "valor_mensual", "valor_anual"]


def test_e5_cases(spark):
    df = spark.createDataFrame([("AR", "2024-01-01", None, None, 1), ("AR", "2024-01-02", 5.0, None, 2),
                                ("BR", "2024-01-02", None, 1.0, 3), ("BR", "2024-01-03", 2.0, 3.0, 4)],
                               "location string, date string, total_cases double, new_cases double, x int")
    out = cases_with_counts(df)
    assert out.columns == ["location", "date", "total_cases", "new_cases"]
    got = rows(out)
    assert got[0] == ("BR", "2024-01-03", 2.0, 3.0)
    assert sorted(got[1:]) == [("AR", "2024-01-02", 5.0, None), ("BR", "2024-01-02", None, 1.0)]


def test_e6_incidents_missing_one_code_column(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", "x")], "DR_NO int, `Date Rptd` string, Mocodes string, "
                                                          "`Crm Cd 1` string, AREA string")
    assert incidents_without_codes(df).columns == ["AREA"]


def test_e7_deposit_tables(spark):
    rates = spark.createDataFrame([("A", "a.png", "0.3", "x")], "entidad string, logo string, tna string, enlace string")
    dep = spark.createDataFrame([("2024-01-02", "35.0")], "fecha string, valor string")
    r, d = deposit_tables(rates, dep)
    assert r.columns == ["entidad", "tna"] and d.columns == ["fecha", "valor"]


def test_e8_series_average_null_key_and_bad_value(spark):
    cols = ["catalogo_id", "serie_id", "dataset_id", "distribucion_id", "serie_titulo", "serie_unidades",
            "serie_descripcion", "distribucion_descripcion", "dataset_responsable", "dataset_titulo", "valor"]
    data = [("c", "s1", "d", "x", "t1", "u", "sd", "dd", "r", "dt", "1.00"),
            ("c", "s1", "d", "x", "t1", "u", "sd", "dd", "r", "dt", "1.01"),
            ("c", "s1", "d", "x", "t1", "u", "sd", "dd", "r", "dt", "n/a"),
            ("c", "s2", "d", "x", None, "u", "sd", "dd", "r", "dt", "4")]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    out = series_average(df)
    assert out.columns == ["serie_titulo", "serie_unidades", "serie_descripcion", "distribucion_descripcion",
                           "dataset_responsable", "dataset_titulo", "promedio_x_serie"]
    assert set(rows(out, "serie_titulo", "promedio_x_serie")) == {(None, 4.0), ("t1", 1.01)}


def test_e1_accepts_timestamps(spark):
    ts = dt.datetime(2024, 1, 31)
    m = spark.createDataFrame([(ts, 1.0)], "fecha timestamp, valor double")
    a = spark.createDataFrame([(ts, 2.0)], "fecha timestamp, valor double")
    r = spark.createDataFrame([(dt.datetime(2024, 1, 5), 3)], "fecha timestamp, valor long")
    assert rows(monthly_index_with_daily_risk(m, a, r)) == [
        ("2024-01-31", 1.0, 2.0, "2024-01-05", 3)]


@pytest.mark.parametrize("factor_name", ["parana", "santafe", "cordoba"])
def test_region_tables_are_one_row_per_month(spark, factor_name):
    e1 = spark.createDataFrame([("2024-01-31", 1.0, 1.0, "d", 1)] * 3 + [("2024-02-29", 2.0, 2.0, "d", 1)],
                               "fecha_inflacion string, valor_mensual double, valor_anual double, "
                               "fecha_riesgo string, valor_riesgo long")
    assert region_table(region_scaled_series(e1), factor_name).count() == 2
