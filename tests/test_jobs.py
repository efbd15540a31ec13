"""Jobs end to end: landed files in, CSV directories (and JDBC calls) out."""

import io
import json
import os
import zipfile

import pytest

from indicata.plans import jobs
from indicata.sources import read_csv_text
from tests.conftest import rows
from tests.test_sources import HEADER, PREAMBLE, _indicator_folder


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def _zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members:
            zf.writestr(name, text)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


@pytest.fixture()
def jdbc_calls(monkeypatch):
    calls = []
    monkeypatch.setattr(jobs, "write_jdbc",
                        lambda df, url, table, *a, **k: calls.append((url, table, df.count(), df.dtypes)))
    return calls


def test_indices_and_region_jobs(spark, workdir, jdbc_calls):
    m = _write(f"{workdir}/m.json", json.dumps([{"fecha": "2024-01-31", "valor": 20.6},
                                                {"fecha": "2024-02-29", "valor": 13.2}]))
    a = _write(f"{workdir}/a.json", json.dumps([{"fecha": "2024-01-31", "valor": 254.2},
                                                {"fecha": "2024-02-29", "valor": 276.2}]))
    r = _write(f"{workdir}/r.json", json.dumps([{"fecha": "2024-01-02", "valor": 1907.6},
                                                {"fecha": "2024-01-03", "valor": 1920},
                                                {"fecha": "2024-02-01", "valor": 1500}]))
    conn = {"url": "jdbc:postgresql://db/x", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    out = f"{workdir}/indices"
    e1 = jobs.indices_job(spark, m, a, r, out=out, jdbc=conn)
    back = read_csv_text(spark, out)
    assert back.columns == ["fecha_inflacion", "valor_mensual", "valor_anual", "fecha_riesgo", "valor_riesgo"]
    assert sorted(rows(back)) == sorted(tuple(None if v is None else str(v) for v in t) for t in rows(e1))
    assert ("2024-01-31", "20.6", "254.2", "2024-01-02", "1907") in rows(back)
    regions = jobs.region_jobs(spark, out, out_dir=f"{workdir}/regions", jdbc=conn)
    assert sorted(regions) == ["cordoba", "parana", "santafe"]
    assert sorted(rows(regions["cordoba"])) == [("2024-01-31", 6.18, 76.26), ("2024-02-29", 3.96, 82.86)]
    assert [c[1] for c in jdbc_calls] == ["indices", "indices_parana", "indices_santafe", "indices_cordoba"]
    assert dict(jdbc_calls[0][3])["valor_riesgo"] == "bigint"
    jobs.indices_job(spark, m, a, r, jdbc={**conn, "as_text": "true"})
    assert {t for _, t in jdbc_calls[-1][3]} == {"string"}


def test_ipc_job(spark, workdir):
    p = _write(f"{workdir}/ipc.csv", "Periodo;Indice_IPC;v_m_IPC;v_i_a_IPC\n"
               "2017-01;100,0;1,0;2,0\n2017-02;110,0;1,5;2,5\n2017-03;99,0;;\n")
    out = jobs.ipc_job(spark, p, out=f"{workdir}/ipc_out")
    assert rows(out) == [("2017-03", None, -10.0, None), ("2017-02", 1.5, 10.0, 2.5)]


def test_country_indicators_job_from_folder_and_archives(spark, workdir):
    folder = _indicator_folder(workdir)
    from_files = jobs.country_indicators_job(spark, f"{folder}/*.csv")
    zips = f"{workdir}/zips"
    for stem in ("pbi", "poblacion_total"):
        with open(f"{folder}/{stem}.csv") as f:
            body = f.read()
        _zip(f"{zips}/{stem}.zip", [(f"Metadata_{stem}.csv", "a,b\n1,2\n"), (f"API_{stem}_DS2.csv", body)])
    from_zips = jobs.country_indicators_job(spark, zips, from_archives=True)
    assert from_zips.columns == from_files.columns == ["Country Name", "pbi 2023", "poblacion_total 2023"]
    assert rows(from_zips) == rows(from_files)
    assert [r[0] for r in rows(from_files)] == ["Argentina", "Bahamas, The", "X"]


def test_covid_and_crime_jobs(spark, workdir):
    c = _write(f"{workdir}/covid.csv", "iso_code,location,date,total_cases,new_cases\n"
               "ARG,Argentina,2024-01-01,,\nARG,Argentina,2024-01-02,10,1\nBRA,Brazil,2024-01-03,,2\n")
    assert rows(jobs.covid_job(spark, c)) == [("Brazil", "2024-01-03", None, "2"), ("Argentina", "2024-01-02", "10", "1")]
    k = _write(f"{workdir}/crime.csv", "DR_NO,Date Rptd,DATE OCC,AREA,Crm Cd 1,Premis Cd,Status\n"
               "1,01/01/2024,01/01/2024,Central,510,101,IC\n")
    out = jobs.crime_job(spark, k)
    assert out.columns == ["DATE OCC", "AREA", "Status"]


def test_deposit_jobs(spark, workdir):
    r = _write(f"{workdir}/rates.json", json.dumps([{"entidad": "A", "logo": "a.png", "tnaClientes": 0.3,
                                                      "enlace": "x"}]))
    d = _write(f"{workdir}/dep.json", json.dumps([{"fecha": "2024-01-02", "valor": 35.5}]))
    rates, deps = jobs.deposit_jobs(spark, r, d, out_dir=f"{workdir}/dep_out")
    assert rows(rates) == [("A", "0.3")] and rows(deps) == [("2024-01-02", "35.5")]


def test_series_job_from_csv_and_archive(spark, workdir):
    text = ("catalogo_id,serie_id,dataset_id,distribucion_id,serie_titulo,serie_unidades,serie_descripcion,"
            "distribucion_descripcion,dataset_responsable,dataset_titulo,valor\n"
            'c,1,d,x,"IPC, total",Indice,desc,dd,Agency,Precios,1.00\n'
            'c,1,d,x,"IPC, total",Indice,desc,dd,Agency,Precios,1.01\n'
            "c,2,d,x,EMAE,Indice,desc,dd,Agency,Actividad,n/a\n")
    p = _write(f"{workdir}/series/series.csv", text)
    _zip(f"{workdir}/series_zip/dump.zip", [("readme.txt", "x\n"), ("series-tiempo.csv", text)])
    from_csv = jobs.series_job(spark, p)
    from_zip = jobs.series_job(spark, f"{workdir}/series_zip", from_archive=True)
    assert sorted(rows(from_csv), key=str) == sorted(rows(from_zip), key=str)
    got = {r[0]: r[-1] for r in rows(from_csv)}
    assert got == {"IPC, total": 1.01, "EMAE": None}


def test_ipc_job_latin1(spark, workdir):
    path = f"{workdir}/ipc_latin1.csv"
    with open(path, "w", encoding="latin-1") as f:
        f.write("Codigo;Descripcion;Periodo;Indice_IPC;v_m_IPC;v_i_a_IPC\n"
                "0;Nivel general - Región GBA;201701;100,0;1,0;2,0\n"
                "0;Nivel general - Región GBA;201702;102,0;2,0;2,0\n")
    out = jobs.ipc_job(spark, path, encoding="ISO-8859-1")
    assert rows(out) == [("201702", 2.0, 2.0, 2.0)]
