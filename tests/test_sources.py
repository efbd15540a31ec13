"""Readers on small fixture files written by the tests."""

import io
import json
import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from indicata.sinks import as_text_table, csv_roundtrip, first_n, write_csv
from indicata.sources import (folder_stems, member_layouts, member_table, read_csv_text,
                              read_csv_typed, read_indicator_folder, read_json_records,
                              read_json_series, read_preamble_lines, read_zip_members,
                              rows_to_frame)
from tests.conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_csv_text_empty_and_quoted_empty_are_null(spark, workdir):
    p = _write(f"{workdir}/cases.csv",
               'location,date,total_cases,new_cases\nAR,2024-01-02,,""\nBR,2024-01-01,1.0,2\n')
    df = read_csv_text(spark, p)
    assert df.dtypes == [(c, "string") for c in ["location", "date", "total_cases", "new_cases"]]
    assert sorted(rows(df)) == [("AR", "2024-01-02", None, None), ("BR", "2024-01-01", "1.0", "2")]


def test_csv_semicolon(spark, workdir):
    p = _write(f"{workdir}/ipc.csv",
               "Periodo;Indice_IPC;v_m_IPC;v_i_a_IPC\n2017-01;100,0;;\n2017-01;///;1,5;\n")
    df = read_csv_text(spark, p, sep=";")
    assert rows(df) == [("2017-01", "100,0", None, None), ("2017-01", "///", "1,5", None)]


def test_csv_inferred_date_and_numbers(spark, workdir):
    p = _write(f"{workdir}/joined.csv", "fecha_inflacion,valor_mensual,valor_riesgo\n2024-01-31,2.5,1500\n")
    df = read_csv_typed(spark, p)
    assert dict(df.dtypes) == {"fecha_inflacion": "date", "valor_mensual": "double", "valor_riesgo": "int"}


def test_csv_roundtrip_text(spark, workdir):
    df = spark.createDataFrame([("", None, 'a,b', 'say "hi"', 1.5)], "e string, n string, c string, q string, x double")
    back = csv_roundtrip(spark, df, f"{workdir}/rt")
    assert rows(back) == [(None, None, "a,b", 'say "hi"', "1.5")]
    assert rows(as_text_table(df)) == [(None, None, "a,b", 'say "hi"', "1.5")]


def test_write_csv_replaces(spark, workdir):
    path = f"{workdir}/out"
    write_csv(spark.range(3), path)
    write_csv(spark.range(2), path)
    assert read_csv_text(spark, path).count() == 2


def test_first_n(spark):
    df = spark.range(10)
    assert [r[0] for r in rows(first_n(df, 3, [F.col("id").desc()]))] == [9, 8, 7]


PREAMBLE = '"Data Source","Indicator catalogue",\n\n"Last Updated Date","2024-10-24",\n\n'
HEADER = '"Country Name","Country Code","2022","2023",\n'


def _indicator_folder(workdir):
    folder = f"{workdir}/indicators"
    _write(f"{folder}/pbi.csv", PREAMBLE + HEADER
           + '"Bahamas, The","BHS","1.0","1.5",\n'
           + '"X","XXX","","",\n'
           + '"","YYY","2","3",\n'
           + HEADER
           + '"Argentina","ARG","5","6",\n')
    _write(f"{folder}/poblacion_total.csv", PREAMBLE + HEADER
           + '"Argentina","ARG","40","45.5",\n'
           + '"Bahamas, The","BHS","0.3","0.4",\n'
           + '"X","XXX","1","2",\n'
           + '"Chile","CHL","7","8",\n')
    os.makedirs(f"{folder}/_skip_dir", exist_ok=True)
    return folder


def test_preamble_lines_drop_preamble_and_repeated_header(spark, workdir):
    folder = _indicator_folder(workdir)
    recs = read_preamble_lines(spark, f"{folder}/*.csv")
    got = sorted((r["stem"], r["offset"], tuple(r["tokens"])) for r in recs.collect())
    first = len(PREAMBLE + HEADER)
    assert ("pbi", first, ("Bahamas, The", "BHS", "1.0", "1.5")) in got
    assert ("", "YYY", "2", "3") in [t for _, _, t in got]
    assert all(t[2][0] != "Country Name" for t in got)
    assert len(got) == 4 + 4


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_preamble_lines_independent_of_ranges(spark, workdir, end):
    body = "".join(f'"C{i:04d} é","K{i:04d}","{"x" * (i % 50)}","{i * 2}",\n' for i in range(400))
    text = (PREAMBLE + HEADER + body).replace("\n", end)
    path = f"{workdir}/big/ind.csv"
    os.makedirs(os.path.dirname(path))
    with open(path, "w", newline="") as f:
        f.write(text.rstrip("\r\n"))  # no line feed at the end
    want = [(f"C{i:04d} é", f"K{i:04d}", "x" * (i % 50), str(i * 2)) for i in range(400)]
    for size in (7, 64, 100, 1000, 10**6):
        got = sorted((r["offset"], tuple(r["tokens"])) for r in read_preamble_lines(spark, path, split_bytes=size).collect())
        assert [t for _, t in got] == want, size
        data = text.encode()
        assert all(data[o:].startswith(f'"{t[0]}"'.encode()) for o, t in got)


def test_preamble_lines_survive_a_change_of_parallelism(spark, workdir):
    body = "".join(f'"C{i:06d}","K","{i}","{i * 2}",\n' for i in range(60_000))
    path = _write(f"{workdir}/big/ind.csv", PREAMBLE + HEADER + body)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "4")
    try:
        lines = read_preamble_lines(spark, path, split_bytes=100_000)
        lines.explain()
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "11")  # as executors come and go
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
        got = lines.select("tokens").collect()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 60_000 and len({tuple(r["tokens"]) for r in got}) == 60_000


def test_header_without_a_column_fails_and_names_the_file(spark, workdir):
    from indicata.plans.pipelines import country_indicators_from_folder
    folder = f"{workdir}/wrong"
    _write(f"{folder}/a.csv", PREAMBLE + HEADER + '"Peru","PER","1","2",\n')
    _write(f"{folder}/b.csv", PREAMBLE + HEADER.replace("2023", "2019") + '"Peru","PER","1","2",\n')
    with pytest.raises(Exception, match=r"b\.csv: header lacks \['2023'\]"):
        country_indicators_from_folder(spark, f"{folder}/*.csv", ["a", "b"]).collect()


def test_indicator_folder_end_to_end(spark, workdir):
    from indicata.plans.pipelines import country_indicators_from_folder
    folder = _indicator_folder(workdir)
    assert folder_stems(spark, f"{folder}/*.csv") == ["pbi", "poblacion_total"]
    long = read_indicator_folder(spark, f"{folder}/*.csv", "Country Name", "2023")
    assert sorted(rows(long, "stem", "Country Name", "2023"))[0] == ("pbi", "", "3")
    out = country_indicators_from_folder(spark, f"{folder}/*.csv", ["pbi", "poblacion_total"])
    assert out.columns == ["Country Name", "pbi 2023", "poblacion_total 2023"]
    assert rows(out) == [("Argentina", 6.0, 45.5), ("Bahamas, The", 1.5, pytest.approx(0.4)),
                         ("X", 0.0, 2.0)]


def test_json_series_array_extra_keys_and_quoted_numbers(spark, workdir):
    p = _write(f"{workdir}/riesgo.json", json.dumps([
        {"fecha": "2024-01-02", "valor": 1500.9, "extra": 1},
        {"fecha": "2024-01-03", "valor": "69"},
        {"fecha": "2024-01-04", "valor": -2.9},
    ]))
    assert rows(read_json_series(spark, p)) == [("2024-01-02", 1500.9), ("2024-01-03", 69.0), ("2024-01-04", -2.9)]
    assert rows(read_json_series(spark, p, value_type="long"), "valor") == [(1500,), (69,), (-2,)]


def test_json_records_header_from_first_record(spark, workdir):
    p = _write(f"{workdir}/plazo.json", json.dumps([
        {"entidad": "A", "logo": "a.png", "tnaClientes": 0.3, "enlace": "x"},
        {"entidad": "B", "logo": "b.png", "enlace": "y"},
    ]))
    df = read_json_records(spark, p)
    assert df.columns == ["entidad", "logo", "tnaClientes", "enlace"]
    assert rows(df) == [("A", "a.png", "0.3", "x"), ("B", "b.png", None, "y")]


def test_json_records_unknown_key_fails(spark, workdir):
    p = _write(f"{workdir}/bad.json", json.dumps([{"a": 1}, {"a": 2, "zzz": 3}]))
    with pytest.raises(PySparkException, match="outside the header"):
        read_json_records(spark, p).collect()
    assert rows(read_json_records(spark, p, strict=False)) == [("1",), ("2",)]


def test_json_records_empty_array(spark, workdir):
    p = _write(f"{workdir}/empty.json", "[]")
    assert read_json_records(spark, p).count() == 0


def _zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members:
            zf.writestr(name, text)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_members_prefix_and_last(spark, workdir):
    folder = f"{workdir}/zips"
    _zip(f"{folder}/a.zip", [("Metadata_a.csv", "x\n1\n"), ("API_a.csv", "k,v\r\n\"p, q\",1\r\nr,2\r\n")])
    _zip(f"{folder}/b.zip", [("API_b.csv", "k,v\ns,3\n"), ("notes.txt", "hello\n")])
    lines = read_zip_members(spark, folder, member_prefix="API")
    assert sorted({r["member"] for r in lines.collect()}) == ["API_a.csv", "API_b.csv"]
    table = member_table(lines, ["k", "v"])
    assert sorted(rows(table, "k", "v")) == [("p, q", "1"), ("r", "2"), ("s", "3")]
    last = read_zip_members(spark, folder, last_member=True)
    assert sorted({r["member"] for r in last.collect()}) == ["API_a.csv", "notes.txt"]


def test_rows_to_frame(spark):
    df = rows_to_frame(spark, [("parana", 0.1)], "region string, factor double")
    assert rows(df) == [("parana", 0.1)]


def test_indicator_blank_line_and_stray_quote(spark, workdir):
    from indicata.plans.pipelines import country_indicators_from_folder
    folder = f"{workdir}/odd"
    _write(f"{folder}/a.csv", PREAMBLE + HEADER
           + '"Peru","PER","1","2",\n'
           + "\n"                                   # blank line: no key, dropped
           + '"Bad "quote","BQ","3","4",\n'         # stray quote inside a field
           + '"Uruguay","URY","5","x",\n')          # unreadable value -> 0
    _write(f"{folder}/b.csv", PREAMBLE + HEADER
           + '"Peru","PER","1","7",\n'
           + '"Uruguay","URY","1","8",\n')
    long = read_indicator_folder(spark, f"{folder}/*.csv", "Country Name", "2023")
    assert long.filter("stem = 'a'").count() == 4
    out = country_indicators_from_folder(spark, f"{folder}/*.csv", ["a", "b"])
    assert rows(out) == [("Peru", 2.0, 7.0), ("Uruguay", 0.0, 8.0)]


def test_json_records_non_list_payload_is_empty(spark, workdir):
    p = _write(f"{workdir}/obj.json", json.dumps({"error": "rate limited", "status": 429}))
    assert read_json_records(spark, p).count() == 0


def test_write_jdbc_options():
    from indicata.sinks import write_jdbc

    calls = []

    class _Writer:
        def jdbc(self, url, table, mode=None, properties=None):
            calls.append((url, table, mode, properties))

    class _Frame:
        write = _Writer()

    write_jdbc(_Frame(), "jdbc:postgresql://db:5432/x", "covid_indicators", "u", "p",
               "org.postgresql.Driver", max_connections=8)
    write_jdbc(_Frame(), "jdbc:postgresql://db:5432/x", "crime_data", truncate=True, mode="append")
    assert calls[0] == ("jdbc:postgresql://db:5432/x", "covid_indicators", "overwrite",
                        {"batchsize": "10000", "user": "u", "password": "p",
                         "driver": "org.postgresql.Driver", "numPartitions": "8"})
    assert calls[1][2:] == ("append", {"batchsize": "10000", "truncate": "true"})


def test_indicator_folder_skips_sub_folders(spark, workdir):
    folder = _indicator_folder(workdir)
    _write(f"{folder}/nested/extra.csv", PREAMBLE + HEADER + '"Argentina","ARG","1","2",\n')
    assert folder_stems(spark, folder) == ["pbi", "poblacion_total"]
    stems = {r["stem"] for r in read_indicator_folder(spark, folder, "Country Name", "2023").collect()}
    assert stems == {"pbi", "poblacion_total"}


def test_zip_line_splitting_matches_line_iteration(monkeypatch):
    import random

    from indicata.sources import archives

    monkeypatch.setattr(archives, "_CHUNK_CHARS", 7)
    rnd = random.Random(3)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "b", ",", "\n", "\r", "\r\n", '"']) for _ in range(rnd.randint(0, 60)))
        want = [ln.rstrip("\r\n") for ln in io.StringIO(text, newline="")]
        got = [ln for arr in archives._line_arrays(io.StringIO(text, newline="")) for ln in arr.to_pylist()]
        assert got == want, repr(text)


def test_json_lines_records_header_from_first_record(spark, workdir):
    p = _write(f"{workdir}/recs.jsonl",
               '{"entidad": "A", "tna": 0.3}\n\n{"entidad": "B"}\n{"tna": 1, "entidad": "C"}\n')
    df = read_json_records(spark, p, multi_line=False)
    assert df.columns == ["entidad", "tna"]
    assert sorted(rows(df), key=str) == [("A", "0.3"), ("B", None), ("C", "1")]


def test_as_text_table_dates(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 10, 5, 0), 7)],
                               "d date, t timestamp, n int")
    assert rows(as_text_table(df)) == [("2024-01-31", "2024-01-31 10:05:00", "7")]


def test_indicator_unquoted_empty_fields(spark, workdir):
    p = _write(f"{workdir}/plain/ind.csv", PREAMBLE + "Country Name,Country Code,2022,2023,\nPeru,PER,,5,\n")
    source_rule = read_indicator_folder(spark, p, "Country Name", "2023")
    csv_rule = read_indicator_folder(spark, p, "Country Name", "2023", keep_empty=True)
    assert rows(source_rule, "Country Name", "2023") == [("Peru", None)]   # empty 2022 dropped: fields shift
    assert rows(csv_rule, "Country Name", "2023") == [("Peru", "5")]



def test_indicator_file_without_records_fails(spark, workdir):
    from indicata.plans.pipelines import country_indicators_from_folder
    folder = f"{workdir}/short"
    _write(f"{folder}/a.csv", PREAMBLE + HEADER + '"Peru","PER","1","2",\n')
    _write(f"{folder}/b.csv", PREAMBLE)  # preamble only
    with pytest.raises(ValueError, match="without records"):
        country_indicators_from_folder(spark, f"{folder}/*.csv", ["a", "b"])


def test_zip_headers_read_first_lines_only(spark, workdir):
    from indicata.sources import read_zip_headers
    folder = f"{workdir}/zips_h"
    _zip(f"{folder}/a.zip", [("Metadata_a.csv", "x\n1\n"), ("API_a.csv", "k,v\r\n1,2\r\n")])
    _zip(f"{folder}/b.zip", [("API_b.csv", "k,v\n3,4\n")])
    got = sorted((r["member"], r["line_no"], r["line"]) for r in read_zip_headers(spark, folder, "API").collect())
    assert got == [("API_a.csv", 0, "k,v"), ("API_b.csv", 0, "k,v")]
    last = sorted(r["line"] for r in read_zip_headers(spark, folder, last_member=True).collect())
    assert last == ["k,v", "k,v"]


def test_bad_json_series_fail(spark, workdir):
    cut = _write(f"{workdir}/cut.json", '[{"fecha": "2024-01-01", "valor": 1}, {"fecha": "2024-0')
    page = _write(f"{workdir}/page.json", "<html><body>error</body></html>")
    for path in (cut, page):
        with pytest.raises(Exception, match="not JSON"):
            read_json_series(spark, path).collect()
    for value in ("null", '"n/a"'):
        p = _write(f"{workdir}/v{len(value)}.json", '[{"fecha": "2024-01-01", "valor": %s}]' % value)
        with pytest.raises(Exception, match="unreadable valor"):
            read_json_series(spark, p).collect()
        assert rows(read_json_series(spark, p, tolerant=True)) == [("2024-01-01", None)]


def test_bad_json_records_fail(spark, workdir):
    folder = f"{workdir}/mixed"
    _write(f"{folder}/good.json", json.dumps([{"a": 1}]))
    _write(f"{folder}/cut.json", '[{"a": 1}, {"a": ')
    with pytest.raises(Exception, match="not JSON"):
        read_json_records(spark, folder, ["a"]).collect()
    page = _write(f"{workdir}/page/x.json", "<html></html>")
    with pytest.raises(Exception, match="not JSON"):
        read_json_records(spark, page, ["a"]).collect()
    lines = _write(f"{workdir}/l.jsonl", '{"a": 1}\n{"a": \n{"a": 3}\n')
    with pytest.raises(Exception, match="not a record"):
        read_json_records(spark, lines, ["a"], multi_line=False).collect()
    odd = _write(f"{workdir}/odd/x.json", "[1, 2]")
    with pytest.raises(Exception):
        read_json_records(spark, odd, ["a"]).collect()


def test_text_after_a_record_fails(spark, workdir):
    for k, junk in enumerate(["garbage", "]", "]}", ', {"fecha": "x", "valor": 2}', "}"]):
        line = _write(f"{workdir}/junk{k}.jsonl", '{"fecha": "2024-01-01", "valor": 1} %s\n' % junk)
        with pytest.raises(Exception, match="not a record"):
            read_json_series(spark, line, multi_line=False).collect()
        with pytest.raises(Exception, match="not a record"):
            read_json_records(spark, line, ["fecha", "valor"], multi_line=False).collect()
        whole = _write(f"{workdir}/junk{k}.json", '[{"fecha": "2024-01-01", "valor": 1}] %s' % junk)
        with pytest.raises(Exception, match="not JSON"):
            read_json_series(spark, whole).collect()


def test_header_is_the_first_record_of_the_first_file(spark, workdir):
    folder = f"{workdir}/several"
    _write(f"{folder}/b.json", json.dumps([{"z": 1, "a": 2}] * 500))
    _write(f"{folder}/a.json", "[]")
    _write(f"{folder}/aa.json", json.dumps([{"a": 3, "z": 4}]))
    assert read_json_records(spark, folder).columns == ["a", "z"]
    for name in ("b", "a", "aa"):
        lines = "\n".join(map(json.dumps, json.load(open(f"{folder}/{name}.json"))))
        _write(f"{workdir}/lines/{name}.jsonl", lines)
    assert read_json_records(spark, f"{workdir}/lines", multi_line=False).columns == ["a", "z"]


@pytest.mark.parametrize("split", [100, 1000, 1 << 20])
def test_array_file_is_read_by_ranges(spark, workdir, split):
    recs = [{"k": i, "text": 'a "quoted", [x] {y} \\\\ \\" é\n' * (i % 5), "deep": [{"b": [i, "]"]}]} for i in range(200)]
    folder = f"{workdir}/ranges"
    _write(f"{folder}/one.json", "\ufeff" + json.dumps(recs, ensure_ascii=False, indent=1))
    _write(f"{folder}/two.json", json.dumps(recs[:3]))
    _write(f"{folder}/empty.json", " \n")
    got = rows(read_json_records(spark, folder, ["k", "text", "deep"], split_bytes=split))
    want = [(str(r["k"]), r["text"]) for r in [*recs, *recs[:3]]]
    assert sorted(g[:2] for g in got) == sorted(want)
    assert {json.dumps(json.loads(g[2])) for g in got} == {json.dumps(r["deep"]) for r in recs}


@pytest.mark.parametrize("longest", [0, 300_000])
def test_array_ranges_read_little_behind_them(workdir, monkeypatch, longest):
    from indicata.sources import json_arrays

    split, read = 16 * 1024, []

    class Counted:
        def __init__(self, uri):
            self.handle = open(uri, "rb")
            self.seek = self.handle.seek

        def read(self, size):
            read.append(len(data := self.handle.read(size)))
            return data

        def __enter__(self):
            return self

        def __exit__(self, *args):
            self.handle.close()

    recs = [{"k": i, "text": '"]}, {\\' * (longest if i == 7_000 else 3)} for i in range(20_000)]
    path = _write(f"{workdir}/counted{longest}.json", json.dumps(recs))
    size = os.path.getsize(path)
    monkeypatch.setattr(json_arrays, "open_input", Counted)
    ranges = [{"path": path, "start": s, "stop": min(s + split, size), "length": size} for s in range(0, size, split)]
    changes = list(json_arrays._read_changes([pa.RecordBatch.from_pylist(ranges)]))
    states = list(json_arrays._add_up(changes))
    read.clear()
    found = [t for b in json_arrays._read_elements(states) for t in b.to_pylist()]
    assert [json.loads(t["text"]) for t in found] == recs and not any(t["fault"] for t in found)
    # The file once, the ends of the ranges' last elements and at most thrice the longest one.
    assert sum(read) < 2 * size + 3 * max(len(t["text"]) for t in found)


def test_faults_are_set_aside(spark, workdir):
    from indicata.sources import fault_report, json_records_checked, set_aside

    folder = f"{workdir}/some-bad"
    _write(f"{folder}/good.json", json.dumps([{"a": 1}, {"a": 2, "b": 3}]))
    _write(f"{folder}/cut.json", '[{"a": 1}, {"a": ')
    _write(f"{folder}/odd.json", '[1, {"a": 5}, {"c": 6}, {"a": 7} x]')
    _write(f"{folder}/page.json", "<html></html>")
    _write(f"{folder}/object.json", '{"error": 1}')
    sound, faulty = set_aside(json_records_checked(spark, folder, ["a", "b"]))
    assert sorted(rows(sound, "a", "b"), key=str) == [("1", None), ("1", None), ("2", "3"), ("5", None)]
    got = sorted((r.file.rsplit("/", 1)[1], r.reason, r.n) for r in fault_report(faulty).collect())
    assert got == [("cut.json", "not JSON", 1), ("odd.json", "a JSON element is not a record", 2),
                   ("odd.json", "record has keys outside the header", 1), ("page.json", "not JSON", 1)]


def test_empty_json_array_lands_an_empty_file(spark, workdir):
    from indicata.plans import jobs
    empty = _write(f"{workdir}/empty.json", "[]")
    full = _write(f"{workdir}/full.json", '[{"fecha": "2024-01-01", "valor": 3}]')
    rates, deposits = jobs.deposit_jobs(spark, empty, full, out_dir=f"{workdir}/dep")
    assert rates.count() == 0 and rows(deposits) == [("2024-01-01", "3")]
    assert os.path.exists(f"{workdir}/dep/rates/_SUCCESS")


def test_csv_keeps_fractions_of_a_second(spark, workdir):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS a, timestamp'2024-01-02 03:04:05' AS b")
    want = [("2024-01-02 03:04:05.678901", "2024-01-02 03:04:05")]
    assert rows(csv_roundtrip(spark, df, f"{workdir}/frac")) == want == rows(as_text_table(df))


def test_archives_with_other_column_orders_and_blank_lines(spark, workdir):
    from indicata.sources import read_zip_headers
    folder = f"{workdir}/orders"
    _zip(f"{folder}/a.zip", [("API_a.csv", 'k,v,w\n"p, q",1,x\n\n  \nr,2,y\n')])
    _zip(f"{folder}/b.zip", [("API_b.csv", "v,k\n3,s\n")])
    headers = member_layouts(read_zip_headers(spark, folder, "API"))
    assert headers == ["k,v,w", "v,k"]
    table = member_table(read_zip_members(spark, folder, member_prefix="API"), ["k", "v", "w"], headers)
    assert sorted(rows(table, "k", "v", "w"), key=str) == [("p, q", "1", "x"), ("r", "2", "y"), ("s", "3", None)]


def test_odd_members(spark, workdir):
    """Blank first lines, members without a line, columns that differ, stored members, a directory."""
    from indicata.plans import jobs
    from indicata.plans.pipelines import SERIES_KEYS
    from indicata.sources import ZipCatalogue

    keys = ",".join(SERIES_KEYS)
    vals = ",".join("k" for _ in SERIES_KEYS)
    folder = f"{workdir}/odd"
    _zip(f"{folder}/a.zip", [("a.csv", f"\n  \r\n{keys},valor\n\n{vals},1\n")])
    _zip(f"{folder}/b.zip", [("b.csv", f"valor,extra,{keys}\n4,x,{vals}\n")])
    _zip(f"{folder}/c.zip", [("c.csv", f"{keys}\n{vals}\n")])
    _zip(f"{folder}/d.zip", [("d.csv", "")])
    _zip(f"{folder}/e.zip", [("e.csv", " \n\n")])
    members = ZipCatalogue(spark, folder, last_member=True)
    assert members.columns() == [*SERIES_KEYS, "valor", "extra"] and members.members.count() == 3
    assert rows(jobs.series_job(spark, folder, from_archive=True), "promedio_x_serie") == [(2.5,)]
    _zip(f"{workdir}/none/x.zip", [("x.csv", "")])
    with pytest.raises(Exception, match="no member with a header line"):
        jobs.series_job(spark, f"{workdir}/none", from_archive=True).collect()


@pytest.mark.parametrize("unit", [1, 100, 1 << 30])
def test_one_archive_of_many_members_is_read_by_many_tasks(spark, workdir, monkeypatch, unit):
    from indicata.sources import ZipCatalogue, archives

    monkeypatch.setattr(archives, "UNIT_BYTES", unit)
    folder = f"{workdir}/many{unit}"
    os.makedirs(folder)
    with zipfile.ZipFile(f"{folder}/all.zip", "w") as zf:
        for k in range(40):
            kind = zipfile.ZIP_STORED if k % 3 else zipfile.ZIP_DEFLATED
            zf.writestr(f"dir/API_{k}.csv", "k,v\n" + "".join(f"{k},{i}\n" for i in range(50)), compress_type=kind)
            zf.writestr(f"other_{k}.csv", "x\n")
    lines = ZipCatalogue(spark, folder, member_prefix="API").lines(spread=False)
    table = member_table(lines, ["k", "v"]).withColumn("task", F.spark_partition_id())
    assert sorted((int(k), int(v)) for k, v in rows(table, "k", "v")) == [(k, i) for k in range(40) for i in range(50)]
    tasks = table.select("task").distinct().count()
    assert tasks == 1 if unit == 1 << 30 else tasks > 8


def test_damaged_members_fail(spark, workdir):
    path = f"{workdir}/bad/x.zip"
    _zip(path, [("API_x.csv", "k,v\n" + "a,1\n" * 1000)])
    data = bytearray(open(path, "rb").read())
    data[3000] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception, match="API_x.csv"):
        read_zip_members(spark, f"{workdir}/bad").collect()
