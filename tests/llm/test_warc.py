import base64
import hashlib
import io

import pytest

from indicata.llm import warc
from indicata.session import scratch_path

DATE = "1970-01-01T00:00:00Z"


def records(n=60):
    return [warc.make_record(i, f"http://x.example/{i}", bytes([65 + i % 20]) * (i * 40), None if i % 3 else 7, DATE)
            for i in range(n)]


def read(data):
    return list(warc.salvage(warc.Archive(io.BytesIO(data), len(data))))


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_whole_archive_has_no_gaps(pack):
    out = read(b"".join(map(pack, records())))
    assert [x[0] for x in out] == ["record"] * 60
    assert [x[3]["warc-record-id"] for x in out] == [f"<urn:x-page:{i}>" for i in range(60)]


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_damage_costs_only_the_damaged_records(pack):
    parts = [pack(r) for r in records()]
    starts = [sum(map(len, parts[:k])) for k in range(61)]
    data = bytearray(b"".join(parts))
    at = starts[30] + len(parts[30]) // 2
    data[at: at + 4] = b"\x00\x01\x02\x03"  # inside record 30
    out = read(bytes(data))
    gaps = [x for x in out if x[0] == "gap"]
    assert [x[1:3] for x in gaps] == [(starts[30], starts[31])]
    got = {x[3]["warc-record-id"] for x in out if x[0] == "record"}
    assert got == {f"<urn:x-page:{i}>" for i in range(60) if i != 30}
    # Records and gaps cover the file without overlap.
    spans = [x[1:3] for x in out]
    assert spans[0][0] == 0 and spans[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_lost_bytes_junk_and_truncation(pack):
    parts = [pack(r) for r in records()]
    data = b"junk before" + b"".join(parts[:20]) + parts[20][:-9] + b"".join(parts[21:40]) + parts[40][: len(parts[40]) // 2]
    out = read(data)
    got = [x[3]["warc-record-id"] for x in out if x[0] == "record"]
    assert got == [f"<urn:x-page:{i}>" for i in range(40) if i != 20]
    assert len([x for x in out if x[0] == "gap"]) == 3


def test_empty_and_hopeless_files():
    assert read(b"") == []
    out = read(b"no archive at all" * 100)
    assert [x[0] for x in out] == ["gap"] and out[0][1:3] == (0, 1700)


def test_content_length_lies():
    a, b, c = records(20)[17:20]
    lie = a.replace(b"Content-Length: ", b"Content-Length: 9", 1) if b"\r\nContent-Length: " in a else a
    out = read(lie + b + c)
    assert [x[3]["warc-record-id"] for x in out if x[0] == "record"] == ["<urn:x-page:18>", "<urn:x-page:19>"]


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_long_headers(pack):
    parts = records(9)
    for k, size in ((2, 70_000), (5, 3 << 20)):
        parts[k] = warc.make_record(k, "http://x.example/" + "a" * size, b"payload", None, DATE)
    out = read(b"".join(map(pack, parts)))
    assert [x[0] for x in out] == ["record"] * 9 and len(out[5][3]["warc-target-uri"]) > 3 << 20


@pytest.mark.parametrize("limit", [1 << 25, 1000])
def test_member_of_several_records(monkeypatch, limit):
    monkeypatch.setattr(warc, "MEMBER_BYTES", limit)
    parts = records(30)
    bad = bytearray(parts[12])
    bad[-20] ^= 1  # its digest differs
    whole = [warc.gzip_member(b"".join(parts[:10])), warc.gzip_member(parts[10]),
             warc.gzip_member(b"".join([parts[11], bytes(bad), b"junk", *parts[13:20]])), b"".join(parts[20:25]),
             warc.gzip_member(b"".join(parts[25:]))]
    out = read(b"".join(whole))
    assert [x[3]["warc-record-id"] for x in out if x[0] == "record"] == [f"<urn:x-page:{i}>" for i in range(30) if i != 12]
    gaps = [x for x in out if x[0] == "gap"]
    assert len(gaps) == 1 and gaps[0][1:3] == (len(whole[0] + whole[1]), len(b"".join(whole[:3]))) and "of the member" in gaps[0][3]
    broken = bytearray(whole[0])
    broken[len(broken) // 2] ^= 255  # the member's own checksum fails
    out = read(bytes(broken) + b"".join(whole[1:]))
    assert len([x for x in out if x[0] == "record"]) == 19 and out[0][:3] == ("gap", 0, len(whole[0]))


def test_version_lines_without_an_end_cost_linear_time():
    import time

    data = b"WARC/1.1\r\na: b\r\n" * 20_000
    start = time.process_time()
    out = read(data)
    assert [x[:3] for x in out] == [("gap", 0, len(data))] and time.process_time() - start < 10


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_roundtrip_of_messy_pages(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/ x\ny", "same"), (3, None, "same"), (4, "http://c/", None),
            (5, "http://d/", ""), (6, "http://e/", "é" * 70_000), (7, "http://f/", "x\r\n\r\nWARC/1.1\r\n"),
            (8, "http://g/", "twice"), (8, "http://g/", "twice"), (None, "http://h/", "same")]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, digest string, first int")
    got = sorted([tuple(r) for r in warc.roundtrip(pages).collect()], key=str)
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(last.get(html or "", -1), i)
    want = []
    for i, _, html in rows:
        html = html or ""
        revisit = i is not None and last[html] != i
        want.append((i, len(html.encode()), b32(html), "revisit" if revisit else "response", last[html] if revisit else None))
    assert got == sorted(want, key=str)


def test_files_roll_and_payloads_come_back(spark):
    pages = spark.range(50).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(concat('p', id, ' '), 200) AS html")
    manifest = warc.write_warc(pages.repartition(3), scratch_path(spark, "warc-test"), file_bytes=1500)
    assert manifest.count() > 3 and manifest.selectExpr("sum(records)").first()[0] == 50
    back = warc.read_warc(spark, manifest).where("kind = 'record'")
    assert {(r.record_id, bytes(r.payload).decode()) for r in back.collect()} == {
        (f"urn:x-page:{i}", f"p{i} " * 200) for i in range(50)}
    assert warc.read_warc(spark, manifest).where("kind = 'gap'").count() == 0


def test_hot_payload_and_empty_table(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "'http://x/' AS url", "if(id % 3 = 0, 'hot', concat('p', id)) AS html")
    got = warc.roundtrip(pages)
    hot = got.where("refers_to IS NOT NULL")
    assert hot.count() == 999 and hot.where("refers_to <> 2997").count() == 0
    assert warc.roundtrip(pages.limit(0)).count() == 0
