import re
import textwrap

from indicata.llm import licenses
from tests.llm.helpers import messy_documents, prose

MIT = dict((k, t) for k, t in reversed(licenses.KNOWN))["MIT"]


def scan(spark, texts, extra=False):
    return {r.doc_id: r for r in licenses.license_scan(messy_documents(spark, texts, extra)).collect()}


def test_whole_texts_in_other_spellings(spark):
    other = "Copyright (c) 2020 A. Person\n\n" + MIT.upper().replace("LICENSE", "LICENCE").replace("SUBLICENSE", "sub-license") \
        .replace("NONINFRINGEMENT", "non-infringement").replace(",", " ,").replace('"', "“")
    got = scan(spark, [(1, MIT), (2, other), (3, MIT + " and more"), (4, MIT.replace("free of charge", "for a fee"))])
    assert [got[i].license for i in (1, 2, 3, 4)] == ["MIT", "MIT", None, None]
    assert got[1].text_digest == got[2].text_digest != got[3].text_digest


def test_notice_lines(spark):
    got = scan(spark, [(1, prose(1) + "\nReleased under the MIT Licence!\n" + prose(2) + "\n  licensed under CC-BY-NC 4.0"),
                       (2, prose(3) + " Released under the MIT License."), (3, "All rights reserved.\nAll rights reserved."),
                       (4, "Copyright 2020 Somebody. All rights reserved.")])
    assert (got[1].n_notice_lines, got[1].notice_licenses) == (2, "CC-BY-NC-4.0;MIT")
    assert (got[2].n_notice_lines, got[2].notice_licenses) == (0, "")
    assert (got[3].n_notice_lines, got[3].notice_licenses, got[3].license) == (2, "all-rights-reserved", None)
    assert got[4].n_notice_lines == 0  # a copyright line goes as a whole


def test_messy_rows_and_empty_table(spark):
    got = scan(spark, [], extra=True)
    assert len(got) == 8 and licenses.license_scan(messy_documents(spark, [], True)).count() == 10 and got[9001].text_digest is None and got[9002].license is None
    assert got[9002].text_digest == got[9003].text_digest == got[9004].text_digest
    assert licenses.license_scan(messy_documents(spark, [], True).limit(0)).count() == 0


def test_native_plan(spark):
    plan = licenses.license_scan(messy_documents(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def wrapped(text, width):
    """The text in other lines; paragraphs that hold a copyright line stay as they are."""
    out = []
    for part in re.split(r"\n\s*\n", text):
        own = re.search(r"(?i)copyright (?:\(c\)|\[)", part)
        out.append(part if own else textwrap.fill(" ".join(part.split()), width, break_long_words=False, break_on_hyphens=False))
    return "\n\n".join(out)


def test_wrapping_does_not_matter(spark):
    texts = [(name, text) for name, text in licenses.complete_texts()]
    rows = [(i * 10 + k, wrapped(text, w), name) for i, (name, text) in enumerate(texts)
            for k, w in enumerate((24, 41, 57, 72, 80, 100, 100_000))]
    got = scan(spark, [r[:2] for r in rows], False)
    assert [(i, n) for i, t, n in rows if got[i].license != n] == []


def test_titles_and_copyright_lines(spark):
    title = "The MIT License (MIT)\n\nCopyright (c) 2021 A. Person\nCopyright 2020 Other Person\n(c) 2019 Third Person\n"
    usual = MIT.replace("AUTHORS OR\nCOPYRIGHT HOLDERS", "AUTHORS OR COPYRIGHT HOLDERS")
    got = scan(spark, [(1, title + usual), (2, "MIT License\n\n© Acme\n\n" + MIT), (3, usual.replace("BE LIABLE", "BE LIABEL")),
                       (4, "MIT License\nCopyright The Authors\n" + MIT.replace("LIABLE FOR ANY CLAIM", "GLAD")),
                       (5, "BSD 3-Clause License\n\nCopyright (c) 2020, Acme\nAll rights reserved.\n\n"
                        + licenses._bsd((licenses._SOURCE, licenses._BINARY, licenses._NAMES), "{}. "))], False)
    assert [got[i].license for i in (1, 2, 3, 4, 5)] == ["MIT", "MIT", None, None, "BSD-3-Clause"]


def test_rows_that_share_an_id_are_judged_each(spark):
    isc = dict((k, t) for k, t in reversed(licenses.KNOWN))["ISC"]
    docs = spark.createDataFrame([(1, MIT), (1, isc), (None, MIT), (None, isc), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.license) for r in licenses.license_scan(docs).collect()), key=str)
    assert got == sorted([(1, "MIT"), (1, "ISC"), (None, "MIT"), (None, "ISC"), (None, None)], key=str)


def test_sql_follows_the_operator(spark):
    """The SQL on complete texts, titles, copyright lines and clauses broken at the word."""
    import duckdb
    import pyarrow as pa

    from indicata.llm import oracles

    lead = ["", "Copyright (c) 2021 A. Person\n", "(c) 2019 Third\n", "© Acme\n", "COPYRIGHT 2020 X\r\n", " * Copyright The Authors\n",
            "copyright holders be liable\n", "(c) you must\n", "Copyright\n", "copyright the\n", "copyrighted work\n", "(c)\n",
            "copyright, holder's\n", "copyright-notice\n"]
    texts = [t for _, t in licenses.complete_texts()] + [t for _, t in licenses.KNOWN]
    rows = [(k, a + t) for k, t in enumerate(texts) for a in lead[:: 1 if len(t) < 5000 else 4]]
    rows += [(900 + k, "plain line\n" + a + "tail") for k, a in enumerate(lead)] + [(None, MIT), (None, None), (1, "")]
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]}))
    want = con.execute(oracles.LICENSE_SCAN).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(r[2] is not None for r in want) > 60
