import itertools
import random
import re

import pytest

from indicata.llm import jaccard
from tests.llm.helpers import messy_documents, prose


def grams(text, n=5):
    w = re.sub(r"[^\w]|_", " ", (text or "").lower()).split()
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    rows = [(i, grams(t)) for i, t in rows]
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        (i, x), (j, y) = rows[a], rows[b]
        if i is not None and j is not None and x and y and len(x & y) >= threshold * len(x | y):
            links[a] += 1
            links[b] += 1
            parent[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, least[top(k)] if i is not None else None, links[k]) for k, (i, _) in enumerate(rows)), key=str)


def edited(text, seed, edits):
    w = text.split()
    rng = random.Random(seed)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def corpus():
    rows = [(k, prose(k)) for k in range(30)]
    rows += [(100 + k, edited(prose(3, 200), k, 1 + k % 4)) for k in range(40)]  # a group of near copies
    rows += [(200 + k, prose(4).upper() + "!") for k in range(20)]  # copies but for case and marks
    rows += [(300 + k, edited(prose(50 + k, 100), k, 3)) for k in range(15)] + [(400 + k, prose(50 + k, 100)) for k in range(15)]
    rows += [(500, "a b c"), (501, "A, b; c."), (502, "a b d"), (503, "a b c d e"), (504, "a b c d e f")]
    return rows


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.7, 0.8, 0.9):
        bands, rows = jaccard.choose_bands(threshold, 0.99, 256)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.99 and bands * rows <= 256


def test_links_and_classes_equal_brute_force(spark):
    rows = corpus()
    got = sorted([tuple(r) for r in jaccard.link_documents(messy_documents(spark, rows, extra=False)).collect()], key=str)
    assert got == brute(rows)


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 7)  # many block pairs per bucket
    rows = corpus()
    got = sorted([tuple(r) for r in jaccard.link_documents(messy_documents(spark, rows, extra=False)).collect()], key=str)
    assert got == brute(rows)


def test_messy_rows(spark):
    docs = messy_documents(spark, [(1, prose(1)), (2, prose(1)), (1, prose(2)), (3, prose(2))])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in jaccard.link_documents(docs).collect()], key=str)
    assert got == brute(rows)
    assert jaccard.link_documents(docs.limit(0)).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = messy_documents(spark, corpus())
    kept = jaccard.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted([r.doc_id for r in kept.collect()], key=str)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = [i for i, c, _ in brute(rows) if i is None or i == c]
    want.remove(9006)  # the repeated row
    assert got == sorted(want, key=str)
    assert jaccard.deduplicate(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [10, 100, 1000])
def test_member_bitmap_misses_none(spark, n):
    ids = spark.range(0, 7 * n, 7).selectExpr("id AS doc_id")
    bitmap, bits = jaccard.member_bitmap(ids)
    at = [r[0] for r in ids.selectExpr(f"pmod(xxhash64(doc_id), {bits})").collect()]
    assert all((int(bitmap[a >> 6]) >> (a & 63)) & 1 for a in at)
