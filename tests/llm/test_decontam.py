import re
from collections import Counter

import numpy as np

from indicata.llm import decontam
from tests.llm.helpers import messy_documents, prose


def grams(text, n):
    w = re.sub(r"[^\w]|_", " ", (text or "").lower()).split()
    return [tuple(w[i: i + n]) for i in range(len(w) - n + 1)], len(w)


def brute(docs, items, threshold=0.8):
    """The best item-sized window of every document and item."""
    out = {}
    for i, t in docs:
        for k, u in items:
            _, size = grams(u, 1)
            if not size:
                continue
            n = min(5, size)
            own, doc = grams(u, n)[0], grams(t, n)[0]
            if not doc and grams(t, 1)[1] and grams(t, 1)[1] < n:
                continue
            best = 0.0
            mine = set(own)
            shared = [x in mine for x in doc]
            b = Counter(own)
            for s in range(max(1, len(doc) - len(own) + 1)):
                if len(doc) > 500 and not any(shared[s: s + len(own)]):
                    continue  # a window without a shared shingle has similarity 0
                a = Counter(doc[s: s + len(own)])
                both = sum((a & b).values())
                best = max(best, both / max(1, sum(a.values()) + len(own) - both))
            if best >= threshold - 1e-12:
                out[i, k] = round(best, 9)
    return out


def found(df):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in df.collect()}


def case():
    items = [(k, prose(1000 + k, 20 + k)) for k in range(15)] + [(50, "one two three"), (51, "solo"), (52, None), (53, ""),
                                                               (54, "a b a b a b a b a b a b a b a b a b a b")]
    docs = [(k, prose(k, 80)) for k in range(20)]
    for k in range(15):
        passage = items[k][1].split()
        docs.append((100 + k, prose(200 + k, 40) + " " + items[k][1].upper() + ". " + prose(300 + k, 40)))
        cut = passage[: len(passage) - k % 4]
        docs.append((200 + k, prose(400 + k, 30) + " " + " ".join(cut) + " " + prose(500 + k, 30)))
        swapped = list(passage)
        swapped[len(passage) // 2] = "other"
        docs.append((300 + k, prose(600 + k, 30) + " " + " ".join(swapped)))
        docs.append((400 + k, " ".join(passage)))
    docs += [(600, "here one two three there"), (601, "SOLO"), (602, "a b a b a b a b a b a b a b a b a b a b a b a b"), (603, "one two")]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = found(decontam.contamination(messy_documents(spark, docs, extra=False), bench))
    assert got == brute(docs, items)
    assert all((100 + k, k) in got and (400 + k, k) in got for k in range(15))


def test_chunks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    chunks = decontam.item_chunks
    monkeypatch.setattr(decontam, "item_chunks", lambda b: chunks(b, chunk_words=150))
    assert found(decontam.contamination(messy_documents(spark, docs, extra=False), bench)) == brute(docs, items)


def test_clean_documents_keeps_the_rest(spark):
    docs, items = case()
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, score string")
    frame = messy_documents(spark, docs)
    kept = decontam.clean_documents(frame, bench)
    assert kept.columns == frame.columns
    bad = {i for i, _ in brute(docs, items)}
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted(
        [r.doc_id for r in frame.collect() if r.doc_id not in bad], key=str)
    none = bench.limit(0)
    assert decontam.clean_documents(frame, none).count() == frame.count()
    assert decontam.contamination(frame, none).count() == 0
    assert decontam.contamination(frame.limit(0), bench).count() == 0


def test_items_without_an_id_and_repeated_items(spark):
    rows = [(None, prose(1, 30)), (None, prose(1, 30)), (7, prose(2, 30)), (5, prose(2, 30)), (None, prose(2, 30)),
            *[(100 + k, prose(3, 30)) for k in range(50)], (9, None), (None, None), (3, "...")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = [(k, prose(50 + k, 20) + " " + prose(1 + k % 3, 30)) for k in range(30)] + [(99, prose(99, 50))]
    frame = messy_documents(spark, docs, extra=False)
    got = sorted(((r.doc_id, r.item_id, r.n_items) for r in decontam.contamination(frame, bench).collect()), key=str)
    assert got == sorted([(k, *((None, 2), (5, 3), (100, 50))[k % 3]) for k in range(30)], key=str)
    assert [r.doc_id for r in decontam.clean_documents(frame, bench).collect()] == [99]


def test_chunks_are_bounded(spark):
    rows = [(k, prose(k, 30)) for k in range(40)] * 3
    bench = spark.createDataFrame(rows, "item_id long, text string")
    sizes = [sum(len(i.ids) for i in c.values()) for c in decontam.item_chunks(bench, chunk_words=100)]
    assert sizes == [4] * 10
    frame = messy_documents(spark, [(k, prose(k, 30)) for k in range(45)], extra=False)
    assert sorted(r.doc_id for r in decontam.clean_documents(frame, bench).collect()) == [40, 41, 42, 43, 44]


def test_index_returns_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    index = decontam.ItemIndex(list(range(200)), [1] * 200, [rng.integers(0, 2 ** 63, 12, dtype=np.uint64) for _ in range(200)])
    probes = []
    for p in index.prints[:40]:
        for bits in range(0, 24):
            for at in [rng.choice(64, bits, replace=False)]:
                q = p
                for b in at:
                    q ^= np.uint64(1) << np.uint64(b)
                probes.append(q)
    probes = np.concatenate([np.array(probes, np.uint64), base])
    w, i = index.within(probes, 12)
    distance = np.bitwise_count(probes[:, None] ^ index.prints[None, :])
    assert set(zip(w.tolist(), i.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(distance <= decontam.RADIUS))))


def test_window_prints_equal_direct_ones():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    starts = np.array([0, 5, 6, 7, 100, 250, 288])
    got = decontam.window_prints(h, starts, np.full(7, 12))
    assert got.tolist() == [int(decontam.simhash(h[s: s + 12])) for s in starts]
