import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import packing
from pyspark.sql import functions as F
from tests.llm.helpers import messy_documents, prose

CAPS = (8, 16, 32)


def check(rows, want_tokens, caps):
    bins = defaultdict(list)
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.doc_id] += r.n_tokens
        if r.n_tokens == 0:
            assert (r.bin_id, r.bin_offset, r.bin_capacity, r.bin_used) == (None,) * 4
        else:
            bins[r.bin_id].append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in rs:
            assert r.bin_offset == at
            at += r.n_tokens
        assert {(r.bin_used, r.bin_capacity) for r in rs} == {(at, min(c for c in caps if c >= at))}
    assert dict(tokens) == want_tokens
    return bins


@pytest.mark.parametrize("shard", [7, 10_000])
def test_every_token_is_in_one_bin(spark, shard):
    rng = random.Random(0)
    sizes = {k: rng.choice([0, 1, 3, 7, 8, 9, 15, 20, 32, 33, 64, 100]) for k in range(300)}
    docs = messy_documents(spark, [(k, prose(k, n) if n else None) for k, n in sizes.items()], extra=False)
    rows = packing.pack(docs, capacities=CAPS, shard_items=shard).collect()
    bins = check(rows, sizes, CAPS)
    for k, n in sizes.items():  # pieces cover the document in order
        own = sorted((r.start_token, r.n_tokens) for r in rows if r.doc_id == k)
        assert [a for a, _ in own] == [sum(b for _, b in own[:i]) for i in range(len(own))]
    if shard > 1000:
        used = sum(sizes.values())
        assert used / sum(rs[0].bin_capacity for rs in bins.values()) > 0.95


def test_messy_rows_and_empty_table(spark):
    docs = messy_documents(spark, [])
    rows = packing.pack(docs, capacities=CAPS).collect()
    counts = defaultdict(int)
    for r in docs.collect():
        counts[r.doc_id] += len((r.text or "").split())
    check(rows, dict(counts), CAPS)
    assert packing.pack(docs.limit(0)).count() == 0


def test_own_token_column(spark):
    docs = messy_documents(spark, [(1, "x"), (2, "y")], extra=False)
    rows = packing.pack(docs, tokens=F.col("doc_id") * 20, capacities=CAPS).collect()
    check(rows, {1: 20, 2: 40}, CAPS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 32), max_size=60), st.sampled_from([None, *CAPS]))
def test_best_fit_is_best_fit(lengths, prefer):
    lengths = sorted(lengths, reverse=True)
    number, offset, used = packing.best_fit(lengths, CAPS, prefer)
    rooms = {}  # bin -> room
    for at, (n, k, o) in enumerate(zip(lengths, number, offset)):
        if n == 0:
            assert k == -1
            continue
        fitting = [r for r in rooms.values() if r >= n]
        if fitting:
            assert rooms[k] == min(fitting)
        else:
            assert k == len(rooms)
            rooms[k] = max(prefer, min(c for c in CAPS if c >= n)) if prefer else plain_opening(n, lengths[at + 1:])
        rooms[k] -= n
    assert len(used) == len(rooms)


def plain_opening(n, rest):
    """The size whose cost per token is least when filled with the longest pieces that fit."""
    def rated(c):
        held = n
        for m in rest:
            if m and held + m <= c:
                held += m
        return packing.bin_cost(min(x for x in CAPS if x >= held)) / held, c
    return min((c for c in CAPS if c >= n), key=rated)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 32), max_size=60))
def test_no_single_size_is_cheaper(lengths):
    lengths = sorted(lengths, reverse=True)
    cost = lambda p: packing.total_cost(p[2], CAPS)
    best = cost(packing.cheapest(lengths, CAPS))
    assert all(best <= cost(packing.best_fit(lengths, CAPS, c)) for c in (None, *CAPS))


def test_bins_are_recomputed_from_the_rows(spark):
    """Each shard's bins, worked out anew from its pieces alone."""
    rng = random.Random(3)
    docs = messy_documents(spark, [(k, prose(k, rng.randrange(0, 90))) for k in range(200)], extra=False)
    rows = packing.pack(docs, capacities=CAPS, shard_items=40).collect()
    shards = defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            shards[r.bin_id >> 32].append(r)
    assert len(shards) > 3
    for own in shards.values():
        own.sort(key=lambda r: (-r.n_tokens, r.doc_id, r.piece))
        number, offset, used = packing.cheapest([r.n_tokens for r in own], CAPS)
        assert [(r.bin_id & 0xFFFFFFFF, r.bin_offset, r.bin_used) for r in own] == [
            (k, o, used[k]) for k, o in zip(number, offset)]


def test_rows_without_an_id_spread_over_shards(spark):
    docs = messy_documents(spark, [(None, prose(1, 5))] * 400 + [(7, prose(2, 6))] * 400, extra=False)
    rows = packing.pack(docs, capacities=CAPS, shard_items=100).collect()
    for i in (None, 7):
        own = defaultdict(int)
        for r in rows:
            if r.doc_id == i:
                own[r.bin_id >> 32] += 1
        assert len(own) == 8 and max(own.values()) < 120 and sum(own.values()) == 400
