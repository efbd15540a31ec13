"""The prefix trie against plain dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, words string, depth int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def sequences(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out[c].append(((t is not None, t or 0, digest), (role, text)))
    return {c: [said for _, said in sorted(v, key=lambda x: x[0])] for c, v in out.items()}


def rebuilt(rows):
    own = sequences(rows)
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - int(math.fmod(c, 20)), [])[:h[c]] + own[c][h[c]:] for c in own}


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    return Counter((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                   for node, m in members.items())


def found(df):
    return Counter(map(tuple, df.collect()))


def made(seed, n=300, hot=60, long=900):
    """Few distinct turns, so that prefixes are shared; a third equal conversations and one very long one."""
    rng = random.Random(seed)
    say = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d\te  f", "g h"]))
    rows = [(c, t, *say()) for c in range(n) for t in range(rng.randrange(0, 6))]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(hot) for t in range(4)]
    rows += [(5000, t, "user", str(t % 7)) for t in range(long)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard,limit,parts", [(4096, 1 << 16, 8), (3, 2, 20)])
def test_brute_force(spark, shard, limit, parts):
    rows = made(shard)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        said = p.turn_rows(frame(spark, rows))
        if shard == 3:
            assert found(p.trie(p.steps(said), shard, limit)) == brute(sequences(rows))
        assert found(p.trie(p.steps_with_shared_heads(said), shard, limit)) == brute(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_defined_cases(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "a", "y"), (None, 1, "user", "z"),
            (21, 5, "user", "only"), (40, 1, "", "long " * 100_000), (45, 2, "u", "v"), (-7, 1, "user", "x")]
    said = p.turn_rows(frame(spark, rows))
    assert found(p.trie(p.steps(said))) == brute(sequences(rows))
    # A negative id's remainder keeps its sign, as in SQL.
    assert found(p.trie(p.steps_with_shared_heads(said))) == brute(rebuilt(rows))
    assert found(p.trie(p.steps_with_shared_heads(p.turn_rows(frame(spark, [(None, 1, "user", "z")]))))) == Counter()
    one = [(3, 1, "user", "x"), (3, 2, "user", "y")]
    assert found(p.trie(p.steps(p.turn_rows(frame(spark, one))))) == brute(sequences(one))


def test_end_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(p, "CHUNK", 64)
    rows = [(c, 0, "user", "same" if c % 3 else "other") for c in range(2000)]
    assert found(p.trie(p.steps(p.turn_rows(frame(spark, rows))), 16)) == brute(sequences(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 3), st.integers(-3, 3), st.integers(), st.integers())
                .map(lambda t: (*t[:3], t[3] % 1000, t[4] % 1000)), max_size=60), st.integers(1, 8))
def test_queue_gives_all_messages_in_order(items, limit):
    q = p.SpillingQueue(limit)
    for x in items:
        q.push(x)
    got = [m for key in sorted({x[:3] for x in items}) for m in q.take(key)]
    assert got == sorted(items) and len(q.heap) <= limit and list(q.take((9, 9, 9))) == []
    assert q.spilled == len(items) // (limit + 1)
