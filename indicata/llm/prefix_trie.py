"""The trie of conversation prefixes, summed up by time-forward processing.

A node is a distinct sequence of the first d turns (role, text) of some
conversation.  A turn is known by a digest, a node by its depth and a polynomial
hash of the digests (modulo 2**127 - 1), whose value for a run of turns can be
carried over a boundary.  So the turns are sorted by range, every task hashes
the conversations of its range, and a conversation cut by a boundary is carried
on from one number and one hash per range: no conversation has to fit in a task.

Nodes of one conversation (most of them) are done as they are.  For the
others, totals travel from the leaves to the root:

* Nodes fall into classes by their number of members, ``SHARD`` to the power of
  the class.  The number falls along a path, so the nodes of a class form
  connected pieces, the shards: of at most ``SHARD`` nodes on each level.
* Within a shard the nodes are sorted (by Spark, spilling) by falling depth,
  then by hash.  A node takes the totals that its children have sent to it from the front of a
  priority queue, adds its own and sends the sum to its parent through the
  queue.  A queue that has grown to ``QUEUE`` messages writes them as a sorted run to a file and
  merges the runs at the front.
* The totals of shard roots are added up per parent by Spark and enter the
  class above, until the root's shard is done: three classes do for 10**11 members.

Every step's table is written to the shared folder.  The SHA-256 of the ids that
end in a node reads them in order: ranges of sorted ids are joined to texts of
up to ``CHUNK`` bytes first, and only the nodes at range boundaries are hashed from these in a second step.

Defined cases: null roles and texts count as empty; rows of equal turns (null
first) are ordered by their digest, and repeated rows stay; rows without a
conversation id are ignored; a conversation without turns is a member of the
root alone; an empty table has no node, not even a root; columns other than the
four named are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicata.llm.skew import salted_join
from indicata.llm.store import small_batches, written

PRIME = (1 << 127) - 1
BASE = 0x2F6E_3C15_9A8B_47D1_6C03_E5B7_1D29_F485  # any number below PRIME
SHARD = 4096  # members of a node of the first class; a class up has this many times more
QUEUE = 1 << 16  # messages that a queue holds in memory
CHUNK = 1 << 20
LONG = (1 << 64) - 1
WORDS = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
ORDER = ("conv", "kind", "has_turn", "turn", "digest", "uid")
NODE = ("depth", "k1", "k2")


# -- turns ------------------------------------------------------------------


def turn_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, has_turn, turn, digest, uid, words), written: no text goes any further."""
    said = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("conv is not null")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    return written(said.select("conv", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
                               digest.alias("digest"), F.monotonically_increasing_id().alias("uid"),
                               F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words")), "turns")


def steps(rows: DataFrame) -> DataFrame:
    """The conversations as they are: per conversation a first row without turn, then its turns."""
    return _starts(rows.select("conv").distinct()).unionByName(rows.withColumn("kind", F.lit(2)))


def steps_with_shared_heads(rows: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % ``group``, then
    c's own after its first h, with h = crc32(decimal c) % ``most``."""
    order = Window.partitionBy("conv").orderBy("has_turn", "turn", "digest", "uid")
    firsts = written(rows.withColumn("pos", F.row_number().over(order)).where(F.col("pos") < most), "first-turns")
    place = F.struct("has_turn", "turn", "digest", "uid")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = written(firsts.groupBy("conv").agg(F.max(F.when(F.col("pos") <= h, place)).alias("last")).select(
        "conv", "last", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base")), "conversations")
    base = firsts.where(F.col("conv") % group == 0).withColumnRenamed("conv", "base")
    heads = convs.select("conv", "h", "base").join(base, "base").where(F.col("pos") <= F.col("h")).select(
        "conv", F.lit(1).alias("kind"), F.lit(True).alias("has_turn"), F.col("pos").cast("long").alias("turn"), "digest",
        "uid", "words")
    own = rows.join(convs.select("conv", "last"), "conv").where(F.col("last").isNull() | (place > F.col("last"))).drop("last")
    return _starts(convs.select("conv")).unionByName(heads).unionByName(own.withColumn("kind", F.lit(2)))


def _starts(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return convs.select("conv", F.lit(0).alias("kind"), F.lit(False).alias("has_turn"), zero.alias("turn"),
                        F.lit("").alias("digest"), zero.alias("uid"), zero.alias("words"))


# -- prefixes ---------------------------------------------------------------


def _halves(values: list[int]) -> list[pa.Array]:
    low = [v & LONG for v in values]
    return [pa.array([v >> 64 for v in values], pa.int64()),
            pa.array([v - (1 << 64) if v >> 63 else v for v in low], pa.int64())]


def _whole(high: pa.Array, low: pa.Array) -> list[int]:
    return [(a << 64) | (b & LONG) for a, b in zip(high.to_pylist(), low.to_pylist())]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order: the hash of each conversation's turns so far.
    A conversation that began before this range is hashed from its first turn
    here (``open``); ``last`` is null for the range's last row."""
    part = TaskContext.get().partitionId()
    conv, h, n, is_open, opens = None, 0, 0, False, False
    held: list[tuple] = []  # the row before, until it is known whether its conversation goes on
    names = ["part", "conv", "at", "k1", "k2", "p1", "p2", "words", "open", "opens", "last"]

    def out(found: list[tuple]) -> pa.RecordBatch:
        convs, at, keys, befores, words, opened, ends = zip(*found)
        size = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * size, pa.int32()), pa.array(convs, pa.int64()), pa.array(at, pa.int64()),
             *_halves(keys), *_halves(befores), pa.array(words, pa.int64()), pa.array(opened),
             pa.array([opens] * size), pa.array(ends, pa.bool_())], names=names)

    first = True
    for b in batches:
        found: list[tuple] = []
        for c, kind, digest, words in zip(*(b[x].to_pylist() for x in ("conv", "kind", "digest", "words"))):
            if kind == 0 or c != conv:
                is_open = kind != 0
                opens = opens or first and is_open
                h = n = 0
            first = False
            before = h
            if kind:
                h = (h * BASE + (int(digest[:32], 16) >> 1)) % PRIME
                n += 1
            if held:
                found.append((*held.pop(), c != conv))
            held.append((c, n, h, before, words, is_open))
            conv = c
        if found:
            yield out(found)
    if held:
        yield out([(*held.pop(), None)])


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, words, ends) of every first d turns of every
    conversation, written; p is the hash of the prefix one turn shorter."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ("part int, conv long, at long, k1 long, k2 long, p1 long, p2 long, words long, open boolean, "
              "opens boolean, last boolean")
    folded = written(rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
                     .select("conv", "kind", "digest", "words").mapInArrow(_fold, schema), "folded")
    # One row per range: how far its last conversation has come.
    tails = folded.where("last is null").select("part", "conv", "at", "k1", "k2", "open", "opens").orderBy("part").collect()
    carried: dict[int, tuple[int, int]] = {}
    ended: set[int] = set()  # ranges whose last row is the end of its conversation
    n = h = 0
    for i, t in enumerate(tails):
        key = (t.k1 << 64) | (t.k2 & LONG)
        if t.opens:
            carried[t.part] = n, h
        n, h = (n + t.at, (h * pow(BASE, t.at, PRIME) + key) % PRIME) if t.open else (t.at, key)
        if i + 1 == len(tails) or not tails[i + 1].opens:
            ended.add(t.part)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, depth = b["part"].to_pylist(), b["at"].to_pylist()
            last = [v if v is not None else p in ended for v, p in zip(b["last"].to_pylist(), part)]
            keys = [b[c] for c in ("k1", "k2", "p1", "p2")]
            where = np.flatnonzero(np.asarray(b["open"]))
            if len(where):
                key, before = _whole(*keys[:2]), _whole(*keys[2:])
                for i in where:
                    n0, h0 = carried[part[i]]
                    key[i] = (h0 * pow(BASE, depth[i], PRIME) + key[i]) % PRIME
                    before[i] = (h0 * pow(BASE, depth[i] - 1, PRIME) + before[i]) % PRIME
                    depth[i] += n0
                keys = [*_halves(key), *_halves(before)]
            yield pa.RecordBatch.from_arrays(
                [b["conv"], pa.array(depth, pa.int64()), *keys, b["words"], pa.array(last, pa.bool_())],
                names=["conv", "depth", "k1", "k2", "p1", "p2", "words", "ends"])

    return written(folded.mapInArrow(
        carry, "conv long, depth long, k1 long, k2 long, p1 long, p2 long, words long, ends boolean"), "prefixes")


# -- ids that end in a node --------------------------------------------------


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) rows of a range: the digest of nodes inside it, texts of the first and last node."""
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    node, ids, size, seq, first = None, [], 0, 0, True

    def flush(final: bool, inside: bool) -> None:
        nonlocal ids, size, seq
        if final and inside:
            rows.append((*node, part, 0, hashlib.sha256(",".join(ids).encode()).hexdigest(), None))
        elif ids:
            rows.append((*node, part, seq, None, ",".join(ids)))
            seq += 1
        ids, size = [], 0

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows))
        rows.clear()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[*NODE, "part", "seq", "sha", "chunk"])

    for b in batches:
        for d, k1, k2, conv in zip(*(b[c].to_pylist() for c in (*NODE, "conv"))):
            if (d, k1, k2) != node:
                if node is not None:
                    flush(True, not first and seq == 0)
                    first = False
                node, seq = (d, k1, k2), 0
            text = str(conv)
            ids.append(text)
            size += len(text) + 1
            if size >= CHUNK:
                flush(False, False)
        if rows:
            yield out()
    if node is not None:
        flush(True, False)
        if rows:
            yield out()


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, sha = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in node), pa.array([sha.hexdigest()])],
                                          names=[*NODE, "sha"])

    for b in batches:
        for i, now in enumerate(zip(*(b[c].to_pylist() for c in NODE))):
            if now != node:
                if node is not None:
                    yield out()
                node, sha = now, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(b["chunk"][i].as_py().encode())
    if node is not None:
        yield out()


def end_digests(instances: DataFrame) -> DataFrame:
    """(node, sha): SHA-256 of the ids that end there, ascending, joined by commas."""
    spark = instances.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = instances.where("ends").select(*NODE, "conv")
    joined = written(ends.repartitionByRange(parts, *NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(
        _join_ids, "depth long, k1 long, k2 long, part int, seq int, sha string, chunk string"), "ends")
    cut = joined.where("chunk is not null").select(*NODE, "part", "seq", "chunk")
    cut = cut.repartition(parts, *NODE).sortWithinPartitions(*NODE, "part", "seq").mapInArrow(
        _hash_chunks, "depth long, k1 long, k2 long, sha string")
    return joined.where("sha is not null").select(*NODE, "sha").unionByName(cut)


# -- totals -----------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples of five longs (least first) that keeps at most
    ``limit`` of them in memory; the rest lie in sorted runs, files without a
    name that end with the task."""

    RECORD = "<5q"

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()
            self.heap.sort()
            for x in self.heap:
                file.write(struct.pack(self.RECORD, *x))
            file.seek(0)
            self.heap = []
            self.spilled += 1
            self._next(file)

    def _next(self, file) -> None:
        data = file.read(struct.calcsize(self.RECORD))
        if data:
            heapq.heappush(self.runs, (struct.unpack(self.RECORD, data), id(file), file))
        else:
            file.close()

    def take(self, key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Removes and gives the messages for ``key`` (nothing before it may be left)."""
        while True:
            from_run = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
            head = self.runs[0][0] if from_run else self.heap[0] if self.heap else None
            if head is None or head[:len(key)] != key:
                return
            if from_run:
                _, _, file = heapq.heappop(self.runs)
                self._next(file)
            else:
                heapq.heappop(self.heap)
            yield head


def _forward(limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes by shard, falling depth and hash: totals of each, passed on to its parent."""
        shard, queue = None, SpillingQueue(limit)
        given = ("s0", "s1", "s2", *NODE, "p1", "p2", "n", "words", "children", "leaves", "saved")
        for b in batches:
            children_out, leaves_out, saved_out, top_out = [], [], [], []
            for s0, s1, s2, depth, k1, k2, p1, p2, n, words, children, leaves, saved in zip(*(b[c].to_pylist() for c in given)):
                if (s0, s1, s2) != shard:
                    shard, queue = (s0, s1, s2), SpillingQueue(limit)
                saved += (n - 1) * words
                for *_, more_leaves, more_saved in queue.take((-depth, k1, k2)):
                    children += 1
                    leaves += more_leaves
                    saved += more_saved
                leaves = leaves if children else 1
                top = (depth, k1, k2) == shard
                if not top:
                    queue.push((1 - depth, p1, p2, leaves, saved))
                for column, value in ((children_out, children), (leaves_out, leaves), (saved_out, saved), (top_out, top)):
                    column.append(value)
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*(b[c] for c in (*NODE, "p1", "p2", "rep", "n", "n_ends")), pa.array(children_out, pa.int64()),
                     pa.array(leaves_out, pa.int64()), pa.array(saved_out, pa.int64()), pa.array(top_out)],
                    names=[*NODE, "p1", "p2", "rep", "n", "n_ends", "children", "leaves", "saved", "top"])

    return task


TOTALS = ("depth long, k1 long, k2 long, p1 long, p2 long, rep long, n long, n_ends long, children long, leaves long, "
          "saved long, top boolean")


def _with_shards(shared: DataFrame, instances: DataFrame, total: int, shard: int) -> tuple[DataFrame, int]:
    """The shared nodes with their class and the top node (s0, s1, s2) of their shard."""
    classes = 0  # of the root
    while shard ** (classes + 1) < total:
        classes += 1
    level: Column = F.lit(0)
    for k in range(1, classes + 1):
        level = F.when(F.col("n") > shard ** k, k).otherwise(level)
    shared = shared.withColumn("class", level)
    whole = [F.lit(0).cast("long")] * 3
    if not classes:
        return shared.withColumns(dict(zip(("s0", "s1", "s2"), whole))), classes
    # The children of nodes above the first class, on each conversation's path: the deepest one below a
    # node of more than SHARD ** (k + 1) members is where a shard of class k can begin.
    large = shared.where(F.col("n") > shard).where("depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("n").alias("above"))
    first = instances.where("depth = 1").select("conv", *NODE, F.lit(total).cast("long").alias("above"))
    deeper = instances.where("depth > 1").join(large, ["depth", "p1", "p2"]).select("conv", *NODE, "above")
    tops = first.unionByName(deeper).groupBy("conv").agg(*(
        F.max(F.when(F.col("above") > shard ** (k + 1), F.struct(*NODE))).alias(f"top{k}") for k in range(classes)))
    placed = shared.join(tops, shared["rep"] == tops["conv"], "left")
    top = F.lit(None).cast("struct<depth:bigint,k1:bigint,k2:bigint>")
    for k in range(classes):
        top = F.when(F.col("class") == k, F.col(f"top{k}")).otherwise(top)
    placed = placed.withColumn("top", top)
    return placed.select(*shared.columns, *(F.coalesce(F.col("top")[c], zero).alias(s)
                                            for c, s, zero in zip(NODE, ("s0", "s1", "s2"), whole))), classes


def subtree_totals(nodes: DataFrame, instances: DataFrame, total: int, shard: int = SHARD, limit: int = QUEUE) -> list[DataFrame]:
    """Children, leaves and saved tokens of the nodes with two members or more."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared, classes = _with_shards(nodes.where("n > 1"), instances, total, shard)
    shared = written(shared, "shared-nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    flows = [nodes.where("n = 1 and depth > 0").groupBy(*up).agg(
        F.count("*").alias("children"), F.count("*").alias("leaves"), F.lit(0).cast("long").alias("saved"))]
    done = []
    for k in range(classes + 1):
        inflow = flows[0]
        for more in flows[1:]:
            inflow = inflow.unionByName(more)
        if k:
            inflow = inflow.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
        now = shared.where(F.col("class") == k).join(inflow, list(NODE), "left").fillna(0, ["children", "leaves", "saved"])
        now = now.repartition(parts, "s0", "s1", "s2").sortWithinPartitions("s0", "s1", "s2", F.desc("depth"), "k1", "k2")
        out = written(now.mapInArrow(_forward(limit), TOTALS), f"totals-{k}")
        done.append(out.drop("top"))
        flows.append(out.where("top and depth > 0").groupBy(*up).agg(
            F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    return done


# -- the trie ---------------------------------------------------------------


def trie(rows: DataFrame, shard: int = SHARD, limit: int = QUEUE) -> DataFrame:
    """One row per node of the conversations in ``rows`` (see ``steps``): conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    small_batches(rows.sparkSession)
    instances = prefixes(rows)
    nodes = written(instances.groupBy(*NODE).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("words").alias("words"), F.sum(F.col("ends").cast("long")).alias("n_ends")), "nodes")
    root = nodes.where("depth = 0").first()
    columns = [*NODE, "p1", "p2", "rep", "n", "n_ends", "children", "leaves", "saved"]
    found = nodes.where("n = 1").select(
        *NODE, "p1", "p2", "rep", "n", "n_ends", (1 - F.col("n_ends")).alias("children"),
        F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    shared = None
    if root is not None and root.n > 1:
        for part in subtree_totals(nodes, instances, root.n, shard, limit):
            shared = part if shared is None else shared.unionByName(part)
        found = found.unionByName(shared.select(*columns))
    # A parent of one member has the same one; the others' smallest members are looked up.
    if shared is None:
        parent = found.withColumn("above", F.lit(None).cast("long"))
    else:
        key = F.struct((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2")).alias("up")
        above = written(shared.where("children > 0").select(key, F.col("children"), F.col("rep").alias("above")), "parents")
        keyed = found.withColumn("up", F.when(F.col("depth") > 0, F.struct("depth", "p1", "p2")))
        parent = salted_join(keyed, above, "up", "children", "rep").drop("up")
    parent = parent.withColumn("parent", F.when(F.col("depth") > 0, F.coalesce("above", "rep")))
    ended = parent.where("n_ends > 0").join(end_digests(instances), list(NODE))
    inner = parent.where("n_ends = 0").withColumn("sha", F.lit(NO_ENDS))
    return ended.unionByName(inner.select(*ended.columns)).select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"))
