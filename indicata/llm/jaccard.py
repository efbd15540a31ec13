"""N-gram Jaccard self-join by MinHash banding.

1. Every text becomes its set of word ``n``-gram hashes, a digest of its words,
   and a MinHash signature cut into bands.  Band and row counts are chosen for
   a target recall at the threshold (``choose_bands``).
2. Texts with the same words are one class (a copy costs one light row).
3. Classes are shuffled on their band hashes.  Of the buckets with the same
   members (close copies share most bands) one is kept.
4. The classes of a kept bucket are compared in blocks on their full n-gram
   sets.  A bucket of many classes is dealt over pairs of blocks of bounded
   size; a pair of classes belongs to the first kept bucket that both share, so
   it is verified once.  A task emits one row per class and block pair (its number
   of links there and the smallest class it is connected to), never the
   pairs of a group.
5. Link counts are summed, and components of the verified links are taken.

A link joins two documents whose n-gram sets have a Jaccard similarity of at
least ``threshold``; every link found is exact, and a pair at the threshold is
found with probability ``recall`` or more (higher above it).

Defined cases: a text without words (null, empty, only punctuation) has no
n-grams, links with nothing and is its own class; a text of fewer than n words
has one n-gram, all of its words; rows sharing an id are separate rows, each linked
by its own text; rows with a null id are returned with a
null class and no links; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from indicata.llm.components import components
from indicata.llm.shingles import chunks, hash_words, mix, shingle_hashes, words
from indicata.llm.skew import salted_join
from indicata.llm.store import small_batches, written

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9995, 160
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000
BITMAP_BITS = 1 << 28  # 32 MB


def choose_bands(threshold: float, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding (most rows) of at most
    ``max_hashes`` hashes that finds a pair at the threshold with probability
    ``recall``; fewer rows never need more bands."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        share = min(threshold ** rows, 1 - 1e-12)
        bands = math.ceil(math.log(1 - recall) / math.log(1 - share))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, digest, grams, bands): digest of the words, number of distinct
    n-grams, band hashes; digest and bands are null for a text without words."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_signatures(n, bands, rows), f"doc_id {kind}, digest binary, bands array<bigint>")


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(20240229)  # fixed: all tasks use the same hash functions
        mult = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)
        for b in chunks(batches, "text"):
            flat, offsets = words(b["text"])
            grams, at = shingle_hashes(hash_words(flat), offsets, n)
            full = np.flatnonzero(np.diff(at) > 0)
            starts = at[:-1][full]
            keys = np.empty((len(full), bands), np.uint64)
            if len(full):
                value = np.empty_like(grams)
                for band in range(bands):
                    key = np.full(len(full), band, np.uint64)
                    for r in range(band * rows, (band + 1) * rows):
                        np.multiply(grams, mult[r], out=value)
                        value += add[r]
                        value >>= np.uint64(32)
                        key = mix(key ^ np.minimum.reduceat(value, starts)) * np.uint64(0x9E3779B97F4A7C15)
                    keys[:, band] = key
            size = np.zeros(b.num_rows + 1, np.int64)
            size[full + 1] = bands
            cells = pa.ListArray.from_arrays(
                pa.array(np.cumsum(size), pa.int32()), pa.array(keys.view(np.int64).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], _digests(flat, offsets), cells],
                                             names=["doc_id", "digest", "bands"])
    return run


def _digests(flat: pa.Array, offsets: np.ndarray) -> pa.Array:
    """128-bit digest of each text's words; null without words."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), " ")
    return pa.array([xxhash.xxh3_128_digest(t) if t else None for t in joined.to_pylist()], pa.binary())


def member_bitmap(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of the hashes of ``ids.doc_id``, 64 bits per id up to
    ``BITMAP_BITS``: a filter of bounded size that never misses a member."""
    n = ids.count()
    bits = min(BITMAP_BITS, max(1 << 16, 1 << (64 * n).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    cells = ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("word")).toArrow()
    words_ = np.zeros(bits // 64, np.int64)
    words_[cells["cell"].to_numpy()] = cells["word"].to_numpy()
    return words_.view(np.uint64), bits


def gram_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, found, grams): digest and sorted distinct n-gram hashes of the
    documents in ``ids`` (and of a few others that the bitmap cannot tell apart);
    the texts are read where they are and never shuffled."""
    bitmap, bits = member_bitmap(ids)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # BITMAP_BITS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["at"].to_numpy()
            maybe = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            for b in chunks([batch.filter(pa.array(maybe.astype(bool)))], "text"):
                flat, offsets = words(b["text"])
                grams, starts = shingle_hashes(hash_words(flat), offsets, n)
                sets = [np.unique(grams[lo:hi]).view(np.int64) for lo, hi in zip(starts, starts[1:])]
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate(sets) if sets else np.empty(0, np.int64)
                cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
                yield pa.RecordBatch.from_arrays([b["doc_id"], _digests(flat, offsets), cells],
                                                 names=["doc_id", "found", "grams"])

    placed = docs.where("doc_id IS NOT NULL").select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("at"))
    return placed.mapInArrow(run, "doc_id bigint, found binary, grams array<bigint>")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
                   threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id reachable by
    links, itself included), n_links (other documents linked directly)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = F.col("doc_id").isNotNull()
    return _classified(docs, n, threshold, recall).select(
        "doc_id", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
                threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of linked documents:
    the one with the smallest id.  Texts without words and rows with a null id stay.

    Only documents that may have to go (by a bitmap of their ids) are shuffled."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                       docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    seen = written(_classified(rows.select("doc_id", "text"), n, threshold, recall), "classified")
    first = (F.col("doc_id") == F.col("class_id")) & (F.col("digest") == F.col("keeper"))
    texts = seen.where("class_id IS NOT NULL").groupBy("doc_id", "digest").agg(
        F.max(first).alias("first"), F.count("*").alias("rows"))
    act = written(texts.where("NOT first OR rows > 1").select("doc_id", "digest", "first"), "not-first")
    bitmap, bits = member_bitmap(act)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # BITMAP_BITS at most
    placed = rows.select("row", "doc_id", F.coalesce(
        F.pmod(F.xxhash64("doc_id"), F.lit(bits)), F.lit(-1).cast("long")).alias("at"))

    def split(maybe: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch["at"].to_numpy()
                hit = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
                hit = hit.astype(bool) & (at >= 0)
                if not maybe:
                    yield pa.RecordBatch.from_arrays([batch["row"].filter(pa.array(~hit))], names=["row"])
                    continue
                some = batch.filter(pa.array(hit))
                some = some.append_column("text", some["row"].field(text_col).cast(pa.string()))
                for b in chunks([some], "text"):
                    yield pa.RecordBatch.from_arrays([b["row"], b["doc_id"], _digests(*words(b["text"]))],
                                                     names=["row", "doc_id", "digest"])
        return run

    sure = placed.mapInArrow(split(False), StructType([rows.schema["row"]]))
    unsure = placed.mapInArrow(split(True), StructType([rows.schema["row"], StructField("doc_id", LongType()), StructField("digest", BinaryType())]))
    judged = unsure.join(act, ["doc_id", "digest"], "left")
    stay = judged.where(F.col("first").isNull()).select("row")
    once = judged.where("first").dropDuplicates(["doc_id", "digest"]).select("row")
    return sure.unionByName(stay).unionByName(once).select("row.*")


def _classified(docs: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    """(doc_id, digest, class_id, keeper, n_links) per row; ``keeper`` is the digest
    of the words of the group's first document.  Null past ``digest`` where
    the id is null or the text has no words."""
    small_batches(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall)
    signed = written(signatures(docs, "doc_id", "text", n, bands, rows), "signatures")
    # The node number is written with the class, so it is fixed from here on.
    classes = written(signed.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    members = _kept_members(classes)
    own = members.groupBy("node").agg(F.collect_list("bucket").alias("own"))  # at most one per band
    own = written(own.join(classes.select("node", "digest", "rep", "copies", "bands"), "node").select(
        "node", "digest", "rep", "copies", F.transform(
            "bands", lambda x: F.when(F.array_contains("own", x), x).otherwise(F.lit(0))).alias("bands")), "own")
    cand = written(_with_sets(docs, own, n), "candidates")
    links = written(_verified(members, cand, threshold, bands), "links")

    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(links.select("node", "root"), "node", "root")
    placed = written(classes.select("node", "digest", "rep", "copies").join(group, "node", "left")
                     .join(degree, "node", "left"), "placed")
    least = written(placed.where("component IS NOT NULL").groupBy("component")
                    .agg(F.min(F.struct("rep", "digest")).alias("least")), "least")
    per_class = written(placed.join(least, "component", "left").select(
        "digest", "copies", F.coalesce("least.rep", "rep").alias("class_id"), F.coalesce("least.digest", "digest").alias("keeper"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "per-class")
    found = salted_join(signed.select("doc_id", "digest"), per_class, "digest", "copies", "doc_id")
    known = F.col("doc_id").isNotNull()
    return found.select("doc_id", "digest", *(F.when(known, F.col(c)).alias(c) for c in ("class_id", "keeper", "n_links")))


def _with_sets(docs: DataFrame, own: DataFrame, n: int) -> DataFrame:
    """The candidate classes with the n-gram set of their text, read again
    for these classes only (of rows sharing an id, the one with the class's words)."""
    own = own.withColumnRenamed("rep", "doc_id")
    same = own.join(gram_sets(docs, own, n), "doc_id").where("found = digest").drop("doc_id", "found", "digest")
    return same.dropDuplicates(["node"]).withColumn("size", F.size("grams"))


def _kept_members(classes: DataFrame) -> DataFrame:
    """(bucket, node, size) of the buckets of several classes, one bucket per
    distinct set of members (two 64-bit sums of member hashes tell sets apart)."""
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    counted = placed.groupBy("bucket").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("size > 1")
    kept = written(counted.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket"))
                   .select("bucket", "size"), "buckets")
    return written(placed.join(kept, "bucket").select("bucket", "node", "size"), "members")


def _verified(members: DataFrame, cand: DataFrame, threshold: float, bands: int) -> DataFrame:
    """(node, links, root) per class and block pair in which it has links."""
    spark = members.sparkSession
    weight = written(members.join(cand.select("node", F.col("size").alias("n")), "node")
                     .groupBy("bucket").agg(F.sum("n").alias("total")), "weights")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    sized = members.join(weight, "bucket").select("bucket", "node", blocks.alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = sized.withColumn("mine", mine).select(
        "bucket", "node", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("bucket", "node", "mine", F.least("mine", "other").alias("i"),
                         F.greatest("mine", "other").alias("j"))
    rows = dealt.join(cand.drop("size"), "node")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return runs.mapInArrow(_verify(threshold, bands), "node bigint, links bigint, root bigint")


def _verify(threshold: float, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        out: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for b in batches:
            cols = [b[c].to_numpy() for c in ("bucket", "i", "j")]
            change = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols], axis=0)) + 1
            edges = [0, *change, b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                this = tuple(int(c[lo]) for c in cols)
                if this != key and held:
                    out.append(_compare(held, key, threshold, bands))
                    waiting += len(out[-1][0])
                    held = []
                key = this
                held.append(b.slice(lo, hi - lo))
            if waiting > 10_000:
                yield _as_batch(out)
                out, waiting = [], 0
        if held:
            out.append(_compare(held, key, threshold, bands))
        if out:
            yield _as_batch(out)
    return run


def _as_batch(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                                      names=["node", "links", "root"])


def _compare(held, key, threshold: float, bands: int) -> tuple[np.ndarray, ...]:
    """Exact links among one block, or between two, of a bucket."""
    t = pa.Table.from_batches(held).combine_chunks()
    bucket, i, j = key
    node, copies, mine = (t[c].to_numpy() for c in ("node", "copies", "mine"))
    cells = t["grams"].chunk(0)
    size = np.asarray(pc.list_value_length(cells), dtype=np.int64)
    band_keys = t["bands"].chunk(0).flatten().to_numpy().reshape(-1, bands)
    m = len(node)
    # Grams of one class only never count towards an intersection.
    grams, inverse, seen = np.unique(cells.flatten().to_numpy(), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), size)
    shared = seen[inverse] > 1
    column = np.cumsum(seen > 1) - 1
    owner, col = owner[shared], column[inverse[shared]]
    left = np.arange(m) if i == j else np.flatnonzero(mine == i)
    right = left if i == j else np.flatnonzero(mine == j)
    if not len(left) or not len(right):
        return (np.empty(0, np.int64),) * 3
    at_left, at_right = np.full(m, -1), np.full(m, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    width = max(1, 1_000_000 // max(m, 1))  # bounded work space
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, (lo, lo + width))
        o, c = owner[a:b], col[a:b] - lo
        x = np.zeros((len(left), min(width, int(col[-1]) + 1 - lo)), np.float32)
        sel = at_left[o] >= 0
        x[at_left[o[sel]], c[sel]] = 1
        if i == j:
            y = x
        else:
            y = np.zeros((len(right), x.shape[1]), np.float32)
            sel = at_right[o] >= 0
            y[at_right[o[sel]], c[sel]] = 1
        common += x @ y.T
    total = size[left][:, None] + size[right][None, :] - common
    ok = common >= threshold * total - 1e-9
    band = int(np.flatnonzero(band_keys[0] == bucket)[0])
    for k in range(band):  # a pair belongs to the first kept bucket both share
        x, y = band_keys[left, k], band_keys[right, k]
        ok &= ~((x[:, None] == y[None, :]) & (x[:, None] != 0))
    if i == j:
        np.fill_diagonal(ok, False)
    links = np.zeros(m, np.int64)
    links[left] += ok @ copies[right]
    if i != j:
        links[right] += ok.T @ copies[left]
    root = node.copy()
    while True:  # smallest class reachable inside this block pair
        before = root.copy()
        x, y = root[left], root[right]
        x = np.minimum(x, np.where(ok, y[None, :], np.iinfo(np.int64).max).min(axis=1))
        root[left] = np.minimum(root[left], x)
        y = np.minimum(root[right], np.where(ok, root[left][:, None], np.iinfo(np.int64).max).min(axis=0))
        root[right] = np.minimum(root[right], y)
        if (root == before).all():
            break
    has = links > 0
    return node[has], links[has], root[has]
