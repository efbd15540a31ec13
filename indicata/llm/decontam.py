"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

An item of the benchmark is the multiset of its 5-word shingles; a document is
read in item-sized windows.  For every item length s (in shingles) the
windows of s shingles get a 64-bit SimHash over their shingles, weighted by
multiplicity.  The fingerprints of the items are indexed under each of
``BLOCKS`` blocks of bits; two fingerprints within ``RADIUS`` differ by at most
``RADIUS // BLOCKS`` bits in some block, so probing every block with all values
that near finds all items within the radius.  Each candidate is then
verified by the exact weighted Jaccard similarity of the shingle multisets.

Only windows around a shared shingle are fingerprinted: a window without one
has similarity 0, so none is lost.  The radius covers the expected distance at
the threshold by more than two standard deviations.

Documents are never shuffled.  Equal benchmark texts are one item, reported with the least
of their ids and their number.  The benchmark is read in chunks of a bounded
number of words, and each chunk is indexed and broadcast on its own, so what the
driver holds and sends is bounded whatever the benchmark's size; every document meets every
chunk, and with several the result of each is written before the next is read.

Defined cases: null or empty documents and items match nothing; an item with a text
but without an id counts like any other (its id in the result is null); an item of
fewer than five words is one shingle, its whole text; a document shorter
than an item is compared as one window; repeated rows are judged alike; an
empty benchmark matches nothing; extra columns are kept by ``clean_documents``
and ignored by ``contamination``.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.shingles import chunks, hash_words, shingle_hashes, words
from indicata.llm.store import small_batches, written

NGRAM, THRESHOLD = 5, 0.8
BITS, BLOCKS, RADIUS = 64, 8, 16
CHUNK_WORDS = 1_000_000  # words of the benchmark per broadcast
_FILTER_BITS = 22


class ItemIndex:
    """One chunk of the benchmark, for one shingle width."""

    def __init__(self, ids: list[int | None], members: list[int], shingles: list[np.ndarray]):
        self.ids, self.members = ids, members
        self.counts = [Counter(s.tolist()) for s in shingles]
        self.sizes = np.array([len(s) for s in shingles], np.int64)
        flat = np.concatenate(shingles)
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], owner[order]
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(flat & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        prints = np.array([simhash(s) for s in shingles], np.uint64)
        self.prints = prints
        width = BITS // BLOCKS
        near = RADIUS // BLOCKS
        self.masks = np.array([sum(1 << b for b in c) for r in range(near + 1)
                               for c in combinations(range(width), r)], np.int64)
        # Per item length and block: items sorted by the block's value.
        self.blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for s in np.unique(self.sizes):
            own = np.flatnonzero(self.sizes == s)
            tables = []
            for k in range(BLOCKS):
                value = block_values(prints[own], k)
                by = np.argsort(value, kind="stable")
                tables.append((value[by], own[by]))
            self.blocks[int(s)] = tables

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of that item length within the radius."""
        tables = self.blocks[size]
        items = len(tables[0][1])
        pairs = []
        for k, (values, own) in enumerate(tables):
            probe = (block_values(prints, k)[:, None] ^ self.masks[None, :]).ravel()
            lo, hi = np.searchsorted(values, probe), np.searchsorted(values, probe, side="right")
            n = hi - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = np.repeat(np.repeat(np.arange(len(prints)), len(self.masks)), n)
            item = own[at]
            near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            pairs.append(window[near] * len(self.ids) + item[near])
        found = np.unique(np.concatenate(pairs)) if items else np.empty(0, np.int64)
        return found // len(self.ids), found % len(self.ids)


def block_values(prints: np.ndarray, k: int) -> np.ndarray:
    width = BITS // BLOCKS
    return ((prints >> np.uint64(k * width)) & np.uint64((1 << width) - 1)).astype(np.int64)


def signed_bits(hashes: np.ndarray) -> np.ndarray:
    """A row of +1/-1 per hash."""
    octets = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel().astype(np.uint64)


def simhash(hashes: np.ndarray) -> np.uint64:
    return _packed(signed_bits(hashes).sum(axis=0)[None, :])[0]


def window_prints(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SimHash of ``hashes[start: start + length]`` for every window, by
    differences of running sums over the positions that windows cover."""
    ends = starts + lengths
    mark = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    covered = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
    sums = np.zeros((len(covered) + 1, BITS), np.int32)
    np.cumsum(signed_bits(hashes[covered]), axis=0, out=sums[1:])
    first = np.searchsorted(covered, starts)
    return _packed(sums[first + lengths] - sums[first])


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    both = sum((a & b).values())
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 0.0


def search(index: ItemIndex, hashes: np.ndarray, at: np.ndarray, threshold: float) -> list[tuple]:
    """(text, item id, members, similarity, hamming, start, length) of the best window per
    text and item; ``hashes`` holds all texts' shingles, ``at`` their offsets."""
    hit = np.flatnonzero(index.maybe[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    lo = np.searchsorted(index.keys, hashes[hit])
    n = np.searchsorted(index.keys, hashes[hit], side="right") - lo
    position = np.repeat(hit, n)
    if not len(position):
        return []
    item = index.owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    size_at = index.sizes[item]
    best: dict[tuple[int, int], tuple] = {}
    for size in np.unique(size_at):
        anchor = np.unique(position[size_at == size])
        text = np.searchsorted(at, anchor, side="right") - 1
        first, last = at[text], np.maximum(at[text + 1] - size, at[text])
        starts = np.maximum(anchor - size + 1, first)
        count = np.maximum(np.minimum(anchor, last) - starts + 1, 1)
        starts = np.minimum(starts, last)
        starts = np.unique(np.repeat(starts, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        text = np.searchsorted(at, starts, side="right") - 1
        lengths = np.minimum(size, at[text + 1] - starts)
        for block in range(0, len(starts), 20_000):
            s, m, t = (x[block: block + 20_000] for x in (starts, lengths, text))
            prints = window_prints(hashes, s, m)
            windows, items = index.within(prints, int(size))
            counts: dict[int, Counter] = {}
            for w, i in zip(windows.tolist(), items.tolist()):
                if w not in counts:
                    counts = {w: Counter(hashes[s[w]: s[w] + m[w]].tolist())}
                sim = similarity(counts[w], index.counts[i])
                if sim >= threshold - 1e-12:
                    key = (int(t[w]), i)
                    if key not in best or sim > best[key][0]:
                        best[key] = (sim, int(np.bitwise_count(prints[w] ^ index.prints[i])), int(s[w] - at[t[w]]), int(m[w]))
    return [(t, index.ids[i], index.members[i], *v) for (t, i), v in sorted(best.items())]


def item_classes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(text, id, members, n): one row per distinct text, its least id (null if it has none), how many
    rows have it, and its words by the tokenizer's rule; texts without words are left out."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    words_in = F.regexp_count(F.lower("text"), F.lit(r"[\p{L}\p{N}\p{M}]+"))
    return items.where("text is not null").groupBy("text").agg(
        F.min("id").alias("id"), F.count("*").alias("members")).withColumn("n", words_in).where("n > 0")


def item_chunks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                chunk_words: int = CHUNK_WORDS) -> Iterator[dict[int, ItemIndex]]:
    """Indexes by shingle width, one dictionary per chunk of the benchmark: the distinct texts pass by
    in order, and a chunk is closed when it holds ``chunk_words`` words."""
    classes = written(item_classes(benchmark, id_col, text_col), "benchmark-items")
    held, size = [], 0
    for r in classes.orderBy(F.xxhash64("text"), "text").toLocalIterator():
        held.append(r)
        size += r.n
        if size >= chunk_words:
            yield from _indexes(held)
            held, size = [], 0
    yield from _indexes(held)


def _indexes(rows: list) -> Iterator[dict[int, ItemIndex]]:
    if not rows:
        return
    flat, offsets = words(pa.array([r.text for r in rows], pa.string()))
    hashes = hash_words(flat)
    widths: dict[int, tuple[list, list, list]] = {}
    for r, lo, hi in zip(rows, offsets, offsets[1:]):
        if hi > lo:
            width = min(NGRAM, int(hi - lo))
            own, _ = shingle_hashes(hashes[lo:hi], np.array([0, hi - lo]), width)
            for column, value in zip(widths.setdefault(width, ([], [], [])), (r.id, r.members, own)):
                column.append(value)
    if widths:
        yield {w: ItemIndex(*v) for w, v in widths.items()}


def _hits(indexes: dict[int, ItemIndex], texts: pa.Array, threshold: float) -> list[tuple]:
    flat, offsets = words(texts)
    hashes = hash_words(flat)
    out = []
    for width, index in indexes.items():
        grams, at = shingle_hashes(hashes, offsets, width)
        out += search(index, grams, at, threshold)
    return out


def _each_chunk(spark, benchmark: DataFrame, step) -> None:
    """``step(broadcast, more)`` for every chunk: ``more`` says whether there are several, and then
    ``step`` has run its plan when it returns, so that one chunk at a time is held."""
    chunks_ = item_chunks(benchmark)
    now = next(chunks_, None)
    several = False
    while now is not None:
        after = next(chunks_, None)
        several = several or after is not None
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(now))  # code included
        step(shared, several)
        if several:
            shared.destroy()
        now = after


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and distinct benchmark text found in it: doc_id, item_id (the
    text's least id), n_items (benchmark rows with that text), similarity, hamming, start (shingle),
    n_shingles of the best window."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "item_id", "n_items", "similarity", "hamming", "start", "n_shingles"]
    schema = "doc_id bigint, item_id bigint, n_items bigint, similarity double, hamming int, start bigint, n_shingles bigint"
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
    out: list[DataFrame] = []

    def step(shared, several: bool) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indexes = pickle.loads(shared.value)
            for b in chunks(batches, "text"):
                found = _hits(indexes, b["text"], threshold)
                if found:
                    row, *rest = map(list, zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [b["doc_id"].take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(rest, kinds))], names=names)

        part = src.mapInArrow(run, schema)
        out.append(written(part, "contaminated") if several else part)

    _each_chunk(spark, benchmark, step)
    if not out:
        return spark.createDataFrame([], schema)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark item."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = [docs]

    def step(shared, several: bool) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indexes = pickle.loads(shared.value)
            for b in chunks(batches, text_col):
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in _hits(indexes, b[text_col], threshold)]] = False
                yield b.filter(pa.array(keep))

        left = kept[0].mapInArrow(run, docs.schema)
        kept[0] = written(left, "decontaminated") if several else left

    _each_chunk(spark, benchmark, step)
    return kept[0]
