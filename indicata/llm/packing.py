"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted at once.  A sequence of capacity c
costs ``fixed + c + c * c / quadratic`` (a constant share, the linear layers, the
attention).  Pieces are taken longest first:

1. best fit: the piece goes to the open bin with the least room that holds it;
2. if none holds it, a bin is opened, of the permitted capacity with the
   least cost per token when it is filled with the longest pieces left that fit, and then downsized;
3. at the end every bin is downsized to the least permitted capacity that
   holds its contents;
4. the same is done with each single capacity preferred for new bins, and the
   packing of least total cost is taken.

Texts are read once, to count their tokens.  Shards: pieces are dealt by a hash of (row, piece), rows
numbered as they are written, so that rows of one id or without an id spread as well, to shards of about
``shard_items`` pieces, and every shard is packed on its own by one task, so
a task's memory is bounded at every input size.  The loss against packing all
at once is the last partly filled bins of each shard.  A document longer
than the largest capacity is cut into pieces of that capacity and a rest;
no token is dropped.

Defined cases: a null, empty or all-white text has no tokens and gets one row
with ``n_tokens`` 0 and null bin columns; documents with equal ids are packed
separately (repeated rows stay); an empty table gives an empty result; extra
columns are ignored; ties in length are ordered by (document, piece, row).
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.store import written

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_ITEMS = 50_000
FIXED, QUADRATIC = 64.0, 32_768.0


def bin_cost(capacity: int) -> float:
    return FIXED + capacity + capacity * capacity / QUADRATIC


def token_count(text: Column) -> Column:
    """Runs of non-white characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pieces(counted: DataFrame, largest: int) -> DataFrame:
    """(doc_id, row, piece, start_token, n_tokens) of rows (doc_id, row, n), at least one per row."""
    last = F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0))
    cut = counted.select("doc_id", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * largest
    return cut.select("doc_id", "row", F.col("piece").cast("int"), start.alias("start_token"),
                      F.least(F.lit(largest), F.col("n") - start).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
         capacities: tuple[int, ...] = CAPACITIES, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: doc_id, piece, start_token, n_tokens, bin_id
    (``shard << 32 | number``), bin_offset, bin_capacity, bin_used."""
    capacities = tuple(sorted(set(capacities)))
    tokens = tokens if tokens is not None else token_count(F.col(text_col).cast("string"))
    # Written: texts are read and counted once, and a row keeps its number.
    counted = written(docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                                  F.coalesce(tokens, F.lit(0)).cast("long").alias("n")), "token-counts")
    cut = pieces(counted, capacities[-1])
    n = cut.agg(F.count("*")).first()[0]
    shards = max(1, math.ceil(n / shard_items))
    id_type = docs.schema[id_col].dataType.simpleString()
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))
    runs = dealt.repartition(shards, "shard").sortWithinPartitions(
        "shard", F.desc("n_tokens"), F.asc_nulls_first("doc_id"), "piece", "row")
    schema = (f"doc_id {id_type}, piece int, start_token bigint, n_tokens int, bin_id bigint, "
              "bin_offset int, bin_capacity int, bin_used int")
    return runs.drop("row").mapInArrow(_pack_shards(capacities), schema)


def _pack_shards(capacities: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current: int | None = None
        for b in batches:
            shard = b["shard"].to_numpy()
            start = 0
            while start < b.num_rows:
                if shard[start] != current:
                    if held:
                        yield _pack_one(held, current, capacities)
                    held, current = [], int(shard[start])
                end = start + int((shard[start:] == current).sum())  # sorted: equal shards are together
                held.append(b.slice(start, end - start))
                start = end
        if held:
            yield _pack_one(held, current, capacities)
    return run


def downsized(used: int, capacities: tuple[int, ...]) -> int:
    """The least permitted capacity that holds the contents."""
    return capacities[bisect_left(capacities, used)]


def total_cost(used: list[int], capacities: tuple[int, ...]) -> float:
    return sum(bin_cost(downsized(u, capacities)) for u in used)


def fill(n: int, room: int, lengths: list[int], count: dict[int, int]) -> int:
    """What a bin of ``n`` tokens with ``room`` left would hold, were it filled with the longest
    pieces left (``lengths`` ascending, ``count`` of each) that fit."""
    at = len(lengths)
    while room > 0:
        at = bisect_right(lengths, room, 0, at) - 1
        if at < 0:
            break
        m = lengths[at]
        k = min(count[m], room // m)
        n, room = n + k * m, room - k * m
    return n


def best_fit(lengths: list[int], capacities: tuple[int, ...], prefer: int | None = None
             ) -> tuple[list[int], list[int], list[int]]:
    """Bin number and offset per length (descending; 0: bin -1), and the room used per bin.

    A bin is opened at the size whose cost per token is least once it is filled with
    what is left and downsized; with ``prefer`` at this size wherever the piece fits."""
    count = Counter(n for n in lengths if n)
    left = sorted(count)  # the lengths still to be placed
    rooms: list[int] = []  # the distinct rooms of open bins, ascending
    open_bins: dict[int, list[int]] = {}
    number, offset, used = [], [], []
    for n in lengths:
        if n == 0:
            number.append(-1)
            offset.append(0)
            continue
        count[n] -= 1
        if not count[n]:
            left.pop()  # the longest of those left
        at = bisect_left(rooms, n)
        if at < len(rooms):
            r = rooms[at]
            k = open_bins[r].pop()
            if not open_bins[r]:
                del open_bins[r], rooms[at]
        else:
            k = len(used)
            used.append(0)
            r = opening(n, left, count, capacities) if prefer is None else max(prefer, downsized(n, capacities))
        number.append(k)
        offset.append(used[k])
        used[k] += n
        rest = r - n
        if rest:
            if rest not in open_bins:
                insort(rooms, rest)
                open_bins[rest] = []
            open_bins[rest].append(k)
    return number, offset, used


def opening(n: int, left: list[int], count: dict[int, int], capacities: tuple[int, ...]) -> int:
    """The size of a new bin for a piece of ``n`` tokens."""
    best = None
    for c in capacities[bisect_left(capacities, n):]:
        held = fill(n, c - n, left, count)
        rated = (bin_cost(downsized(held, capacities)) / held, c)
        best = rated if best is None or rated < best else best
    return best[1]


def cheapest(lengths: list[int], capacities: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """The packing of least total cost among that which chooses each bin's size by what is
    left, and those that prefer one size throughout; the first of equal ones."""
    tried = (best_fit(lengths, capacities, prefer) for prefer in (None, *capacities))
    return min(tried, key=lambda p: total_cost(p[2], capacities))


def _pack_one(held: list[pa.RecordBatch], shard: int, capacities: tuple[int, ...]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    number, offset, used = cheapest(t["n_tokens"].to_pylist(), capacities)
    fitted = [downsized(u, capacities) for u in used]
    some = lambda values, kind: pa.array([v if k >= 0 else None for k, v in zip(number, values)], kind)
    out = pa.table({
        "doc_id": t["doc_id"], "piece": t["piece"], "start_token": t["start_token"], "n_tokens": t["n_tokens"],
        "bin_id": some(((shard << 32) | k for k in number), pa.int64()),
        "bin_offset": some(offset, pa.int32()),
        "bin_capacity": some((fitted[k] if k >= 0 else 0 for k in number), pa.int32()),
        "bin_used": some((used[k] if k >= 0 else 0 for k in number), pa.int32()),
    })
    return out.combine_chunks().to_batches()[0]
