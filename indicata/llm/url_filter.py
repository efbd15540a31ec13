"""URL allow/block rules by a sort-merge range join.

A rule is (host, path prefix, verdict).  It fits its host and every
subdomain of it when the URL's path starts with the rule's path; the longest
rule (host and path together) wins, then the longer host, then ``block``.

Canonical key: the host's labels reversed, each followed by a dot
(``www.example.com`` -> ``com.example.www.``).  A rule's host then covers one
interval of keys and its path prefix one interval of paths; the intervals of any
two hosts, and of any two paths of a host, are nested or disjoint.  URLs and rules
are sorted by (key, path) together.  The sweep over a sorted run keeps a stack of
the hosts whose interval is still open.  Each open host holds its paths cut into
disjoint intervals with the winning rule of each (made from the sorted rules by a
second stack of nested prefixes), so a URL costs one binary search per
open host, whatever the number of rules.

Ranges: split points are (key, path, salt) triples from a hash-ordered
sample of at most ``SAMPLE`` rows.  The salt is a hash of the row and its
partition, so a host, a URL or a repeated row that is a third of all rows is spread
over many ranges.  Every URL falls in exactly one range.  A rule is copied to
each range that can hold a URL it fits: those of several hosts that its key
interval touches and, where a range lies inside one host, only if the path
intervals meet.  A task holds the rules of the hosts that are open together.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; rules with a null host, path or verdict are ignored, repeated ones count
once; repeated URLs give repeated rows; an empty table of either side works; other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE_PER_RANGE, SAMPLE = 40, 100_000
POINT_CHARS = 256  # of keys and paths in split points, which may be any text
_MAX = 2 ** 63


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substr(url, F.locate("://", url) + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(F.locate("://", url) > 0, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    rest = F.substr(url, F.locate("://", url) + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.locate("://", url) > 0, path).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def match_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", ranges: int | None = None) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``urls``.

    ``rules`` has string columns host, path, verdict.  ``verdict`` is the
    winning rule's, or ``default`` where none fits (``rule`` is null then).
    """
    spark = urls.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col(url_col).cast("string")
    left = urls.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    left = left.select("*", host_key(F.col("host")).alias("key"),
                       F.xxhash64(F.col("id"), F.col("host"), F.col("path"), F.spark_partition_id()).alias("salt"))
    bounds = _split_points(left, ranges)
    right = (rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"), "path", "verdict")
             .dropna().distinct().select("*", host_key(F.col("host")).alias("key")))

    id_type = left.schema["id"].dataType.simpleString()
    row = f"part int, kind int, key string, id {id_type}, host string, path string, verdict string"
    events = left.mapInArrow(_place_urls(bounds), row).unionByName(
        right.mapInArrow(_place_rules(bounds), row.replace(f"id {id_type}", "id string"))
        .withColumn("id", F.lit(None).cast(id_type)))
    runs = events.repartition(ranges, "part").sortWithinPartitions("part", "key", "kind", "path")
    return runs.mapInArrow(_sweep(default), f"id {id_type}, host string, path string, rule string, verdict string") \
        .withColumnRenamed("id", id_col)


def _split_points(left: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """At most ``ranges - 1`` (key, path, salt) points, from the rows of the smallest
    hashes; ``SAMPLE`` bounds what reaches the driver."""
    wanted = min(SAMPLE_PER_RANGE * ranges, SAMPLE)
    cut = left.select(F.left("key", F.lit(POINT_CHARS)).alias("key"), F.left("path", F.lit(POINT_CHARS)).alias("path"), "salt")
    sample = cut.orderBy(F.xxhash64("salt"), "key", "path").limit(wanted).collect()
    points = sorted((r.key, r.path, r.salt) for r in sample)
    step = max(1, len(points) // ranges)
    return sorted(set(points[step::step]))[: ranges - 1]


def after_prefix(prefix: str) -> str | None:
    """The least text above every text that starts with ``prefix``; None if there is none."""
    body = prefix.rstrip("\U0010ffff")
    return body[:-1] + chr(ord(body[-1]) + 1) if body else None


def _place_urls(bounds):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b[c].to_pylist() for c in ("key", "path", "salt")))
            part = [bisect_right(bounds, x) for x in rows]
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.repeat(pa.scalar(1, pa.int32()), n), b["key"], b["id"], b["host"],
                 b["path"], pa.nulls(n, pa.string())],
                names=["part", "kind", "key", "id", "host", "path", "verdict"])
    return place


def rule_parts(bounds: list[tuple[str, str, int]]):
    """The function (key, path) -> ranges that can hold a URL the rule fits."""
    # Range r lies between bounds r-1 and r.  One whose bounds have the same key
    # holds paths between theirs; neighbours of one key form a run.
    mixed = [r for r in range(len(bounds) + 1) if r in (0, len(bounds)) or bounds[r - 1][0] != bounds[r][0]]
    firsts = [r for r, point in enumerate(bounds) if r == 0 or bounds[r - 1][0] != point[0]]
    run_keys = [bounds[r][0] for r in firsts]
    ends = [*firsts[1:], len(bounds)]
    run_paths = [[p for _, p, _ in bounds[lo:hi]] for lo, hi in zip(firsts, ends)]

    def parts(key: str, path: str) -> list[int]:
        above = after_prefix(key)  # keys end in a dot, so there is one
        lo, hi = bisect_right(bounds, (key, "", -_MAX)), bisect_left(bounds, (above, "", -_MAX))
        out = mixed[bisect_left(mixed, lo): bisect_right(mixed, hi)]
        end = after_prefix(path)
        for run in range(bisect_left(run_keys, key), bisect_left(run_keys, above)):
            paths = run_paths[run]
            # Range firsts + j + 1 holds the paths from paths[j] to paths[j + 1], both included.
            low = max(bisect_left(paths, path) - 1, 0)
            high = len(paths) - 1 if end is None else min(bisect_left(paths, end), len(paths) - 1)
            out = out + list(range(firsts[run] + 1 + low, firsts[run] + 1 + high))
        return out
    return parts


def _place_rules(bounds):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts_of = rule_parts(bounds)
        for b in batches:
            part, at = [], []
            for i, (key, path) in enumerate(zip(b["key"].to_pylist(), b["path"].to_pylist())):
                to = parts_of(key, path)
                part += to
                at += [i] * len(to)
            rules = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.repeat(pa.scalar(0, pa.int32()), len(at)), rules["key"],
                 pa.nulls(len(at), pa.string()), rules["host"], rules["path"], rules["verdict"]],
                names=["part", "kind", "key", "id", "host", "path", "verdict"])
    return place


class HostRules:
    """The rules of one host, added by rising path, as disjoint path intervals:
    from ``starts[i]`` up to ``starts[i + 1]`` the winner is ``wins[i]``."""

    def __init__(self, key: str):
        self.key = key
        self.starts: list[str] = [""]
        self.wins: list[tuple | None] = [None]
        self.nested: list[tuple[str, str | None, tuple]] = []  # (path, end, rule) of open prefixes

    def add(self, host: str, path: str, verdict: str) -> None:
        rule = (len(host) + len(path), len(host), verdict == "block", host + path, verdict)
        self._close(path)
        if self.nested and self.nested[-1][0] == path:
            rule = max(rule, self.nested.pop()[2])
        self.nested.append((path, after_prefix(path), rule))
        self._mark(path, rule)

    def best(self, path: str) -> tuple | None:
        """The winner for a URL's path; no rule is added afterwards."""
        if self.nested:
            self._close(None)
            self.nested = []
        return self.wins[bisect_right(self.starts, path) - 1]

    def _close(self, upto: str | None) -> None:
        while self.nested:
            end = self.nested[-1][1]
            if end is None or (upto is not None and end > upto):
                return
            self.nested.pop()
            self._mark(end, self.nested[-1][2] if self.nested else None)

    def _mark(self, at: str, rule: tuple | None) -> None:
        if self.starts[-1] == at:
            self.wins[-1] = rule
        else:
            self.starts.append(at)
            self.wins.append(rule)


def _sweep(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: int | None = None
        stack: list[HostRules] = []  # open hosts, outermost first
        for b in batches:
            parts, kinds = b["part"].to_numpy(), b["kind"].to_numpy()
            keys, hosts, paths, verdicts = (b[c].to_pylist() for c in ("key", "host", "path", "verdict"))
            # Rows of one range, key and kind are handled together.
            new = [0, *(i for i in range(1, b.num_rows) if keys[i] != keys[i - 1]
                        or parts[i] != parts[i - 1] or kinds[i] != kinds[i - 1]), b.num_rows]
            found: list[tuple | None] = []
            for lo, hi in zip(new, new[1:]):
                if lo == hi:
                    continue
                if parts[lo] != part:
                    part, stack = parts[lo], []
                while stack and not keys[lo].startswith(stack[-1].key):
                    stack.pop()
                if kinds[lo] == 0:
                    if not stack or stack[-1].key != keys[lo]:
                        stack.append(HostRules(keys[lo]))
                    for i in range(lo, hi):
                        stack[-1].add(hosts[i], paths[i], verdicts[i])
                    continue
                last, best = None, None
                for i in range(lo, hi):
                    if paths[i] != last:
                        last = paths[i]
                        best = max((r for r in (open_.best(last) for open_ in stack) if r), default=None)
                    found.append(best)
            kept = b.filter(pa.array(kinds == 1))
            yield pa.RecordBatch.from_arrays(
                [kept["id"], kept["host"], kept["path"], pa.array([r and r[3] for r in found], pa.string()),
                 pa.array([r[4] if r else default for r in found], pa.string())],
                names=["id", "host", "path", "rule", "verdict"])
    return sweep
