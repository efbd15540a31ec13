"""Near-duplicate embeddings by cover-tree dual traversal.

Vectors of one label are linked when the cosine of their angle is at least a
threshold; on unit vectors that is a Euclidean distance of at most
``sqrt(2 - 2 * threshold)``.

1. Equal vectors of a label form one class (a copy costs one light row).
2. Classes are sorted by label, nearest pivot and the distance to it, over all
   partitions, and cut into blocks of at most ``BLOCK`` vectors.  Pivots are a
   few vectors per label (those of the least hashes); every block keeps the
   range of its distances to each pivot.
3. Two blocks of a label are compared unless the ranges of some pivot lie
   further apart than the link distance (triangle inequality).  Blocks meet on
   bins of the distance to the first pivot, so blocks far apart never do.
4. A task holds two blocks.  Each gets a cover tree: nested levels of centres
   whose radii halve, every point of a level within the radius of a centre of
   the level above, with the true covering radius of each node.  Both trees
   are descended together; a pair of nodes is dropped when the distance of its
   centres exceeds the link distance plus both covering radii.  Surviving
   pairs of points are compared by their cosine in double precision.
5. A task emits one row per vector with links (their number, and the smallest
   vector it is connected to in there), never the pairs of a group.  Counts
   are summed and components taken over all tasks.

No pair within the threshold is lost.  Where the vectors of a label are all
about as far from each other (nothing can be pruned), the comparisons within it
grow with its square; tasks stay bounded.

Defined cases: a vector that is null, empty, zero or holds a null or
non-finite component links with nothing, as does one with a null label or
id; vectors of different length are not compared; rows sharing an id are
separate vectors; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.components import components
from indicata.llm.skew import salted_join
from indicata.llm.store import written

THRESHOLD = 0.98
BLOCK, PIVOTS = 1024, 8
SLACK = 1e-7  # on distances, far above rounding; the cosine decides
RADII = (1.0, 0.5, 0.25, 0.125)
WIDE, PAIRS = 4096, 200_000  # pairs of children worked out as one product; pairs held at once


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly),
    component_id (the smallest id reachable by links), kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    sound = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    key = F.when(sound, F.unhex(F.md5(F.to_json(F.struct("label", "v")).cast("binary"))))
    keyed = rows.select("vec_id", "label", "v", key.alias("key"))
    classes = written(keyed.where("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")  # node numbers are fixed from here on
    placed = _blocks(classes, block)
    links = written(_linked(placed, threshold), "links")
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(links.select("node", "root"), "node", "root")
    per = written(classes.select("node", "key", "rep", "copies").join(group, "node", "left").join(degree, "node", "left"), "per-class")
    least = written(per.where("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least")), "least")
    per = written(per.join(least, "component", "left").select(
        "key", "copies", F.coalesce("least", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "per-key")
    out = salted_join(keyed.select("vec_id", "key"), per, "key", "copies", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _blocks(classes: DataFrame, block: int) -> DataFrame:
    """(label, node, copies, v, far, block): far holds the distances to the
    label's pivots; a block is a run of the order by label, pivot, distance."""
    dim = F.concat_ws("/", F.col("label").cast("string"), F.size("v").cast("string"))
    unit = classes.select("node", "copies", "v", dim.alias("label"))
    # One pivot per label and hash class: the vector of the least hash, found map-side first.
    chosen = unit.groupBy("label", F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).alias("p")).agg(
        F.min_by("v", F.xxhash64("node", F.lit(1))).alias("v"))
    pivots = written(chosen.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("p", "v"))).alias("ps"))
                     .select("label", F.col("ps.v").alias("pivots")), "pivots")  # PIVOTS vectors a label

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far, which = [], []
            cache: dict = {}
            for label, v, pv in zip(b["label"].to_pylist(), b["v"], b["pivots"]):
                if label not in cache:
                    cache[label] = _unit(np.array(pv.as_py()))
                x = _unit(np.asarray(v.values)[None, :])[0]
                d = np.sqrt(np.maximum(2 - 2 * (cache[label] @ x), 0))
                far.append(d)
                which.append(int(d.argmin()))
            near = [float(d[w]) for d, w in zip(far, which)]
            yield pa.RecordBatch.from_arrays(
                [b["label"], b["node"], b["copies"], b["v"], pa.array([d.tolist() for d in far], pa.list_(pa.float64())),
                 pa.array(which, pa.int32()), pa.array(near, pa.float64())],
                names=["label", "node", "copies", "v", "far", "cell", "near"])

    measured = unit.join(pivots, "label").mapInArrow(
        distances, "label string, node bigint, copies bigint, v array<double>, far array<double>, cell int, near double")
    n = classes.count()
    parts = max(1, -(-n // (4 * block)))
    ranged = measured.repartitionByRange(parts, "label", "cell", "near", "node").sortWithinPartitions("label", "cell", "near", "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        number, filled, label = -1, block, None
        for b in batches:
            ids = []
            for x in b["label"].to_pylist():
                if x != label or filled == block:
                    number, filled, label = number + 1, 0, x
                filled += 1
                ids.append(base + number)
            yield pa.RecordBatch.from_arrays([b["label"], b["node"], b["copies"], b["v"], b["far"], pa.array(ids, pa.int64())],
                                             names=["label", "node", "copies", "v", "far", "block"])

    return written(ranged.mapInArrow(
        cut, "label string, node bigint, copies bigint, v array<double>, far array<double>, block bigint"), "blocks")


def _linked(placed: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) per vector and pair of blocks in which it has links."""
    spark = placed.sparkSession
    reach = float(np.sqrt(max(2 - 2 * threshold, 0))) + SLACK
    ranges = [c for k in range(PIVOTS) for c in (F.min(F.get("far", F.lit(k))).alias(f"lo{k}"), F.max(F.get("far", F.lit(k))).alias(f"hi{k}"))]
    boxes = written(placed.groupBy("label", "block").agg(*ranges), "boxes")
    # Bins as wide as the reach: blocks that may hold a link share a bin, one of
    # them taken a bin wider; each pair is kept at the first bin both have.
    bin_ = lambda c: F.floor(F.col(c) / reach).cast("int")
    low, high = bin_("lo0"), bin_("hi0") + 1
    a = boxes.withColumn("bin", F.explode(F.sequence(low, high))).withColumn("low", low)
    b = a.select(*(F.col(c).alias(f"{c}_") if c not in ("label", "bin") else F.col(c) for c in a.columns))
    apart = F.lit(False)
    for k in range(PIVOTS):
        apart = apart | F.coalesce((F.col(f"lo{k}_") - F.col(f"hi{k}") > reach) | (F.col(f"lo{k}") - F.col(f"hi{k}_") > reach), F.lit(False))
    pairs = a.join(b, ["label", "bin"]).where("block <= block_").where(F.col("bin") == F.greatest("low", "low_")).where(~apart)
    pairs = written(pairs.select("block", F.col("block_").alias("other")), "block-pairs")
    sides = pairs.select("block", "other", F.explode(F.when(F.col("block") == F.col("other"), F.array("block"))
                                                     .otherwise(F.array("block", "other"))).alias("side"))
    rows = sides.join(placed.select(F.col("block").alias("side"), "node", "copies", "v"), "side")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartition(parts, "block", "other").sortWithinPartitions("block", "other", "side", "node")
    return runs.mapInArrow(_traverse(threshold, reach), "node bigint, links bigint, root bigint")


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest part, against overflow)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class CoverTree:
    """Nested levels of centres over the unit vectors ``x``.

    ``levels[i]`` is (points, parent, cover): the points that are centres, the
    position of each one's parent in the level above, and the greatest distance
    of a centre to a point below it.  The last level is all points.  A level splits the
    points of every centre among it and new centres half as far, so that points are
    compared with centres of their own part only."""

    def __init__(self, x: np.ndarray):
        self.x, self.distances = x, 0  # how many were worked out
        every = np.arange(len(x))
        centre = np.zeros(len(x), int)  # position of each point's centre in the last level
        far = self._distance(every, np.zeros(len(x), int))  # and the distance to it
        net = np.zeros(1, int)
        self.levels = [(net, np.zeros(1, int), self._cover(centre, far, 1))]
        for radius in RADII:
            if len(net) == len(x):
                break
            parents, added = [np.arange(len(net))], []  # nested: a centre is its own parent
            home = centre.copy()
            left = np.flatnonzero(far > radius)
            n = len(net)
            while len(left):  # a round: one new centre among the uncovered points of every old one
                owner, first, which = np.unique(home[left], return_index=True, return_inverse=True)
                new = left[first]
                d = self._distance(left, new[which])
                inside = d <= radius
                inside[first] = True
                centre[left[inside]], far[left[inside]] = n + which[inside], d[inside]
                added.append(new)
                parents.append(owner)
                n, left = n + len(new), left[~inside]
            net = np.concatenate([net, *added])
            far[net] = 0.0
            self.levels.append((net, np.concatenate(parents), self._cover(centre, far, n)))
        if len(net) < len(x):
            rest = np.setdiff1d(every, net)
            self.levels.append((np.concatenate([net, rest]), np.concatenate([np.arange(len(net)), centre[rest]]), np.zeros(len(x))))

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        self.distances += len(a)
        return np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.x[a], self.x[b]), 0))

    @staticmethod
    def _cover(centre: np.ndarray, far: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, centre, far)
        return out + SLACK  # rounding of distances near 0

    def level(self, i: int):
        return self.levels[min(i, len(self.levels) - 1)]

    def children(self, i: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children at level i + 1: an order of that level by parent, and where
        in it each node's children start and how many they are."""
        if i + 1 >= len(self.levels):
            return np.arange(len(self.levels[-1][0])), nodes, np.ones(len(nodes), int)
        parent = self.levels[i + 1][1]
        order = np.argsort(parent, kind="stable")
        first = np.searchsorted(parent[order], nodes)
        return order, first, np.searchsorted(parent[order], nodes, side="right") - first


def dual_pairs(a: CoverTree, b: CoverTree, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(point of a, point of b) of all pairs not further apart than ``reach``;
    of a tree with itself every pair of different points comes once."""
    same = a is b
    left, right = np.zeros(1, int), np.zeros(1, int)
    depth = max(len(a.levels), len(b.levels))
    for i in range(1, depth + 1):  # the last round meets the points, whose covering radius is 0
        (pa_, _, ca), (pb_, _, cb) = a.level(i), b.level(i)
        order_a, first_a, n_a = a.children(i - 1, left)
        order_b, first_b, n_b = b.children(i - 1, right)
        found = []
        wide = n_a * n_b >= WIDE
        for k in np.flatnonzero(wide):  # many children: one product for all their pairs
            l = order_a[first_a[k]: first_a[k] + n_a[k]]
            r = order_b[first_b[k]: first_b[k] + n_b[k]]
            far = np.maximum(2 - 2 * (a.x[pa_[l]] @ b.x[pb_[r]].T), 0)
            near = far <= (reach + ca[l][:, None] + cb[r][None, :]) ** 2
            if same and left[k] == right[k]:
                near = np.triu(near)
            x, y = np.nonzero(near)
            found.append((l[x], r[y]))
        k = np.flatnonzero(~wide)
        pairs = n_a[k] * n_b[k]
        for part in np.split(k, np.searchsorted(np.cumsum(pairs), np.arange(PAIRS, pairs.sum(), PAIRS))):
            n = n_a[part] * n_b[part]
            own = np.repeat(part, n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            l = order_a[first_a[own] + at // n_b[own]]
            r = order_b[first_b[own] + at % n_b[own]]
            far = np.maximum(2 - 2 * np.einsum("ij,ij->i", a.x[pa_[l]], b.x[pb_[r]]), 0)
            near = far <= (reach + ca[l] + cb[r]) ** 2
            if same:
                near &= (left[own] != right[own]) | (l <= r)
            found.append((l[near], r[near]))
        left, right = (np.concatenate(c) for c in zip(*found))
    x, y = a.level(depth)[0][left], b.level(depth)[0][right]
    if same:
        x, y = x[x != y], y[x != y]
    return x, y


def _traverse(threshold: float, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            x, y = b["block"].to_numpy(), b["other"].to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if (int(x[lo]), int(y[lo])) != key and held:
                    yield _compare(held, key, threshold, reach)
                    held = []
                key = (int(x[lo]), int(y[lo]))
                held.append(b.slice(lo, hi - lo))
        if held:
            yield _compare(held, key, threshold, reach)
    return run


def _compare(held, key, threshold: float, reach: float) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    node, copies, side = (t[c].to_numpy() for c in ("node", "copies", "side"))
    vec = t["v"].chunk(0).flatten().to_numpy().reshape(len(node), -1)
    vec = np.ldexp(vec, -np.frexp(np.abs(vec).max(axis=1, keepdims=True))[1])  # by powers of two: exact, no square overflows
    size = np.linalg.norm(vec, axis=1)
    unit = _unit(vec)
    left = np.flatnonzero(side == key[0])
    right = np.flatnonzero(side == key[1])
    tree = CoverTree(unit[left])
    i, j = dual_pairs(tree, tree if key[0] == key[1] else CoverTree(unit[right]), reach)
    i, j = left[i], right[j]
    if key[0] == key[1]:
        i, j = np.minimum(i, j), np.maximum(i, j)
    linked = np.einsum("ij,ij->i", vec[i], vec[j]) / (size[i] * size[j]) >= threshold
    i, j = i[linked], j[linked]
    links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    root = node.copy()
    while len(i):  # smallest vector reachable inside this pair of blocks
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    has = links > 0
    return pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(links[has].astype(np.int64)), pa.array(root[has])],
                                      names=["node", "links", "root"])
