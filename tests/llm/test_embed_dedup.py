import numpy as np
import pytest

from indicata.llm import embed_dedup
from indicata.llm.embed_dedup import CoverTree, dual_pairs


def brute(rows, threshold=0.98):
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ok = []
    for i, v, label in rows:
        good = i is not None and label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, np.float32).astype(float) if good else None)
    for a in range(n):
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y):
                continue
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, links[k], least.get(top(k)), i is not None and least[top(k)] == i) for k, (i, *_) in enumerate(rows)), key=str)


def vectors(seed=0, n=300, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = np.concatenate([rng.normal(size=(n // 3, dim)), np.repeat(centres, n // 36, axis=0) + rng.normal(size=(12 * (n // 36), dim)) * 0.12,
                        np.repeat(centres[:3], n // 9, axis=0) * rng.uniform(0.5, 3, (3 * (n // 9), 1))])
    return x.astype(np.float32)


def rows_of(x, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(v) for v in x[k]], int(rng.integers(labels))) for k, i in enumerate(rng.permutation(len(x)))]
    dim = x.shape[1]
    return rows + [(5001, None, 1), (5002, [], 1), (5003, [0.0] * dim, 1), (5004, [float("nan")] * dim, 1), (5005, [None] * dim, 1),
                   (5006, [float("inf")] + [1.0] * (dim - 1), 1), (5007, rows[0][1], None), (None, rows[0][1], rows[0][2]),
                   (5008, rows[0][1], rows[0][2]), (5008, rows[0][1], rows[0][2]), (5009, [1.0, 0.0], 1), (5010, [2.0, 0.0], 1),
                   (5011, [1e-30] * dim, 0), (5012, [1e30] * dim, 0)]


@pytest.mark.parametrize("block", [20, 1024])
def test_equals_brute_force(spark, block):
    rows = rows_of(vectors())
    frame = spark.createDataFrame([(*r, "k", 1, 2) for r in rows],
                                  "vec_id long, embedding array<float>, label int, key string, node int, rep int")
    got = embed_dedup.near_duplicates(frame.repartition(4), block=block).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_dual_traversal_finds_all_pairs(seed):
    a, b = (embed_dedup._unit(vectors(seed + k, 360).astype(float)) for k in (0, 0))
    b = b[::2]
    i, j = dual_pairs(CoverTree(a), CoverTree(b), 0.2)
    d = np.sqrt(np.maximum(2 - 2 * a @ b.T, 0))
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(d <= 0.2 - 1e-9))))
    assert want <= set(zip(i.tolist(), j.tolist())) and len(set(zip(i.tolist(), j.tolist()))) == len(i)


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_with_itself_gives_each_pair_once(seed):
    x = embed_dedup._unit(vectors(seed, 360).astype(float))
    tree = CoverTree(x)
    i, j = dual_pairs(tree, tree, 0.2)
    got = [(min(p), max(p)) for p in zip(i.tolist(), j.tolist())]
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    want = {(p, q) for p, q in zip(*map(np.ndarray.tolist, np.nonzero(d <= 0.2 - 1e-9))) if p < q}
    assert want <= set(got) and len(set(got)) == len(got) and all(p != q for p, q in got)


def test_tree_levels_are_nested_and_cover():
    x = embed_dedup._unit(vectors(3, 360).astype(float))
    tree = CoverTree(x)
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    assert sorted(tree.levels[-1][0]) == list(range(len(x)))
    for (above, _, _), (net, parent, _), radius in zip(tree.levels, tree.levels[1:], (2.0, *embed_dedup.RADII)):
        assert set(above) <= set(net)
        assert (d[net, above[parent]] <= radius + 1e-6).all()


def test_tiny_and_huge_components(spark):
    rows = [(1, [1e-200, 1e-200], 1), (2, [2e-200, 2e-200], 1), (3, [1e200, 1e200], 1), (4, [3e250, 3e250], 1),
            (5, [1e-200, -1e-200], 1), (6, [5e-324, 5e-324], 1), (7, [1.0, 1e-300], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 6: (4, 1), 5: (0, 5), 7: (0, 7)}


def test_tree_is_built_without_all_distances():
    rng = np.random.default_rng(4)
    x = np.concatenate([c + 0.02 * rng.standard_normal((64, 32)) for c in rng.standard_normal((16, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = embed_dedup.CoverTree(x)
    assert tree.distances < len(x) ** 2 / 8
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    below = np.arange(len(x))
    assert sorted(tree.levels[-1][0]) == list(range(len(x)))
    for i in range(len(tree.levels) - 1, -1, -1):
        points, parent, cover = tree.levels[i]
        at = points[below]
        assert (d[at, tree.levels[-1][0]] <= cover[below] + 1e-7).all()
        if i and i <= len(embed_dedup.RADII):
            assert (tree.levels[i - 1][0] == points[:len(tree.levels[i - 1][0])]).all()
        below = parent[below]
