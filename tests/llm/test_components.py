import random

from indicata.llm.components import components


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(300)]  # a long chain
    edges += [(1000, 1001 + k) for k in range(200)]  # a star
    edges += [(2000 + rng.randrange(300), 2000 + rng.randrange(300)) for _ in range(200)]
    edges += [(5, 5), (None, 3), (4, None), (0, 1), (1, 0)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
