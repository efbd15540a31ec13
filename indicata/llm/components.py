"""Connected components by contraction, as joins and aggregates.

Each round every node moves to the neighbour (or itself) with the least hash;
the edges are rewritten to the nodes' new places, and those inside one place
vanish.  The hash order is new in every round, so chains shrink by a
constant factor each time and the rounds grow with the logarithm of the
longest one.  Every round's tables are written to the shared folder; only the
number of remaining edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.store import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge between two different
    nodes; ``component`` is the smallest node of its component.  Null ends,
    loops and repeated edges are ignored."""
    pair = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = written(pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    round_ = 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_)).alias("h"), F.col(c).alias("to"))
        moves = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), rank("a")).getField("to").alias("to"))
        moves = written(moves, "moves")
        if labels is None:
            labels = moves.select("node", F.col("to").alias("label"))
        else:
            step = moves.select(F.col("node").alias("label"), "to")
            labels = written(labels.join(step, "label", "left")
                             .select("node", F.coalesce("to", "label").alias("label")), "labels")
        at = moves.select(F.col("node").alias("a"), F.col("to").alias("x"))
        bt = moves.select(F.col("node").alias("b"), F.col("to").alias("y"))
        left = written(left.join(at, "a").join(bt, "b").where("x <> y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        round_ += 1
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # Written, so that both sides of the join are plain shuffles and a component
    # with a large share of the nodes can be split.
    least = written(labels.groupBy("label").agg(F.min("node").alias("component")), "least")
    return labels.join(least, "label").select("node", "component")
