"""Connected components over any number of edges, without gathering them anywhere.

Each round hooks every node to its smallest neighbour, if that is smaller, follows the pointers
to their ends by doubling, and redraws the edges between those ends. Only nodes smaller than all
their neighbours survive a round, at most half of those with edges, so the rounds are logarithmic.
Minima are taken with partial sums on the map side; a hub's edges meet no single task there, and
in the joins Spark splits a hub's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import Shared


def components(edges: DataFrame, shared: Shared) -> DataFrame:
    """(node, root) for every node with an edge; root is a node of its component.

    edges: columns a and b. Null ends and loops are ignored; repeated edges do no harm."""
    live = shared.write(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not live.isEmpty():
        hooks = shared.write(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = shared.write(hooks.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            shared.drop(hooks)
            hooks = jumped
            if not moved:
                break
        hooks = hooks.select("node", "root")
        if labels is None:
            # nodes that are roots of this round label themselves
            ends = live.select(F.col("a").alias("node")).unionByName(live.select(F.col("b").alias("node"))).distinct()
            labels = shared.write(ends.join(hooks, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
        else:
            labels = shared.write(labels.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root")))
        a, b = (hooks.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
        moved = live.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).where("a <> b")
        last, live = live, shared.write(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        shared.drop(last)
    return labels if labels is not None else live.select(F.col("a").alias("node"), F.col("b").alias("root"))
