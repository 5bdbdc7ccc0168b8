"""Connected components of a graph whose edges stay distributed.

Each round sends every node to its smallest neighbour, follows those pointers to their ends by
doubling, then contracts the graph to the ends. Every step is a join or an aggregate that Spark can
combine before the shuffle, so a component with a third of all nodes is no group that a task must hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v): undirected, any order, repeats and loops allowed. Returns (node, root) with one
    row for each node of an edge; ``root`` is one node of its component, the same for all of it.
    Nodes without an edge have no row. An empty input gives an empty result."""
    e = cut(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    label = None
    while not e.isEmpty():
        both = e.union(e.select("v", "u"))
        up = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root")), "parents")
        while True:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = cut(up.join(above, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "parents")
            up = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        low, high = up.toDF("u", "a"), up.toDF("v", "b")
        e = cut(e.join(low, "u").join(high, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        if label is None:
            label = up
        else:
            then = up.toDF("root", "next")
            label = cut(label.join(then, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
    return label if label is not None else e.toDF("node", "root")
