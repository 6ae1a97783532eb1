"""Connected components by contraction: DataFrame operations only.

Each round every node joins the smallest of its neighbours and itself, chains of that are shortened once by looking
up the parent's parent, and the edges are rewritten to the parents; edges inside a group vanish. A node
that is not the smallest among its neighbours disappears, so the edges are gone after about log n rounds,
whatever the diameter. Each round's tables are written, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import saved


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, component: the smallest node that can be reached, for every node of ``edges`` (a, b).

    Edges have no direction; loops, repeated edges and edges with a null end change nothing and their nodes are
    listed only if another edge has them. No edges give no rows. Nodes can be of any type that has an order.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    pairs = saved(
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), folder
    )
    labels = None
    while not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        # A hub's neighbours are reduced to one before they are shuffled.
        near = saved(
            ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("parent")),
            folder,
        )
        above = near.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        parents = saved(near.join(above, "parent").select("node", F.col("top").alias("parent")), folder)
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            labels = saved(
                labels.join(moved, "component", "left").select(
                    "node", F.coalesce("parent", "component").alias("component")
                ),
                folder,
            )
        first = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        second = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        pairs = saved(
            pairs.join(first, "a")
            .join(second, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            folder,
        )
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
