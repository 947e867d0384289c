"""Connected components of an edge table, by hooking and contraction.

In each round every node that has a lesser neighbour is hooked to the least one, each hook is followed to its root, and
the edges between roots are what is left. A root that none of its neighbours hooked to has a lesser neighbour in the next
round, so the nodes are at least halved by every two rounds. Minima are aggregated map-side, so no neighbourhood is gathered
in one task. Only the minima of a round are dealt out by node; the tables that are joined to them stay as they are
while the hooks are few enough for a broadcast, and are merge-joined beyond that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import fits_broadcast, materialise, released


def _roots(hooks: DataFrame, beside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The hooks ``node, component``, each followed to where none goes on; what a step follows is twice as long as before."""
    while True:
        ahead = hooks.select(F.col("node").alias("component"), F.col("component").alias("ahead"))
        followed = hooks.join(beside(ahead), "component", "left")
        moved = materialise(followed.select("node", F.coalesce("ahead", "component").alias("component"), F.col("ahead").isNotNull().alias("moved")), "hooks")
        hooks = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return hooks


def absorbed(edges: DataFrame) -> DataFrame:
    """As ``connected_components``, without the nodes that are the least of their component."""
    c = F.col
    ends = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    with released(edges.sparkSession) as keep:
        now = materialise(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
        found = now.select(c("a").alias("node"), c("b").alias("component")).limit(0)
        while n := now.count():
            few = fits_broadcast(n)
            beside = F.broadcast if few else lambda df: df.hint("merge")
            hooks = _roots(materialise(now.groupBy(c("a").alias("node")).agg(F.min("b").alias("component")), "hooks"), beside)
            on = found.join(beside(hooks.toDF("component", "root")), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
            found = on.unionByName(hooks)
            # Copies of an edge are many rows of one key, which matters to merge joins alone.
            both = (now if few else now.distinct()).join(beside(hooks.toDF("a", "root_a")), "a").join(beside(hooks.toDF("b", "root_b")), "b", "left")
            x, y = c("root_a"), F.coalesce("root_b", "b")
            now = materialise(both.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")), "edges")
        return keep(materialise(found, "absorbed"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its least node.

    Null ends and edges from a node to itself are passed over; repeated edges count once; no edges give no rows.
    """
    found = absorbed(edges)
    roots = found.select(F.col("component").alias("node")).distinct()
    return found.unionByName(roots.withColumn("component", F.col("node")))
