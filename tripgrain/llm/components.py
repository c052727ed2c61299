"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage


def _roots(hooks: DataFrame) -> DataFrame:
    """`node, root` for hooks `node, parent` in which every parent is below its node.

    Pointer jumping: each round halves the length of all chains.
    """
    while True:
        above = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("grandparent"))
        jumped = cut_lineage(
            hooks.join(above, "parent", "left").select(
                "node",
                F.coalesce("grandparent", "parent").alias("parent"),
                F.col("grandparent").isNotNull().alias("moved"),
            )
        )
        hooks = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            return hooks.withColumnRenamed("parent", "root")


def connected_components(links: DataFrame) -> DataFrame:
    """`node, root` for every node of `links` (columns `a`, `b` of type long).

    In each round every node hooks to its smallest neighbour if that is below itself, chains of
    hooks are shortened to their roots, and links are drawn between the roots instead. All nodes
    but local minima hook, so the number of linked nodes shrinks geometrically. Everything stays
    in Spark tables; only the emptiness of a table reaches the driver.
    """
    rest = cut_lineage(links.filter("a <> b").select("a", "b").distinct())
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        roots = _roots(cut_lineage(lowest.filter("parent < node")))
        if labels is None:
            labels = roots
        else:
            above = roots.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            moved = labels.join(above, "root", "left").select(
                "node", F.coalesce("higher", "root").alias("root")
            )
            known = labels.select("node")
            labels = cut_lineage(moved.unionByName(roots.join(known, "node", "left_anti")))
        for end in ("a", "b"):
            moved_to = roots.select(F.col("node").alias(end), "root")
            rest = rest.join(moved_to, end, "left").withColumn(end, F.coalesce("root", end))
            rest = rest.drop("root")
        rest = cut_lineage(rest.filter("a <> b").distinct())
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = labels.select(F.col("root").alias("node"), "root").distinct()
    return labels.unionByName(tops.join(labels.select("node"), "node", "left_anti"))
