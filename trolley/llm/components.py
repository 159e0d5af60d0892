"""Connected components of a graph given as a table of links.

Each round gives every node the smallest neighbour, follows those to their ends,
and replaces all nodes by the ends they found. The number of nodes that still
have links at least halves in a round. Every table is written below the shared
folder, so lineage stays short; only row counts come to the driver.
"""

from pyspark.sql import functions as F

from trolley.llm.common import stored


def _roots(links):
    """node and root: the end of the way along ever smaller neighbours."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    smallest = both.groupBy("node").agg(F.min("other").alias("other"))
    steps = stored(smallest.select("node", F.least("node", "other").alias("root")), "component_steps")
    while True:
        above = steps.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = stored(steps.join(above, "root").select("node", "next", (F.col("next") != F.col("root")).alias("moved")), "component_jumps")
        steps = jumped.select("node", F.col("next").alias("root"))
        if jumped.filter("moved").isEmpty():
            return steps


def components(links):
    """node and component for every node of ``links`` (a, b): the smallest node that it reaches.

    Links with a null end and links of a node to itself are ignored.
    """
    left = stored(links.filter("a is not null and b is not null and a != b").select("a", "b"), "component_links")
    labels = None
    while not left.isEmpty():
        roots = _roots(left)
        if labels is None:
            labels = roots.select("node", F.col("root").alias("component"))
        else:
            moved = roots.select(F.col("node").alias("component"), F.col("root").alias("now"))
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("now", "component").alias("component")
            )
        labels = stored(labels, "component_labels")
        for end in ("a", "b"):
            moved = roots.select(F.col("node").alias(end), F.col("root").alias("now"))
            left = left.join(moved, end).withColumn(end, F.col("now")).drop("now")
        left = stored(left.filter("a != b").select("a", "b").distinct(), "component_links")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
