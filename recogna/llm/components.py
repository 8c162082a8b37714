"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recogna.llm.common import stored


def mixed(column: str):
    """The id under which a long takes part; xxhash64 is one-to-one on longs, so no two ids meet."""
    return F.xxhash64(F.col(column))


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every end of a link (a, b); nodes share a root exactly if links connect them.

    ``node`` and ``root`` are ``mixed`` ids. Every round sends each node to the smallest id among
    itself and its neighbours, and once more to where that one went, then relabels and dedups the
    links; mixed ids are in random order, so descending chains are short and the number of
    nodes with links falls by a constant factor a round. A node's smallest neighbour is an aggregate
    with map-side partial minima, and a hub's links meet one row of the step table, so adaptive
    execution can split its partition. Each round's two tables are kept in the shared folder.
    Self links and repeated links are allowed; no links give no rows.
    """
    links = stored(
        links.select(F.least(mixed("a"), mixed("b")).alias("a"), F.greatest(mixed("a"), mixed("b")).alias("b"))
        .where("a < b")
        .distinct(),
        f"{name}-links",
    )
    steps = []
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        down = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        down = down.select("node", F.least("node", "near").alias("root"))
        further = down.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = stored(down.join(further, "root").select("node", F.col("next").alias("root")), f"{name}-step")
        steps.append(step)
        to_a = step.select(F.col("node").alias("a"), F.col("root").alias("new_a"))
        to_b = step.select(F.col("node").alias("b"), F.col("root").alias("new_b"))
        moved = links.join(to_a, "a").join(to_b, "b")
        moved = moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        links = stored(moved.where("a < b").distinct(), f"{name}-links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tree = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("later"))
        tree = tree.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return stored(tree, f"{name}-roots")
