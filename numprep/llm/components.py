"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component), of the nodes that rows (a, b) link; a component is named by its least node.

    Each round takes the least name among a node and its neighbours, and then that name's own name, so that long chains
    halve. Rounds are stored, and no node's neighbours meet in one task: names are minimised before the shuffle. The end
    is reached when no link has two names.
    """
    edges = links.select("a", "b").union(links.select("b", "a"))
    names = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "names")
    while True:
        near = (
            edges.join(names, edges["b"] == names["node"])
            .groupBy("a")
            .agg(F.min("component").alias("least"))
            .withColumnRenamed("a", "node")
        )
        lowered = names.join(near, "node").select("node", F.least("component", "least").alias("name"))
        jump = names.select(F.col("node").alias("name"), F.col("component").alias("further"))
        names = stored(lowered.join(jump, "name").select("node", F.col("further").alias("component")), "names")
        ends = [names.select(F.col("node").alias(e), F.col("component").alias(f"name_{e}")) for e in ("a", "b")]
        if links.join(ends[0], "a").join(ends[1], "b").where("name_a != name_b").isEmpty():
            return names
