"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import through_table


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b); comp is some node of its component.

    Every node goes to the least of its neighbours and itself, links are moved to where their ends went,
    and what is still linked goes on. Node ids are hashes, so each round leaves a fraction of the nodes.
    Each round is written to the shared folder; nothing but "is anything left" comes to the driver.
    """
    edges = through_table(links.select("a", "b").where("a <> b").distinct(), "links")
    mapped = through_table(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp")), "nodes"
    )
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        least = through_table(least, "least")
        ends = lambda x: least.select(F.col("a").alias(x), F.col("to").alias(f"{x}_to"))  # noqa: B023, E731
        moved = edges.join(ends("a"), "a").join(ends("b"), "b")
        edges = through_table(
            moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).where("a <> b").distinct(), "links"
        )
        mapped = through_table(
            mapped.join(ends("comp"), "comp", "left").select("node", F.coalesce("comp_to", "comp").alias("comp")), "nodes"
        )
    return mapped
