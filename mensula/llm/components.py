"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the lowest of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).withColumn("low", F.least("u", "low"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every lower neighbour of a node, and the node, are linked to the lowest of them."""
    low = _lowest(links)
    others = links.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return others.unionByName(low.select("u", F.col("low").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node`, `root` for every node of a link that is not its own root; roots and lone nodes are left out.

    `root` is the lowest node of the component. NULL ends and loops are no links. The links are
    written to the shared folder after each round; only their number and a sum of hashes reach
    the driver. A node with very many links is pre-aggregated for its minimum, and the joins are
    ordinary ones that Spark can split where a node is hot.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    links = settle(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high.alias("u"), low.alias("v")).distinct()
    )
    before = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or seen[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        links = settle(_small_star(_large_star(links).distinct()).distinct())
