"""Connected components of a table of links, by alternating star steps.

Each round replaces the links by a smaller-diameter set with the same
components: the large-star step points every larger neighbour of a node to the
least node around it, the small-star step does so for the node and its smaller
neighbours. Rounds grow with the logarithm of the longest path. Every round is
written as a table in the shared folder, so lineage stays short and a lost
executor re-reads files; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written: then both sides of the join are plain shuffles, and a hub is split
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v); the root is the least node."""
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        links = written(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
