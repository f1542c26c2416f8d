"""Connected components of links that no machine could hold: alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.sources.scratch import write_scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v): the root is the least node it reaches.

    Large and small stars in turn hang each node on lower and lower ones until every node
    hangs on its root; the rounds grow with the logarithm of the longest chain. Each round
    is written to the shared folder. The driver sees one count and one checksum.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    now = write_scratch(edges.filter("u != v").select(high.alias("u"), low.alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = write_scratch(small.unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        last, mark = mark, _mark(following)
        now = following
        if mark == last:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
