"""Connected components of a table of links, by alternating stars, on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators.sizing import checkpoint_table


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) -> node, root: the smallest node that each linked node reaches. Nodes without links do not occur.

    A round hangs the larger neighbours of every node on its smallest one, then the smaller ones; rounds grow with
    the logarithm of the longest path. Each round is written to the shared folder, so no plan grows and a lost executor
    costs one round; minima are aggregated before they are shuffled, and joins are by node, so a hub can be split.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    links = checkpoint_table(links, "links")
    before = _digest(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        small = small.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        links = checkpoint_table(small, "links")
        after = _digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
