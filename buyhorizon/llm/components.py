"""Connected components of a graph of links, by alternating star contractions.

Each round joins every node's neighbours to the smallest of them (first the
larger neighbours, then the smaller ones), which ends in one star per component
after few rounds even for long chains. Rounds are stored tables; the smallest
neighbours are stored before they are joined back, so both sides of that join
are plain shuffles and adaptive execution can split the partition of a hub.
Only a count and a hash of the links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One contraction of links (u > v); ``larger``: move larger neighbours, else smaller ones."""
    both = links.union(links.select("v", "u")) if larger else links
    least = stored(both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m")), "least")
    if larger:
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = links.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return stored(moved.where("u > v").distinct(), "links")


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (two columns of one integer type) to (node, root): root is the smallest node reachable.

    Nodes without links are not in the result; loops and repeated links are fine.
    """
    a, b = links.columns
    links = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links")
    seen = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        links = _star(_star(links, True), False)
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
