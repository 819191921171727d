"""Connected components of links between 64-bit nodes.

Alternating stars (Kiveris and others, 2014): every node points its larger neighbours, then its
smaller ones, at the smallest node it knows, until nothing changes. Each round's links are a table
in the shared folder, so a lost executor costs no more than that round. A node with very many
links is met by joins only, which Spark can split; what is grouped by node is combined first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.reliable import saved


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (smallest node reachable) of all nodes in `links` (a, b).

    Loops, repeated links and links with null are allowed and change nothing.
    """
    current = saved(_oriented(links), "links")
    state = _state(current)
    while state[0]:
        large = _star(current, both=True)
        current = saved(_star(saved(large, "large-star"), both=False), "small-star")
        after = _state(current)
        if after == state:
            break
        state = after
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(centres)


def _oriented(links: DataFrame) -> DataFrame:
    return (
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    """Number and checksum of the links: equal for equal tables."""
    return tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Large star (`both`): larger neighbours get the node's least; small star: smaller ones do."""
    if both:
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = links
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = saved(least.withColumn("m", F.least("u", "m")), "least")  # else its layout would keep the join whole
    if both:
        met = sides.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        met = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        met = met.unionByName(least.select("u", F.col("m").alias("v")))
    return met.filter("u > v").distinct()
