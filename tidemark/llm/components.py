"""Connected components of a graph of links, by alternating star contractions.

Each round hangs every node's larger neighbours below its smallest neighbour (large star)
and then every node and its smaller neighbours below the smallest (small star). Links keep
their components and end as stars around each component's smallest node. Every round is a
few grouped aggregates and joins, written to the shared folder; no group is collected, and
only one row of counts per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(smallest, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.least("m", "a").alias("a"), "b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have a < b; node b hangs with its smaller neighbours below the smallest."""
    smallest = links.groupBy("b").agg(F.min("a").alias("m"))
    below = links.join(smallest, "b")
    return (
        below.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``links`` has the columns a and b (of one orderable type, a < b). The result has one
    row per linked node: ``node`` and ``label``, the smallest node of its component."""
    links = scratch.write(links.select("a", "b").distinct(), f"{name}_links")
    mark = None
    turn = 0
    while True:
        seen = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
        turn += 1
        links = scratch.write(_small_star(_large_star(links)), f"{name}_turn_{turn}")
    own = links.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(own)
