"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import checkpointed
from usagelens.llm._scan import joined


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns u, v), root being the smallest node of its component.

    Alternates the large-star and small-star steps until the links stop
    changing: each round sends every node's neighbours to its smallest one, so
    the number of rounds grows with the logarithm of a component's width.  The
    links are checkpointed each round; only their count and a hash reach the driver.
    The neighbours of a node with very many links are joined to it by a broadcast
    (``_scan.joined``); after that step a node has links to many smaller ones only where
    many groups meet in it.
    """
    current = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = joined(both, checkpointed(least), ["u"], "n", 2 * state[0], stored=True)
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = checkpointed(small.select("e.*").filter("u != v").distinct())
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
