"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.session import cut


def _fingerprint(links: DataFrame) -> tuple[int, int, int]:
    """Number of distinct links and two sums over them, by which sets of links are told apart."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).first()
    return row[0], row[1] or 0, row[2] or 0


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b).

    The component is the smallest node of it.  Alternating large-star and
    small-star steps point each node at a smaller neighbour until nothing
    changes; a hub's neighbours are aggregated as single minima, never listed.
    The links are checkpointed each round, so a lost executor costs one round.
    Self links are harmless; an empty table gives an empty result.
    """
    links = cut(edges.select("a", "b").filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _fingerprint(links)
    for _ in range(max_rounds if state[0] else 0):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        after = cut(small)
        links, state, last = after, _fingerprint(after), state
        if state == last:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
