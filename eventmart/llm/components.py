"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventmart.session import settle


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each linked id can reach, from links (a, b).

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest one, then its smaller ones. The rounds grow with the logarithm of the longest
    chain, and no step gathers the neighbours of a node: minima are grouped sums that start in
    the map tasks, and joined back. Each round is written, so a lost executor repeats one round.
    """
    def least_of(table: DataFrame, own: bool) -> DataFrame:
        least = F.least(F.min("b"), F.col("a")) if own else F.min("b")
        return table.groupBy("a").agg(least.alias("m"))

    def to_larger(table: DataFrame) -> DataFrame:
        both = table.unionAll(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joined = both.join(least_of(both, True), "a").where("b > a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))

    def to_smaller(table: DataFrame) -> DataFrame:
        joined = table.join(least_of(table, False), "a")
        pair = F.array(F.struct(F.col("b").alias("a")), F.struct(F.col("a").alias("a")))
        moved = joined.select(F.explode(pair).alias("node"), F.col("m").alias("b"))
        return moved.select("node.a", "b").where("a <> b").distinct()

    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    before = None
    while True:
        seen = Observation()
        # links are distinct, so 128 bits of hash change whenever they do
        state = [F.bit_xor(F.xxhash64(*pair)).alias("".join(pair)) for pair in (("a", "b"), ("b", "a"))]
        state.append(F.count("*").alias("n"))
        links = settle(to_smaller(to_larger(links)).observe(seen, *state))
        if seen.get == before:
            break
        before = seen.get
    root = F.array("a", "b")  # links are stars now; a root is its own component
    each = links.select(F.explode(root).alias("id"), F.col("b").alias("component"))
    return settle(each.distinct())
