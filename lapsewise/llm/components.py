"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lapsewise.llm.common import BROADCAST_BYTES, materialize, small


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the component's least node.

    Each round joins every node to the least node of its neighbourhood (large
    star, then small star) and is written to the shared folder; the number of
    rounds grows with the logarithm of the links.  Self links and nulls are
    ignored.  No component is ever gathered in one place.
    """
    edges = (links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
             .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    edges, before = _written(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("c"), F.least("a", "m").alias("m"))
        large = _joined(both, least, edges).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
        small_star = _joined(large, least, edges).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, now = _written(
            small_star.unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b"))).distinct())
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _joined(rows: DataFrame, least: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the least neighbour of their node; ``least`` has a row a node, so
    at most two for each row of the counted ``edges``."""
    return rows.join(F.broadcast(least) if small(edges, BROADCAST_BYTES // 2) else least, rows["a"] == least["c"])


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and a digest of them taken in the same pass."""
    seen = Observation()
    table = materialize(edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "a")).alias("y")), "links")
    got = seen.get
    return table, (got["n"], got["x"], got["y"])
