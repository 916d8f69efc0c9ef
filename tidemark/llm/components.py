"""Connected components of an undirected graph, by alternating stars.

Every round joins on node ids and takes minima, which Spark combines before the
shuffle; no node's neighbours are ever gathered in one place. Rounds are cut by
checkpoints on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))).alias("s")).first()
    return row.n, row.x, row.s


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for every node but the roots.

    ``edges`` has columns a and b of one type; direction, repeats and loops do
    not matter, rows with a null end are no edges. No edges: an empty result.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    before = _state(edges)
    while before[0]:
        # Large star: each greater neighbour of u moves to the least neighbour of u.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = edges.join(least, edges.b == least.u).select("a", F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        # Small star: u and its lesser neighbours all move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        moved = large.join(low, large.a == low.u).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut(moved.where("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
