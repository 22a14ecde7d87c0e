"""Connected components of an edge list, by alternating large and small stars.

A large star hangs a node's larger neighbours on its least one, a small star its smaller ones; edges only get shorter and
never join what was not joined. Rounds grow with the logarithm of the longest chain. Every round is stored in the shared
folder; nothing is gathered in one place but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u that is not the least of its component, v being the least. ``edges`` has long u and v."""
    edges = stored(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small(_large(edges)).where(F.col("u") != F.col("v")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
