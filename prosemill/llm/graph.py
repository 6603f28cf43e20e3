"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, label): the smallest node that each node of an edge reaches.

    Each round joins every edge to the smallest neighbour of its ends, which are found by map-side
    minima; the rounds grow with the logarithm of the longest path.  Minima are stored before the
    join, so that a node with very many edges is split by skew handling.
    """
    e = F.col(u), F.col(v)
    now = stored(
        edges.where(e[0] != e[1]).select(F.greatest(*e).alias("u"), F.least(*e).alias("v")).distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")), "star")
        large = stored(
            both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(),
            "edges",
        )
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = stored(small, "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
