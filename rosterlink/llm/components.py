"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def connected_components(edges: DataFrame, src: str, dst: str, rounds: int | None = None) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Minima are pre-aggregated before they move and the joins are plain equi-joins, so a hub that holds a large
    part of all edges is split by the adaptive skew join. Links, nodes and components never reach the driver:
    it only sees one checksum a round. Null ends and loops add nothing but the node itself. After a number of ``rounds``
    that is too small, nodes of one component may still have different values, each of them a node of that component.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    e = materialise(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    alone = e.where("u = v").select("u", "v")
    e = e.where("u <> v")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(large, before)
        last, mark = mark, _mark(e)
        rounds = rounds and rounds - 1
        if mark == last or rounds == 0:
            break
    roots = e.select(F.col("v").alias("u"), "v")
    return (
        e.unionByName(roots).unionByName(alone).groupBy("u").agg(F.min("v").alias("v"))
        .select(F.col("u").alias("node"), F.col("v").alias("component"))
    )
