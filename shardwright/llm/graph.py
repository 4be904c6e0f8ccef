"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


#: Links that one task takes between rounds.
LINKS_PER_TASK = 1 << 18


def _dense(edges: DataFrame, n: int) -> DataFrame:
    """As many partitions as ``n`` links need; rounds over few links then leave few files."""
    return edges.coalesce(max(1, -(-n // LINKS_PER_TASK)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge table; root is the component's smallest node.

    Each round links every node to the smallest node around it, first over
    larger neighbours, then over smaller ones, until nothing changes (rounds
    grow with the logarithm of the longest path). Minima are combined before
    their shuffle, no node's neighbours are gathered, and every round is cut by
    a checkpoint. Loops and repeated edges do no harm; no edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialise(e)
    state = _state(e)
    e = _dense(e, state[0])
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(_dense(small, state[0]))
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
