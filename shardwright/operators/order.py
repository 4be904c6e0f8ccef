"""Order-dependent primitives over explicit keys, without global windows.

* :func:`ordinal`      dense 0-based rank of a unique key (W1): range partitions
  of the key, counts per partition, offsets over that small table, then
  ``row_number`` inside each partition.
* :func:`prefix_sum`   running sum over a dense ordinal (W2): block sums, a
  running sum over the block table, then a running sum inside each block.
* :func:`reset_segments`  greedy "close the segment at the first unit end where
  it holds >= S" (W5): blocks of units become step functions from the goal they
  are entered with to the one they are left with, composed level by level.

Windows over rows are partitioned by a bucket of about ``ROWS_PER_BUCKET`` or
``PREFIX_BLOCK`` rows; those without a bucket run over per-bucket or per-segment
tables (rows = data / bucket size).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows per block of the two-level running sum.
PREFIX_BLOCK = 8192
# Rows per range partition of the key in an ordinal.
ROWS_PER_BUCKET = 1 << 18
# Units per block of the shard roll, and blocks (or groups of them) composed at once.
SEGMENT_BLOCK = 1 << 20
SEGMENT_FAN = 16


def ordinal(df: DataFrame, key: str, out: str = "ord", part_cols: list[str] | None = None,
            rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Dense 0-based rank of ``key`` (any sortable type, unique within ``part_cols``).

    Pass a narrow frame (key and the few columns needed downstream). The range
    partitions, as many as the row count asks for, are fixed by a checkpoint
    before their counts are taken.
    """
    part_cols = list(part_cols or [])
    df = df.checkpoint()
    k = max(1, math.ceil(df.count() / rows_per_bucket))
    bucketed = df.repartitionByRange(k, *part_cols, key).withColumn("__bkt", F.spark_partition_id())
    if k > 1:
        bucketed = bucketed.checkpoint()
    counts = bucketed.groupBy(*part_cols, "__bkt").agg(F.count(F.lit(1)).alias("__cnt"))
    wb = Window.partitionBy(*part_cols).orderBy("__bkt").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(*part_cols, "__bkt",
                            F.coalesce(F.sum("__cnt").over(wb), F.lit(0)).alias("__off"))
    joined = bucketed.join(offsets, [*part_cols, "__bkt"])
    w = Window.partitionBy(*part_cols, "__bkt").orderBy(key)
    res = joined.withColumn(out, (F.row_number().over(w) - 1 + F.col("__off")).cast("long")) \
        .drop("__bkt", "__off")
    # Narrow result, read by several later steps: write it to the checkpoint
    # folder, which also cuts the lineage (and the plan) here.
    return res.checkpoint()


def prefix_sum(df: DataFrame, ord_col: str, size_col: str, out: str = "start",
               part_cols: list[str] | None = None, block: int = PREFIX_BLOCK,
               inclusive: bool = False) -> DataFrame:
    """Running sum of ``size_col`` in ``ord_col`` order (exclusive by default)."""
    part_cols = list(part_cols or [])
    b = F.floor(F.col(ord_col) / F.lit(block)).cast("long")
    x = df.withColumn("__blk", b)
    sums = x.groupBy(*part_cols, "__blk").agg(F.sum(size_col).alias("__bs"))
    wb = Window.partitionBy(*part_cols).orderBy("__blk").rowsBetween(
        Window.unboundedPreceding, -1)
    base = sums.select(*part_cols, "__blk",
                       F.coalesce(F.sum("__bs").over(wb), F.lit(0)).alias("__base"))
    x = x.join(base, [*part_cols, "__blk"])
    w = Window.partitionBy(*part_cols, "__blk").orderBy(ord_col).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    return x.withColumn(out, (F.col("__base") + F.coalesce(F.sum(size_col).over(w), F.lit(0)))
                        .cast("long")).drop("__blk", "__base")


def reset_segments(units: DataFrame, ord_col: str, size_col: str, target: int,
                   part_cols: list[str] | None = None, out: str = "seg",
                   block: int = SEGMENT_BLOCK, fan: int = SEGMENT_FAN) -> DataFrame:
    """Assign each unit (dense ``ord_col`` per ``part_cols``, ``size_col`` > 0)
    to a segment that closes at the first unit end where it holds >= target.

    Adds ``out`` (segment number, from 0) and ``__end`` (inclusive prefix sum).

    After a boundary at p the next one is the first unit end at or past the goal
    p + target. A block of units therefore maps the goal it is entered with to the
    goal it is left with, a step function with at most one step per unit that ends
    within ``target`` of the block's start. The functions of ``fan`` neighbours are
    composed until one is left, then the goals go back down to the blocks. The
    units are read twice; tables above them have a step or less per unit of the
    first ``target`` tokens of a block, and shrink ``fan``-fold a level.
    """
    part_cols = list(part_cols or [])
    S = int(target)
    u = prefix_sum(units, ord_col, size_col, out="__end", part_cols=part_cols, inclusive=True) \
        .withColumn("__g", F.floor(F.col(ord_col) / F.lit(block)).cast("long")).checkpoint()
    keys = [u.schema[c] for c in part_cols]
    steps = T.StructType(keys + [T.StructField(c, T.LongType()) for c in ("__g", "lo", "hi", "goal", "hops")])

    def block_steps(key, t):
        p = np.sort(t["__end"].to_numpy())
        lo = _block_start(t, size_col)
        last, hops = _last_hop(p, S)
        n = np.searchsorted(p, lo + S) + 1
        return _step_table(key, steps, lo, p[:n], p[last[:n]] + S, hops[:n])

    def compose(key, t):
        t = t.sort_by([("__c", "ascending"), ("hi", "ascending")])
        child, hi = t["__c"].to_numpy(), t["hi"].to_numpy()
        goals, jumps = t["goal"].to_numpy(), t["hops"].to_numpy()
        lo = t["lo"][0].as_py()
        g = hi[:np.searchsorted(hi, lo + S) + 1].copy()
        at, hops = g.copy(), np.zeros(len(g), np.int64)
        for a, b in _runs(child):
            i = np.searchsorted(hi[a:b], at)
            m = i < b - a
            hops[m] += jumps[a:b][i[m]]
            at[m] = goals[a:b][i[m]]
        return _step_table(key, steps, lo, g, at, hops)

    levels = [u.groupBy(*part_cols, "__g").applyInArrow(block_steps, steps).checkpoint()]
    width = (u.agg(F.max("__g")).first()[0] or 0) + 1
    while width > 1:
        up = levels[-1].withColumn("__c", F.col("__g")).withColumn("__g", F.floor(F.col("__g") / fan).cast("long"))
        levels.append(up.groupBy(*part_cols, "__g").applyInArrow(compose, steps).checkpoint())
        width = math.ceil(width / fan)

    entry = T.StructType(keys + [T.StructField(c, T.LongType()) for c in ("__g", "goal", "seg")])

    def descend(key, t):
        t = t.sort_by([("__c", "ascending"), ("hi", "ascending")])
        child, hi = t["__c"].to_numpy(), t["hi"].to_numpy()
        goals, jumps = t["goal"].to_numpy(), t["hops"].to_numpy()
        at, seg, rows = t["__at"][0].as_py(), t["__seg"][0].as_py(), []
        for a, b in _runs(child):
            rows.append((int(child[a]), at, seg))
            i = a + int(np.searchsorted(hi[a:b], at))
            if i < b:
                at, seg = int(goals[i]), seg + int(jumps[i])
        cols = [pa.array([k.as_py()] * len(rows)) for k in key[:-1]] + [pa.array(c, pa.int64()) for c in zip(*rows)]
        return _as(entry, cols)

    # Every part starts at 0, so its first goal is the target itself.
    enter = levels[-1].select(*part_cols, "__g").distinct() \
        .select(*part_cols, "__g", F.lit(S).cast("long").alias("goal"), F.lit(0).cast("long").alias("seg"))
    for below in reversed(levels[:-1]):
        kids = below.withColumn("__c", F.col("__g")).withColumn("__g", F.floor(F.col("__g") / fan).cast("long"))
        parents = enter.select(*part_cols, "__g", F.col("goal").alias("__at"), F.col("seg").alias("__seg"))
        enter = kids.join(parents, [*part_cols, "__g"]).groupBy(*part_cols, "__g").applyInArrow(descend, entry)

    columns = [c for c in u.columns if c != "__g"]
    result = T.StructType([u.schema[c] for c in columns] + [T.StructField(out, T.IntegerType())])

    def number(key, t):
        t = t.sort_by("__end")
        p = t["__end"].to_numpy()
        closes = _boundaries(p, S, t["__at"][0].as_py())
        seg = t["__seg"][0].as_py() + np.cumsum(closes) - closes
        return _as(result, [*(t[c] for c in columns), pa.array(seg, pa.int32())])

    enter = enter.select(*part_cols, "__g", F.col("goal").alias("__at"), F.col("seg").alias("__seg"))
    return u.join(enter, [*part_cols, "__g"]).groupBy(*part_cols, "__g").applyInArrow(number, result).checkpoint()


def _block_start(t: pa.Table, size_col: str) -> int:
    """Sum of all units before a block: its first end less that unit's size."""
    return pc.min(pc.subtract(t["__end"], t[size_col].cast(pa.int64()))).as_py()


def _next_hop(p: np.ndarray, target: int) -> np.ndarray:
    """Index of the boundary after each unit end, ``len(p)`` if it lies outside
    (which is followed by itself)."""
    return np.append(np.searchsorted(p, p + target), len(p))


def _last_hop(p: np.ndarray, target: int):
    """The last boundary of the block that a chain from each unit end reaches, and
    the boundaries on the way, both ends included."""
    n = len(p)
    nxt = _next_hop(p, target)[:n]
    at = np.where(nxt < n, nxt, np.arange(n))
    hops = (nxt < n).astype(np.int64)
    while True:
        further = at[at]
        if np.array_equal(further, at):
            return at, hops + 1
        hops, at = hops + hops[at], further


def _boundaries(p: np.ndarray, target: int, goal: int) -> np.ndarray:
    """Which unit ends are boundaries if the block is entered with ``goal``."""
    jump = _next_hop(p, target)
    mark = np.zeros(len(p) + 1, bool)
    mark[np.searchsorted(p, goal)] = True
    while (jump[:-1] < len(p)).any():
        mark[jump[mark]] = True
        jump = jump[jump]
    return mark[:-1].astype(np.int64)


def _runs(a: np.ndarray):
    cuts = np.flatnonzero(a[1:] != a[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)])


def _as(schema: T.StructType, cols) -> pa.Table:
    s = to_arrow_schema(schema)
    return pa.Table.from_arrays([(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).cast(f.type)
                                 for c, f in zip(cols, s)], schema=s)


def _step_table(key, schema, lo, hi, goal, hops) -> pa.Table:
    """Steps as rows, neighbours of equal value as one."""
    keep = np.append((goal[1:] != goal[:-1]) | (hops[1:] != hops[:-1]), True)
    n = int(keep.sum())
    return _as(schema, [*(pa.array([k.as_py()] * n) for k in key), pa.array(np.full(n, lo)),
                        *(pa.array(c[keep]) for c in (hi, goal, hops))])
