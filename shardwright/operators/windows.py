"""Training-window sampling from token shards.

Draws are counter-based: ``u(seed, step, micro[, row])`` is the first 52 bits
of an md5, so any engine reproduces the same windows, and a retried task
redraws identically. A window ``[start, start + T]`` is gathered from fixed
T-token chunks of its shard: it touches at most two chunks, so gathering is
an equi-join on chunk id, never a range join over token positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import IGNORE_INDEX

TWO52 = float(2 ** 52)


def _field(name: str):
    return lambda p: p[name]


def uniform(seed: int, *cols) -> F.Column:
    """Counter-based uniform in [0, 1) from md5 of ``seed|c1|c2...``."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / TWO52


def draws(spark, steps: int, accum: int, batch: int) -> DataFrame:
    """(step, micro, row) for every sequence of every micro-batch."""
    n = steps * accum * batch
    return spark.range(n).select(
        (F.col("id") / (accum * batch)).cast("long").alias("step"),
        ((F.col("id") / batch).cast("long") % accum).alias("micro"),
        (F.col("id") % batch).alias("row"))


def shard_weights(shards: DataFrame) -> DataFrame:
    """Token share of each shard within its split, plus its token range (A5)."""
    w = Window.partitionBy("split").orderBy("shard_id").rowsBetween(Window.unboundedPreceding, -1)
    tot = Window.partitionBy("split")
    return shards.select(
        "split", "shard_id", "tokens",
        F.coalesce(F.sum("tokens").over(w), F.lit(0)).alias("lo"),
        F.sum("tokens").over(tot).alias("total"),
        (F.col("tokens") / F.sum("tokens").over(tot)).alias("weight"))


def pick_shards(d: DataFrame, weights: DataFrame, split: str, seed: int, bucket: int) -> DataFrame:
    """One shard per (step, micro), chosen with probability = token share
    (X1): target ``floor(u * total)`` falls in exactly one shard's token range.
    Shards are cut into ``bucket``-token buckets so the match is an equi-join
    on bucket (shards are at least ``bucket`` tokens except the last)."""
    w = weights.filter(F.col("split") == split)
    wb = w.select("*", F.explode(F.sequence(F.floor(F.col("lo") / bucket),
                                            F.floor((F.col("lo") + F.col("tokens") - 1) / bucket))).alias("bk"))
    total = w.agg(F.max("total")).scalar()
    t = F.floor(uniform(seed, "step", "micro") * total)
    dd = d.withColumn("t", t).withColumn("bk", F.floor(F.col("t") / bucket))
    j = dd.join(wb, "bk").filter((F.col("t") >= F.col("lo")) & (F.col("t") < F.col("lo") + F.col("tokens")))
    return j.select("step", "micro", "row", "split", "shard_id", F.col("tokens").alias("shard_tokens"))


def text_starts(picked: DataFrame, block: int, seed: int) -> DataFrame:
    """Uniform start in [0, len - T - 2] (X2: the upper bound is exclusive); fails
    if a drawn shard holds no window."""
    u = uniform(seed, "step", "micro", "row")
    n = F.col("shard_tokens") - block - 1
    ok = F.assert_true(n > 0, F.lit("a shard holds fewer than block_size + 2 tokens"))
    return picked.withColumn("start", F.when(ok.isNull(), F.floor(u * n)).cast("long"))


def valid_chat_starts(convs: DataFrame, shards: DataFrame, block: int) -> DataFrame:
    """Conversation starts leaving a full window, ``start <= tokens - T - 1``
    (inclusive), densely indexed per shard (P3); fails if a shard has none."""
    v = convs.join(shards.select("split", "shard_id", "tokens"), ["split", "shard_id"]) \
        .filter(F.col("shard_start") <= F.col("tokens") - block - 1)
    w = Window.partitionBy("split", "shard_id").orderBy("shard_start")
    v = v.select("split", "shard_id", "shard_start", (F.row_number().over(w) - 1).alias("idx"))
    counts = shards.join(v.groupBy("split", "shard_id").agg(F.count(F.lit(1)).alias("n_valid")),
                         ["split", "shard_id"], "left")
    n = F.coalesce("n_valid", F.lit(0))
    # n_valid is only defined through the check, so it can never be pruned away.
    ok = F.assert_true(n > 0, F.lit("a shard holds fewer than block_size + 1 tokens after its starts"))
    return v, counts.select("split", "shard_id", F.when(ok.isNull(), n).alias("n_valid"))


def chat_starts(picked: DataFrame, valid: DataFrame, counts: DataFrame, seed: int) -> DataFrame:
    """Start = the ``floor(u * n_valid)``-th valid start of the shard."""
    p = picked.join(counts.select("split", "shard_id", "n_valid"), ["split", "shard_id"])
    p = p.withColumn("idx", F.floor(uniform(seed, "step", "micro", "row") * F.col("n_valid")).cast("long"))
    return p.join(valid, ["split", "shard_id", "idx"]).withColumnRenamed("shard_start", "start")


def needed_chunks(starts: DataFrame, block: int) -> DataFrame:
    """(split, shard_id, chunk): the chunks that drawn windows touch."""
    first = F.floor(F.col("start") / block)
    return starts.select("split", "shard_id", F.explode(F.array(first, first + 1)).alias("chunk")).distinct()


def chunks_of(rows: DataFrame, pos_col: str, len_col: str, block: int) -> DataFrame:
    """Each row once per chunk that it lies in."""
    return rows.filter(F.col(len_col) > 0).select("*", F.explode(F.sequence(
        F.floor(F.col(pos_col) / block), F.floor((F.col(pos_col) + F.col(len_col) - 1) / block))).alias("chunk"))


def chunk_stream(rows: DataFrame, pos_col: str, len_col: str, arrays: list[str], block: int,
                 needed: DataFrame | None = None) -> DataFrame:
    """Re-cut each shard's token stream into fixed ``block``-token chunks, or
    into the ``needed`` ones of them.

    ``rows``: (split, shard_id, pos, len, *arrays) with ``pos`` the row's first
    position in its shard. Output: (split, shard_id, chunk, *arrays) with each
    chunk's arrays in stream order; a chunk holds at most ``block`` tokens.
    """
    r = chunks_of(rows, pos_col, len_col, block)
    if needed is not None:
        r = r.join(needed, ["split", "shard_id", "chunk"], "left_semi")
    a = F.greatest(F.col(pos_col), F.col("chunk") * block)
    b = F.least(F.col(pos_col) + F.col(len_col), (F.col("chunk") + 1) * block)
    pieces = r.select("split", "shard_id", "chunk", (a - F.col("chunk") * block).alias("off"),
                      *[F.slice(c, (a - F.col(pos_col) + 1).cast("int"), (b - a).cast("int")).alias(c) for c in arrays])
    g = pieces.groupBy("split", "shard_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("off", *arrays))).alias("parts"))
    return g.select("split", "shard_id", "chunk",
                    *[F.flatten(F.transform("parts", _field(c))).alias(c) for c in arrays])


def gather(starts: DataFrame, chunks: DataFrame, arrays: list[str], block: int) -> DataFrame:
    """Tokens ``[start, start + T]`` of each draw from its (at most) two chunks."""
    d = starts.select("step", "micro", "row", "split", "shard_id", "start",
                      F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    d = d.withColumn("chunk", F.floor(F.col("start") / block) + F.col("k"))
    j = d.join(chunks, ["split", "shard_id", "chunk"])
    g = j.groupBy("step", "micro", "row", "split", "shard_id", "start").agg(
        F.array_sort(F.collect_list(F.struct("k", *arrays))).alias("parts"))
    off = (F.col("start") - F.floor(F.col("start") / block) * block + 1).cast("int")
    return g.select("step", "micro", "row", "split", "shard_id", "start",
                    *[F.slice(F.flatten(F.transform("parts", _field(c))), off, block + 1).alias(c)
                      for c in arrays])


def text_windows(win: DataFrame, block: int) -> DataFrame:
    """x = first T tokens, y = the T tokens after the first."""
    return win.withColumn("x", F.slice("tokens", 1, block)).withColumn("y", F.slice("tokens", 2, block))


def chat_windows(win: DataFrame, block: int) -> DataFrame:
    """As text, plus targets masked to -100 where their mask is 0."""
    w = text_windows(win, block)
    m = F.slice("mask", 2, block)
    return w.withColumn("y", F.zip_with("y", m, lambda t, k: F.when(k == 1, t).otherwise(F.lit(IGNORE_INDEX))))


def tokens_seen(step_col: str, block: int, batch: int, accum: int) -> F.Column:
    """Tokens trained on when a step (from 0) is done."""
    return ((F.col(step_col) + 1) * (accum * batch * block)).cast("long")


def budget_row(tokens, block: int, batch: int, accum: int, max_iters=None, epochs=None) -> list:
    """tokens/iter = accum x batch x T; total; epochs; a chat budget sets
    max_iters = max(1, int(epochs x tokens / per_iter)) (A6, W11)."""
    per_iter = accum * batch * block
    iters = max_iters if max_iters is not None else F.greatest(
        F.lit(1), F.floor(F.lit(float(epochs)) * tokens / per_iter)).cast("long")
    iters = F.lit(iters).cast("long") if isinstance(iters, int) else iters
    return [F.lit(per_iter).cast("long").alias("tokens_per_iter"), iters.alias("max_iters"),
            (iters * per_iter).alias("total_tokens"),
            F.round(iters * per_iter / tokens, 6).alias("epochs")]
