"""Run-metric analytics over scalar logs ``(run, path, seq, tag, step, value, wall_time)``.

Merging keeps the last write per (run, tag, step) in (path, seq) order;
every derived table (loss table, best-so-far, medians, EMA, step times,
utilisation, learning-rate audit, run config) starts from the merged log.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DEFAULT_PEAK_FLOPS, UTILISATION_TOLERANCE, ModelConfig


#: Config keys: the model (utilisation) and the learning-rate schedule, in the order of ``lr_schedule``.
MODEL_KEYS = ("vocab_size", "block_size", "n_layer", "n_head", "n_embd", "d_ff", "tokens_per_iter")
RATE_KEYS = ("learning_rate", "min_lr", "warmup_iters", "lr_decay_iters")


def scalars_from_events(events: DataFrame) -> DataFrame:
    """Fixture stand-in for event files: tag = event_type, run = user_id % 3,
    path = user_id % 7, step = whole hours since the first event, seq = event_id."""
    # ts may arrive without a zone; read it as session-time (UTC) instants.
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    t0 = events.agg(F.min(F.unix_micros("ts"))).scalar()
    return events.select(
        (F.col("user_id") % 3).cast("string").alias("run"),
        (F.col("user_id") % 7).cast("string").alias("path"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("tag"),
        F.floor((F.unix_micros("ts") - t0) / F.lit(3_600_000_000)).cast("long").alias("step"),
        F.col("value").cast("double").alias("value"),
        F.col("ts").alias("wall_time"),
        "props", "user_id")


def merge_scalars(scalars: DataFrame) -> DataFrame:
    """Last write wins per (run, tag, step), in (path, seq) order."""
    order = F.struct("path", "seq")
    return scalars.groupBy("run", "tag", "step").agg(
        F.max_by("value", order).alias("value"),
        F.max_by("wall_time", order).alias("wall_time"))


def series(merged: DataFrame, tag: str) -> DataFrame:
    """One tag as (run, step, value)."""
    return merged.filter(F.col("tag") == tag).select("run", "step", "value", "wall_time")


def loss_table(merged: DataFrame, train_tag: str, val_tag: str) -> DataFrame:
    """Steps present in both losses, 4-decimal text, gap from unrounded values
    (J1, A12, O5, S16 rows)."""
    tr = series(merged, train_tag).select("run", "step", F.col("value").alias("train"))
    va = series(merged, val_tag).select("run", "step", F.col("value").alias("val"))
    j = tr.join(va, ["run", "step"], "inner")
    return j.select("run", F.col("step").alias("iter"),
                    F.format_string("%.4f", "train").alias("train_loss"),
                    F.format_string("%.4f", "val").alias("val_loss"),
                    F.format_string("%.4f", F.col("val") - F.col("train")).alias("gap"))


def write_loss_csv(table: DataFrame, path: str) -> None:
    """Metrics CSV with header (S16), one file per run directory."""
    table.write.mode("overwrite").partitionBy("run").option("header", True).csv(path)


STEP_BLOCK = 4096


def best_so_far(merged: DataFrame, val_tag: str, block: int = STEP_BLOCK) -> DataFrame:
    """Running best and the improvement flag; step 0 is never saved.

    Two-level running min: within blocks of ``block`` steps (a merged series
    has one row per step, so a block holds at most ``block`` rows), plus the
    min of all earlier blocks from the block table."""
    s = series(merged, val_tag).withColumn("blk", F.floor(F.col("step") / block))
    w = Window.partitionBy("run", "blk").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("in_prev", F.min("value").over(w))
    bm = s.groupBy("run", "blk").agg(F.min("value").alias("bmin"))
    wb = Window.partitionBy("run").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    bm = bm.select("run", "blk", F.min("bmin").over(wb).alias("blk_prev"))
    s = s.join(bm, ["run", "blk"]).withColumn("prev_best", F.least("in_prev", "blk_prev"))
    improved = F.col("prev_best").isNull() | (F.col("value") < F.col("prev_best"))
    return s.select("run", "step", "value",
                    F.least("value", F.coalesce("prev_best", "value")).alias("best"),
                    improved.alias("improved"),
                    (improved & (F.col("step") > 0)).alias("saved"))


def final_values(merged: DataFrame, val_tag: str) -> DataFrame:
    """Per (run, tag): last step and value, range, points; per run: tag and
    evaluation counts (A18, A20, A22)."""
    per = merged.groupBy("run", "tag").agg(
        F.max("step").alias("final_step"), F.max_by("value", "step").alias("final_value"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("n_points"))
    runs = merged.groupBy("run").agg(F.count_distinct("tag").alias("n_tags"),
                                     F.count_if(F.col("tag") == val_tag).alias("n_evals"))
    return per.join(runs, "run")


def eval_means(scalars: DataFrame, split_tags: dict, log_every: int) -> DataFrame:
    """Mean of the batch losses logged per (run, step, split) (A11), with the
    logging cadence flag ``step % log_every = 0`` (P14)."""
    m = F.create_map(*[x for k, v in split_tags.items() for x in (F.lit(v), F.lit(k))])
    s = scalars.filter(F.col("tag").isin(list(split_tags.values()))).withColumn("split", m[F.col("tag")])
    return s.groupBy("run", "step", "split").agg(
        F.round(F.avg("value"), 6).alias("mean_loss"), F.count(F.lit(1)).alias("n_batches")) \
        .withColumn("logged", F.col("step") % log_every == 0)


MEDIAN_ACCURACY = 100_000


def upper_median(values: DataFrame, group_cols: list[str], value_col: str = "value",
                 accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """values[n // 2] of each group's sorted values (A14): the upper median,
    exact, not an interpolated percentile.

    No group is sorted whole: ``percentile_approx`` brackets the target rank
    within a few n/accuracy ranks; ``count_if(v < lo)`` is aggregated map-side;
    only the distinct values inside the bracket are ranked (about
    8n/accuracy per group). Groups whose bracket misses the rank (not expected
    from the approximation bound) fall back to an exact sort of that group.
    """
    # Read three times below: materialise the narrow input once.
    values = values.select(*group_cols, value_col).checkpoint()
    v = F.col(value_col)
    d = 4.0 / accuracy
    stats = values.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx(v, [max(0.0, 0.5 - d), min(1.0, 0.5 + d)], accuracy).alias("__q"))
    stats = stats.select(*group_cols, "__n", F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi"),
                         F.floor(F.col("__n") / 2).alias("__k")).checkpoint()
    x = values.select(*group_cols, v.alias("__v")).join(stats, group_cols)
    below = x.groupBy(*group_cols).agg(F.count_if(F.col("__v") < F.col("__lo")).alias("__below"))
    inr = x.filter((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))) \
        .groupBy(*group_cols, "__v").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*group_cols).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    inr = inr.withColumn("__cum", F.sum("__c").over(w)).join(below, group_cols).join(stats.select(*group_cols, "__k"), group_cols)
    hit = inr.filter((F.col("__below") + F.col("__cum") > F.col("__k"))
                     & (F.col("__below") + F.col("__cum") - F.col("__c") <= F.col("__k")))
    found = hit.select(*group_cols, F.col("__v").alias("median"))
    missing = stats.select(*group_cols).join(found, group_cols, "left_anti")
    # Fallback (bracket missed): exact sort, only for the groups that missed.
    rest = values.join(missing, group_cols, "left_semi")
    return found.unionByName(_median_by_sort(rest, group_cols, value_col))


def _median_by_sort(values: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    wf = Window.partitionBy(*group_cols).orderBy(value_col)
    r = values.select(*group_cols, F.col(value_col).alias("median"), F.row_number().over(wf).alias("__rn"),
                      F.count(F.lit(1)).over(Window.partitionBy(*group_cols)).alias("__n"))
    return r.filter(F.col("__rn") == F.floor(F.col("__n") / 2) + 1).select(*group_cols, "median")


def steady_medians(merged: DataFrame, tags: list[str], val_tag: str) -> DataFrame:
    """Upper median of each perf tag excluding evaluation steps (J5, P12) and
    step 0 (P13); 0.0 for a series left empty."""
    perf = merged.filter(F.col("tag").isin(tags))
    evals = series(merged, val_tag).select("run", "step")
    kept = perf.join(evals, ["run", "step"], "left_anti").filter(F.col("step") > 0)
    med = upper_median(kept, ["run", "tag"])
    keys = perf.select("run", "tag").distinct()
    return keys.join(med, ["run", "tag"], "left").select(
        "run", "tag", F.coalesce("median", F.lit(0.0)).alias("median"))



EMA_BLOCK = 4096


def affine_scan(m: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All prefix compositions of the maps ``x -> m_i x + b_i``, the first one innermost:
    each round doubles the number of maps that an entry composes."""
    m, b, d = m.copy(), b.copy(), 1
    while d < len(m):
        b[d:] = m[d:] * b[:-d] + b[d:]
        m[d:] = m[d:] * m[:-d]
        d *= 2
    return m, b


def ema(merged: DataFrame, tags: list[str], frac: float = 0.03, block: int = EMA_BLOCK) -> DataFrame:
    """Exponential moving average per (run, tag) series in step order, seeded
    with the first value, alpha from the series length (W8).

    Each value is the affine map ``acc -> (1 - a) acc + a v`` and composing maps is
    associative, so it is a scan in two levels and no group of points exceeds
    ``block`` rows: the maps of a block are composed from its start; a scan over the
    (small) block table carries each block's incoming value; then
    ``ema_i = (1 - a)^(i - start + 1) * carry_in + local_i``.
    """
    import pandas as pd

    from .order import ordinal

    s = merged.filter(F.col("tag").isin(tags)).select("run", "tag", "step", "value")
    n = s.groupBy("run", "tag").agg(F.count(F.lit(1)).alias("n"))
    span = F.greatest(F.lit(2), F.floor(F.col("n") * frac))
    n = n.withColumn("alpha", F.greatest(F.lit(0.05), F.lit(2.0) / (span + 1)))
    s = ordinal(s, "step", out="pos", part_cols=["run", "tag"]).join(n, ["run", "tag"]) \
        .withColumn("blk", F.floor(F.col("pos") / block))

    local_schema = T.StructType([
        T.StructField("run", T.StringType()), T.StructField("tag", T.StringType()),
        T.StructField("blk", T.LongType()), T.StructField("step", T.LongType()),
        T.StructField("k", T.LongType()), T.StructField("loc", T.DoubleType()),
        T.StructField("alpha", T.DoubleType()), T.StructField("v", T.DoubleType())])

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        a = float(pdf["alpha"].iloc[0])
        v = pdf["value"].to_numpy(dtype=np.float64)
        _, out = affine_scan(np.full(len(v), 1 - a), a * v)
        pos = pdf["pos"].to_numpy()
        return pd.DataFrame({"run": pdf["run"].to_numpy(), "tag": pdf["tag"].to_numpy(),
                             "blk": pdf["blk"].to_numpy(), "step": pdf["step"].to_numpy(),
                             "k": pos - pos.min() + 1, "loc": out, "alpha": a, "v": v})

    rows = s.select("run", "tag", "blk", "step", "pos", "value", "alpha") \
        .groupBy("run", "tag", "blk").applyInPandas(local, local_schema).checkpoint()
    blocks = rows.groupBy("run", "tag", "blk").agg(
        F.max("k").alias("len"), F.max_by("loc", "k").alias("loc_end"), F.min_by("v", "k").alias("v_first"),
        F.first("alpha").alias("alpha"))

    carry_schema = T.StructType([
        T.StructField("run", T.StringType()), T.StructField("tag", T.StringType()),
        T.StructField("blk", T.LongType()), T.StructField("carry", T.DoubleType())])

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blk")
        a = float(pdf["alpha"].iloc[0])
        first = float(pdf["v_first"].iloc[0])   # acc_{-1} = v_0 makes acc_0 = v_0
        m, b = affine_scan((1 - a) ** pdf["len"].to_numpy(np.float64), pdf["loc_end"].to_numpy(np.float64))
        out = np.append(first, (m * first + b)[:-1])
        return pd.DataFrame({"run": pdf["run"].to_numpy(), "tag": pdf["tag"].to_numpy(),
                             "blk": pdf["blk"].to_numpy(), "carry": out})

    # One row per block: at most (series length / block) rows per group.
    carries = blocks.groupBy("run", "tag").applyInPandas(carry, carry_schema)
    j = rows.join(carries, ["run", "tag", "blk"])
    return j.select("run", "tag", "step",
                    (F.pow(1 - F.col("alpha"), F.col("k")) * F.col("carry") + F.col("loc")).alias("ema"))


def step_times(merged: DataFrame, tag: str, block: int = STEP_BLOCK) -> DataFrame:
    """Seconds between consecutive logged steps' clocks (W10). The previous
    clock comes from the same block of steps, or for a block's first step from
    the last clock of the previous non-empty block (block table)."""
    s = series(merged, tag).withColumn("blk", F.floor(F.col("step") / block)) \
        .withColumn("us", F.unix_micros("wall_time"))
    w = Window.partitionBy("run", "blk").orderBy("step")
    s = s.withColumn("prev_in", F.lag("us").over(w))
    last = s.groupBy("run", "blk").agg(F.max_by("us", "step").alias("last_us"))
    last = last.select("run", "blk", F.lag("last_us").over(Window.partitionBy("run").orderBy("blk")).alias("prev_blk"))
    s = s.join(last, ["run", "blk"])
    return s.select("run", "step", ((F.col("us") - F.coalesce("prev_in", "prev_blk")) / 1e6).alias("dt_seconds"))


def config_text(scalars: DataFrame) -> DataFrame:
    """Markdown ``|param|value|`` table per (run, path, seq) (S14). Fixture
    stand-in for each run's recorded hyperparameters: k from props, the event
    kind and user; signups record an ``init_from``."""
    k = F.get_json_object("props", "$.k")
    lines = F.array(F.lit("|param|value|"), F.lit("|---|---|"),
                    F.concat(F.lit("|k|"), k, F.lit("|")),
                    F.concat(F.lit("|event|"), F.col("tag"), F.lit("|")),
                    F.concat(F.lit("|user|"), F.col("user_id").cast("string"), F.lit("|")))
    init = F.when(F.col("tag") == "signup",
                  F.array(F.concat(F.lit("|init_from|ckpt-"), F.col("user_id").cast("string"), F.lit("|"))))
    all_lines = F.concat(lines, F.coalesce(init, F.array().cast("array<string>")))
    return scalars.select("run", "path", "seq", F.array_join(all_lines, "\n").alias("text"))


def parse_config(texts: DataFrame) -> DataFrame:
    """(run, key, value): table rows with exactly two cells whose first cell is
    not a header; later (path, seq, line) wins (S15)."""
    lines = texts.select("run", "path", "seq", F.posexplode(F.split("text", "\n")).alias("line", "txt"))
    cells = lines.withColumn("cells", F.transform(
        F.split(F.regexp_replace(F.trim("txt"), r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c)))
    rows = cells.filter((F.size("cells") == 2) & ~F.col("cells")[0].isin("param", "---"))
    return rows.groupBy("run", F.col("cells")[0].alias("key")).agg(
        F.max_by(F.col("cells")[1], F.struct("path", "seq", "line")).alias("value"))


def lr_schedule(step, lr: float, min_lr: float, warmup: int, decay: int):
    """Warm-up then cosine to min_lr, flat after ``decay`` (F1)."""
    ratio = F.try_divide(step - warmup, F.lit(decay - warmup))
    cos = min_lr + 0.5 * (1.0 + F.cos(F.lit(math.pi) * ratio)) * (lr - min_lr)
    return F.when(step < warmup, lr * (step + 1) / (warmup + 1)) \
        .when(step > decay, F.lit(min_lr)).otherwise(cos)


def config_values(configs: DataFrame) -> DataFrame:
    """A row per run of :func:`parse_config`'s numbers, null where a key is missing or no number."""
    wide = configs.filter(F.col("key").isin(*MODEL_KEYS, *RATE_KEYS)).groupBy("run") \
        .pivot("key", [*MODEL_KEYS, *RATE_KEYS]).agg(F.first("value"))
    return wide.select("run", *[F.col(k).try_cast("long").alias(k) for k in MODEL_KEYS],
                       *[F.col(k).try_cast("double").alias(k) for k in RATE_KEYS])


def lr_audit(merged: DataFrame, values: DataFrame, lr_tag: str) -> DataFrame:
    """Logged and expected learning rate per step of the runs whose config tells the schedule (F1)."""
    known = values.dropna(subset=list(RATE_KEYS)).select("run", *RATE_KEYS)
    expected = lr_schedule(F.col("step"), *[F.col(k) for k in RATE_KEYS])
    return series(merged, lr_tag).join(known, "run").select(
        "run", "step", F.col("value").alias("logged_lr"), expected.alias("expected_lr"),
        F.abs(F.col("value") - expected).alias("abs_diff"))


def n_params(cfg: dict) -> int:
    """Bias-free GPT with tied embeddings, including the position table."""
    V, Tn, L, d, ff = (cfg["vocab_size"], cfg["block_size"], cfg["n_layer"], cfg["n_embd"], cfg["d_ff"])
    return V * d + Tn * d + L * (4 * d * d + 2 * d * ff + 2 * d) + d


def n_params_col(V, Tn, L, d, ff):
    return V * d + Tn * d + L * (4 * d * d + 2 * d * ff + 2 * d) + d


def utilisation(merged: DataFrame, configs: DataFrame, peaks: DataFrame, ms_tag: str, mfu_tag: str,
                val_tag: str, default_peak: float = DEFAULT_PEAK_FLOPS) -> DataFrame:
    """Recomputed utilisation per logged step (F2, F3), falling back to the
    stored series where the config lacks model keys (F4); peaks by run with a
    default (J6); stored vs recomputed upper medians (A19)."""
    c = configs.join(peaks, "run", "left") \
        .withColumn("peak", F.coalesce("peak", F.lit(default_peak)))
    full = F.col("vocab_size").isNotNull() & F.col("block_size").isNotNull() & F.col("n_layer").isNotNull() \
        & F.col("n_head").isNotNull() & F.col("n_embd").isNotNull() & F.col("d_ff").isNotNull() \
        & F.col("tokens_per_iter").isNotNull()
    n = n_params_col(F.col("vocab_size"), F.col("block_size"), F.col("n_layer"), F.col("n_embd"), F.col("d_ff"))
    fpt = 6 * n + 12 * F.col("n_layer") * F.col("n_head") * F.floor(F.col("n_embd") / F.col("n_head")) * F.col("block_size")
    c = c.select("run", F.when(full, n).alias("n_params"), F.when(full, fpt).alias("flops_per_token"),
                 "tokens_per_iter", "peak", full.alias("has_config"))
    ms = series(merged, ms_tag).select("run", "step", F.col("value").alias("ms"))
    rec = ms.join(c, "run").filter("has_config").select(
        "run", "step", (F.col("flops_per_token") * F.col("tokens_per_iter") / (F.col("ms") / 1000) / F.col("peak"))
        .alias("value"))
    stored = series(merged, mfu_tag).select("run", "step", "value")
    # runs without a usable config keep the stored series.
    fallback = stored.join(c.filter(~F.col("has_config")).select("run"), "run", "left_semi")
    recomputed = rec.unionByName(fallback).withColumn("tag", F.lit("recomputed"))
    both = recomputed.unionByName(stored.withColumn("tag", F.lit("stored")))
    evals = series(merged, val_tag).select("run", "step")
    kept = both.join(evals, ["run", "step"], "left_anti").filter(F.col("step") > 0)
    med = upper_median(kept, ["run", "tag"])
    piv = med.groupBy("run").pivot("tag", ["stored", "recomputed"]).agg(F.first("median"))
    return c.join(piv, "run", "left").select(
        "run", "n_params", "flops_per_token",
        F.coalesce("stored", F.lit(0.0)).alias("median_stored"),
        F.coalesce("recomputed", F.lit(0.0)).alias("median_recomputed"),
        (F.abs(F.coalesce("stored", F.lit(0.0)) - F.coalesce("recomputed", F.lit(0.0)))
         > UTILISATION_TOLERANCE).alias("flagged"))



def model_config_rows(configs: dict[str, ModelConfig | None], tokens_per_iter: dict[str, int]):
    rows = []
    for run, cfg in configs.items():
        if cfg is None:
            rows.append((run, None, None, None, None, None, None, tokens_per_iter.get(run)))
        else:
            rows.append((run, cfg.vocab_size, cfg.block_size, cfg.n_layer, cfg.n_head, cfg.n_embd, cfg.d_ff,
                         tokens_per_iter.get(run)))
    return rows
