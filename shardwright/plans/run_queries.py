"""Run-metric queries over the events table read as a scalar log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import runlog as R
from ..schemas import ModelConfig
from .registry import query, table

# Stand-in tags: which event_type plays which scalar of a training run.
TRAIN_TAG = "view"        # loss/train
VAL_TAG = "click"         # loss/val
LR_TAG = "signup"         # lr
MS_TAG = "purchase"       # perf/ms_per_iter
MFU_TAG = "error"         # perf/mfu
LOG_EVERY = 5
# Learning-rate audit parameters (warm-up and decay inside the fixture's steps).
LR, MIN_LR, WARMUP, DECAY = 6e-4, 6e-5, 50, 600
# Per-run model configs and peaks for the utilisation query; run "2" has no
# model keys, so its stored series is used.
CONFIGS = {"0": ModelConfig(vocab_size=50304, block_size=1024),
           "1": ModelConfig(vocab_size=50304, block_size=1024, n_layer=12, n_head=12, n_embd=768, d_ff=3072),
           "2": None}
TOKENS_PER_ITER = {"0": 262144, "1": 131072, "2": 262144}
PEAKS = {"1": 362.05e12}


def _scalars(spark, sf):
    return R.scalars_from_events(table(spark, sf, "events"))


def _merged(spark, sf):
    return R.merge_scalars(_scalars(spark, sf))


_SC = """
sc AS (SELECT CAST(user_id % 3 AS VARCHAR) AS run, CAST(user_id % 7 AS VARCHAR) AS path, event_id AS seq,
              event_type AS tag,
              CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 3600000000) AS BIGINT) AS step,
              value, ts AS wall_time, props, user_id FROM events),
m AS (SELECT run, tag, step, value, wall_time FROM (
        SELECT *, row_number() OVER (PARTITION BY run, tag, step ORDER BY path DESC, seq DESC) AS rn FROM sc)
      WHERE rn = 1)"""


def _upper_median_sql(src: str) -> str:
    return f"""(SELECT run, tag, value AS median FROM (
        SELECT run, tag, value, row_number() OVER (PARTITION BY run, tag ORDER BY value) AS rn,
               count(*) OVER (PARTITION BY run, tag) AS n FROM {src}) WHERE rn = n // 2 + 1)"""


@query("scalar_merge", f"WITH {_SC} SELECT run, tag, step, value FROM m")
def scalar_merge(spark, sf):
    return _merged(spark, sf).select("run", "tag", "step", "value")


@query("loss_table", f"""
WITH {_SC}
SELECT tr.run, tr.step AS iter, printf('%.4f', tr.value) AS train_loss, printf('%.4f', va.value) AS val_loss,
       printf('%.4f', va.value - tr.value) AS gap
FROM m tr JOIN m va ON tr.run = va.run AND tr.step = va.step AND tr.tag = '{TRAIN_TAG}' AND va.tag = '{VAL_TAG}'""")
def loss_table(spark, sf):
    return R.loss_table(_merged(spark, sf), TRAIN_TAG, VAL_TAG)


@query("best_so_far", f"""
WITH {_SC}, s AS (SELECT run, step, value, min(value) OVER (PARTITION BY run ORDER BY step
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM m WHERE tag = '{VAL_TAG}')
SELECT run, step, value, least(value, coalesce(prev_best, value)) AS best,
       prev_best IS NULL OR value < prev_best AS improved,
       (prev_best IS NULL OR value < prev_best) AND step > 0 AS saved
FROM s""")
def best_so_far(spark, sf):
    return R.best_so_far(_merged(spark, sf), VAL_TAG)


@query("final_values", f"""
WITH {_SC},
per AS (SELECT run, tag, max(step) AS final_step, arg_max(value, step) AS final_value, min(value) AS min_value,
               max(value) AS max_value, count(*) AS n_points FROM m GROUP BY run, tag),
runs AS (SELECT run, count(DISTINCT tag) AS n_tags, count_if(tag = '{VAL_TAG}') AS n_evals FROM m GROUP BY run)
SELECT * FROM per JOIN runs USING (run)""")
def final_values(spark, sf):
    return R.final_values(_merged(spark, sf), VAL_TAG)


@query("eval_means", f"""
WITH {_SC}
SELECT run, step, CASE tag WHEN '{TRAIN_TAG}' THEN 'train' ELSE 'val' END AS split,
       round(avg(value), 6) AS mean_loss, count(*) AS n_batches, step % {LOG_EVERY} = 0 AS logged
FROM sc WHERE tag IN ('{TRAIN_TAG}', '{VAL_TAG}') GROUP BY run, step, tag""")
def eval_means(spark, sf):
    return R.eval_means(_scalars(spark, sf), {"train": TRAIN_TAG, "val": VAL_TAG}, LOG_EVERY)


@query("upper_median", f"""
WITH {_SC},
perf AS (SELECT * FROM m WHERE tag IN ('{MS_TAG}', '{MFU_TAG}')),
kept AS (SELECT * FROM perf p WHERE step > 0 AND NOT EXISTS (
           SELECT 1 FROM m e WHERE e.tag = '{VAL_TAG}' AND e.run = p.run AND e.step = p.step)),
med AS {_upper_median_sql("kept")}
SELECT k.run, k.tag, coalesce(med.median, 0.0) AS median
FROM (SELECT DISTINCT run, tag FROM perf) k LEFT JOIN med USING (run, tag)""")
def upper_median(spark, sf):
    return R.steady_medians(_merged(spark, sf), [MS_TAG, MFU_TAG], VAL_TAG)


@query("ema_series", f"""
WITH RECURSIVE {_SC},
s AS (SELECT run, tag, step, value, row_number() OVER (PARTITION BY run, tag ORDER BY step) AS i,
             count(*) OVER (PARTITION BY run, tag) AS n FROM m WHERE tag IN ('{MS_TAG}', '{MFU_TAG}')),
p AS (SELECT DISTINCT run, tag, greatest(0.05, 2.0 / (greatest(2, CAST(floor(n * 0.03) AS BIGINT)) + 1)) AS alpha FROM s),
e AS (SELECT run, tag, step, i, value AS ema FROM s WHERE i = 1
      UNION ALL
      SELECT s.run, s.tag, s.step, s.i, p.alpha * s.value + (1 - p.alpha) * e.ema
      FROM e JOIN s ON s.run = e.run AND s.tag = e.tag AND s.i = e.i + 1
             JOIN p ON p.run = s.run AND p.tag = s.tag)
SELECT run, tag, step, round(ema, 6) AS ema FROM e""")
def ema_series(spark, sf):
    e = R.ema(_merged(spark, sf), [MS_TAG, MFU_TAG])
    return e.select("run", "tag", "step", F.round("ema", 6).alias("ema"))


@query("step_times", f"""
WITH {_SC}
SELECT run, step, round((epoch_us(wall_time) - lag(epoch_us(wall_time)) OVER (PARTITION BY run ORDER BY step)) / 1e6, 6)
       AS dt_seconds
FROM m WHERE tag = '{MS_TAG}'""")
def step_times(spark, sf):
    s = R.step_times(_merged(spark, sf), MS_TAG)
    return s.select("run", "step", F.round("dt_seconds", 6).alias("dt_seconds"))


@query("run_config", f"""
WITH {_SC},
kv AS (
  SELECT run, path, seq, 2 AS line, 'k' AS key, json_extract_string(props, '$.k') AS value FROM sc
  UNION ALL SELECT run, path, seq, 3, 'event', tag FROM sc
  UNION ALL SELECT run, path, seq, 4, 'user', CAST(user_id AS VARCHAR) FROM sc
  UNION ALL SELECT run, path, seq, 5, 'init_from', 'ckpt-' || CAST(user_id AS VARCHAR) FROM sc WHERE tag = 'signup'),
conf AS (SELECT run, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run, key ORDER BY path DESC, seq DESC, line DESC) AS rn FROM kv) WHERE rn = 1),
sft AS (SELECT run, bool_or(key = 'init_from') AS is_sft FROM conf GROUP BY run),
hv AS (SELECT DISTINCT run, true AS has_val FROM m WHERE tag = '{VAL_TAG}')
SELECT conf.run, key, value, is_sft, coalesce(has_val, false) AS has_val
FROM conf JOIN sft USING (run) LEFT JOIN hv USING (run)""")
def run_config(spark, sf):
    sc = _scalars(spark, sf)
    conf = R.parse_config(R.config_text(sc))
    maps = conf.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("conf"))
    sft = maps.select("run", F.map_contains_key("conf", "init_from").alias("is_sft"))
    hv = R.merge_scalars(sc).filter(F.col("tag") == VAL_TAG).select("run").distinct() \
        .withColumn("has_val", F.lit(True))
    return conf.join(sft, "run").join(hv, "run", "left") \
        .select("run", "key", "value", "is_sft", F.coalesce("has_val", F.lit(False)).alias("has_val"))


@query("lr_audit", f"""
WITH {_SC}, s AS (SELECT run, step, value FROM m WHERE tag = '{LR_TAG}'),
x AS (SELECT run, step, value,
        CASE WHEN step < {WARMUP} THEN {LR} * (step + 1) / {WARMUP + 1}
             WHEN step > {DECAY} THEN {MIN_LR}
             ELSE {MIN_LR} + 0.5 * (1.0 + cos(pi() * ((step - {WARMUP}) / {DECAY - WARMUP}))) * ({LR} - {MIN_LR}) END AS lr
      FROM s)
SELECT run, step, round(lr, 10) AS expected_lr, round(abs(value - lr), 10) AS abs_diff,
       round(max(abs(value - lr)) OVER (PARTITION BY run), 10) AS max_abs_diff FROM x""")
def lr_audit(spark, sf):
    s = R.series(_merged(spark, sf), LR_TAG)
    lr = R.lr_schedule(F.col("step"), LR, MIN_LR, WARMUP, DECAY)
    x = s.withColumn("lr", lr).withColumn("d", F.abs(F.col("value") - F.col("lr")))
    worst = x.groupBy("run").agg(F.round(F.max("d"), 10).alias("max_abs_diff"))
    return x.join(worst, "run").select("run", "step", F.round("lr", 10).alias("expected_lr"),
                                       F.round("d", 10).alias("abs_diff"), "max_abs_diff")


def _config_values_sql() -> str:
    rows = []
    for run, cfg in CONFIGS.items():
        tpi = TOKENS_PER_ITER[run]
        if cfg is None:
            rows.append(f"('{run}', NULL, NULL, NULL, NULL, NULL, NULL, {tpi})")
        else:
            rows.append(f"('{run}', {cfg.vocab_size}, {cfg.block_size}, {cfg.n_layer}, {cfg.n_head}, "
                        f"{cfg.n_embd}, {cfg.d_ff}, {tpi})")
    return ", ".join(rows)


_UTIL_SQL = f"""
WITH {_SC},
cfg0(run, vocab_size, block_size, n_layer, n_head, n_embd, d_ff, tokens_per_iter) AS (VALUES {_config_values_sql()}),
pk(run, peak) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in PEAKS.items())}),
cfg AS (SELECT c.*, coalesce(pk.peak, 71e12) AS peak,
          vocab_size IS NOT NULL AND tokens_per_iter IS NOT NULL AS has_config,
          CAST(vocab_size * n_embd + block_size * n_embd + n_layer * (4 * n_embd * n_embd + 2 * n_embd * d_ff + 2 * n_embd) + n_embd AS BIGINT) AS n_params
        FROM cfg0 c LEFT JOIN pk USING (run)),
cfg2 AS (SELECT *, CAST(6 * n_params + 12 * n_layer * n_head * (n_embd // n_head) * block_size AS BIGINT) AS flops_per_token FROM cfg),
rec AS (SELECT m.run, m.step, c.flops_per_token * c.tokens_per_iter / (m.value / 1000) / c.peak AS value
        FROM m JOIN cfg2 c ON m.run = c.run WHERE m.tag = '{MS_TAG}' AND c.has_config
        UNION ALL
        SELECT m.run, m.step, m.value FROM m JOIN cfg2 c ON m.run = c.run WHERE m.tag = '{MFU_TAG}' AND NOT c.has_config),
both_ AS (SELECT run, step, value, 'recomputed' AS tag FROM rec
          UNION ALL SELECT run, step, value, 'stored' FROM m WHERE tag = '{MFU_TAG}'),
kept AS (SELECT * FROM both_ b WHERE step > 0 AND NOT EXISTS (
           SELECT 1 FROM m e WHERE e.tag = '{VAL_TAG}' AND e.run = b.run AND e.step = b.step)),
med AS {_upper_median_sql("kept")},
piv AS (SELECT run, max(CASE WHEN tag = 'stored' THEN median END) AS stored,
               max(CASE WHEN tag = 'recomputed' THEN median END) AS recomputed FROM med GROUP BY run)
SELECT c.run, CASE WHEN has_config THEN n_params END AS n_params,
       CASE WHEN has_config THEN flops_per_token END AS flops_per_token,
       round(coalesce(stored, 0.0), 6) AS median_stored, round(coalesce(recomputed, 0.0), 6) AS median_recomputed,
       abs(coalesce(stored, 0.0) - coalesce(recomputed, 0.0)) > 0.02 AS flagged
FROM cfg2 c LEFT JOIN piv USING (run)"""


@query("utilisation", _UTIL_SQL)
def utilisation(spark, sf):
    schema = T.StructType([T.StructField("run", T.StringType())] + [
        T.StructField(c, T.LongType()) for c in
        ("vocab_size", "block_size", "n_layer", "n_head", "n_embd", "d_ff", "tokens_per_iter")])
    configs = spark.createDataFrame(R.model_config_rows(CONFIGS, TOKENS_PER_ITER), schema)
    peaks = spark.createDataFrame(list(PEAKS.items()), "run string, peak double")
    u = R.utilisation(_merged(spark, sf), configs, peaks, MS_TAG, MFU_TAG, VAL_TAG)
    return u.select("run", F.col("n_params").cast("long"), F.col("flops_per_token").cast("long"),
                    F.round("median_stored", 6).alias("median_stored"),
                    F.round("median_recomputed", 6).alias("median_recomputed"), "flagged")
