import math

import numpy as np
from pyspark.sql import functions as F

from shardwright import jobs
from shardwright.operators import runlog as R
from shardwright.session import scratch_path


def test_parameter_count_golden():
    cfg = dict(vocab_size=50304, block_size=1024, n_layer=8, n_embd=512, d_ff=2048)
    assert R.n_params(cfg) - 1024 * 512 == 50_930_176


def test_utilisation_golden():
    cfg = dict(vocab_size=50304, block_size=1024, n_layer=8, n_embd=512, d_ff=2048)
    n = R.n_params(cfg)
    fpt = 6 * n + 12 * 8 * 8 * (512 // 8) * 1024
    assert round(fpt * 262_144 / 1.86 / 71e12, 3) == 0.713


def test_budget_goldens():
    assert 8_000 * 131_072 == 1_048_576_000 and 20_000 * 262_144 == 5_242_880_000


def test_report_rollup_golden():
    # Published roll-up: n-weighted sources give OVERALL, margin = (4 all - loss)/3 - loss.
    src = {"activitynet": (3243, 3.6615, 3.8216, 0.2134), "wikihow": (6799, 3.2759, 3.2669, -0.0120)}
    n = sum(v[0] for v in src.values())
    loss = sum(v[0] * v[1] for v in src.values()) / n
    allv = sum(v[0] * v[2] for v in src.values()) / n
    assert round(loss, 4) == 3.4004 and round(allv, 4) == 3.4460
    for _, lo, al, mg in src.values():
        assert abs((4 * al - lo) / 3 - lo - mg) < 2e-4


def _scalars(spark, rows):
    return spark.createDataFrame(rows, "run string, path string, seq long, tag string, step long, value double, wall_time timestamp")


def test_last_write_wins_and_medians(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("r", "a", 1, "loss/val", 5, 2.0, t), ("r", "b", 1, "loss/val", 5, 1.5, t),   # later path wins
            ("r", "a", 2, "ms", 0, 100.0, t), ("r", "a", 3, "ms", 5, 50.0, t),
            ("r", "a", 4, "ms", 6, 10.0, t), ("r", "a", 5, "ms", 7, 20.0, t),
            ("r", "a", 6, "ms", 8, 30.0, t), ("r", "a", 7, "ms", 9, 40.0, t)]
    m = R.merge_scalars(_scalars(spark, rows))
    assert m.filter("tag = 'loss/val'").first().value == 1.5
    med = R.steady_medians(m, ["ms"], "loss/val").first().median
    assert med == 30.0   # steps 0 and 5 excluded; [10,20,30,40] -> upper median 30


def test_ema_matches_loop(spark):
    import datetime as dt
    vals = [3.5, 1.0, 0.8, 0.75, 0.9, 0.7] * 20
    rows = [("r", "p", i, "g", i, v, dt.datetime(2024, 1, 1)) for i, v in enumerate(vals)]
    got = [r.ema for r in R.ema(R.merge_scalars(_scalars(spark, rows)), ["g"]).orderBy("step").collect()]
    span = max(2, int(len(vals) * 0.03))
    a = max(0.05, 2.0 / (span + 1))
    acc, exp = None, []
    for v in vals:
        acc = v if acc is None else a * v + (1 - a) * acc
        exp.append(acc)
    assert all(math.isclose(x, y) for x, y in zip(got, exp))


def test_affine_scan_composes_in_order():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 3, 64, 1001):
        m, b = rnd.uniform(-1, 1, n), rnd.normal(size=n)
        sm, sb = R.affine_scan(m, b)
        for x0 in (0.0, 3.5):
            x = x0
            for i in range(n):
                x = m[i] * x + b[i]
                assert abs(sm[i] * x0 + sb[i] - x) < 1e-12


def test_ema_of_a_long_series(spark):
    n = 300_000
    df = spark.range(n).select(F.lit("r").alias("run"), F.lit("g").alias("tag"), F.col("id").alias("step"),
                               F.sin(F.col("id") / 50).alias("value"))
    got = R.ema(df, ["g"]).orderBy("step").toPandas()["ema"].to_numpy()
    acc, a = 0.0, max(0.05, 2 / (int(n * 0.03) + 1))
    for i in range(n):
        v = math.sin(i / 50)
        acc = v if i == 0 else a * v + (1 - a) * acc
        assert abs(got[i] - acc) < 1e-9


def test_ema_blocks_match_loop(spark):
    import datetime as dt
    vals = [float((i * 37) % 11) - 3.5 for i in range(150)]
    rows = [("r", "p", i, "g", 2 * i, v, dt.datetime(2024, 1, 1)) for i, v in enumerate(vals)]
    got = [r.ema for r in R.ema(R.merge_scalars(_scalars(spark, rows)), ["g"], block=7).orderBy("step").collect()]
    a = max(0.05, 2.0 / (max(2, int(len(vals) * 0.03)) + 1))
    acc, exp = None, []
    for v in vals:
        acc = v if acc is None else a * v + (1 - a) * acc
        exp.append(acc)
    assert len(got) == len(exp) and all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(got, exp))


def test_running_min_and_step_times_across_blocks(spark):
    import datetime as dt
    vals = [5.0, 4.0, 4.5, 3.0, 3.5, 2.0, 2.5, 1.0, 6.0]
    steps = [0, 3, 4, 9, 10, 11, 20, 21, 40]
    rows = [("r", "p", i, "v", st, v, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=st * st))
            for i, (st, v) in enumerate(zip(steps, vals))]
    m = R.merge_scalars(_scalars(spark, rows))
    got = [(r.step, r.best, r.improved, r.saved) for r in R.best_so_far(m, "v", block=4).orderBy("step").collect()]
    best, exp = None, []
    for st, v in zip(steps, vals):
        imp = best is None or v < best
        best = v if best is None else min(best, v)
        exp.append((st, best, imp, imp and st > 0))
    assert got == exp
    dts = [r.dt_seconds for r in R.step_times(m, "v", block=4).orderBy("step").collect()]
    assert dts == [None] + [float(b * b - a * a) for a, b in zip(steps, steps[1:])]


def test_upper_median_exact_with_ties_and_small_accuracy(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 101), ("d", 400)):
        for _ in range(n):
            rows.append((g, float(rnd.choice([1, 2, 2, 3, 5, 8, 8, 8, 13]) + (rnd.random() if g == "d" else 0))))
    df = spark.createDataFrame(rows, "g string, value double")
    for acc in (10, 100_000):   # a coarse accuracy forces the fallback path too
        got = {r.g: r.median for r in R.upper_median(df, ["g"], accuracy=acc).collect()}
        for g in "abcd":
            vals = sorted(v for k, v in rows if k == g)
            assert got[g] == vals[len(vals) // 2]
    small = {r.g: r.median for r in R.upper_median(df, ["g"]).collect()}
    assert small == got


def test_summary_of_runs_with_configs(spark):
    """One run with the published configuration and a wrong stored utilisation, one without model keys."""
    from datetime import datetime, timedelta
    model = dict(vocab_size=50304, block_size=1024, n_layer=8, n_head=8, n_embd=512, d_ff=2048, tokens_per_iter=262144)
    rate = dict(learning_rate=6e-4, min_lr=6e-5, warmup_iters=2, lr_decay_iters=10)

    def lr(step):
        if step < 2:
            return 6e-4 * (step + 1) / 3
        return 6e-5 + 0.5 * (1 + math.cos(math.pi * (step - 2) / 8)) * (6e-4 - 6e-5) if step <= 10 else 6e-5

    begin, rows = datetime(2024, 1, 1), []
    for run in ("a", "b", "noval"):
        for step in range(0, 14):
            at = begin + timedelta(seconds=2 * step)
            rows += [(run, "p", 0, "loss/train", step, 3.0, at), (run, "p", 0, "perf/ms_per_iter", step, 1860.0, at),
                     (run, "p", 0, "perf/mfu", step, 0.5, at), (run, "p", 0, "lr", step, lr(step) + (1e-5 if step == 5 else 0), at)]
            if run != "noval" and step % 5 == 0:
                rows.append((run, "p", 0, "loss/val", step, 3.1, at))
    scalars = spark.createDataFrame(rows, "run string, path string, seq long, tag string, step long, value double, wall_time timestamp")
    text = lambda d: "|param|value|\n|---|---|\n" + "\n".join(f"|{k}|{v}|" for k, v in d.items())
    configs = spark.createDataFrame([("a", "p", 0, text({**model, **rate, "note": "x"})), ("b", "p", 0, text({"n_layer": "many"}))],
                                    "run string, path string, seq long, text string")
    out = scratch_path(spark, "runs-summary")
    table = jobs.summarize_runs(spark, scalars, out, configs=configs, peaks=spark.createDataFrame([("a", 71e12)], "run string, peak double"))
    assert {r.run for r in table.collect()} == {"a", "b"}
    u = {r.run: r for r in spark.read.parquet(f"{out}-utilisation").collect()}
    assert round(u["a"].median_recomputed, 3) == 0.713 and u["a"].median_stored == 0.5 and u["a"].flagged
    assert (u["b"].median_recomputed, u["b"].flagged, set(u)) == (0.5, False, {"a", "b"})
    audit = {r.step: r for r in spark.read.parquet(f"{out}-lr").collect()}
    assert len(audit) == 14 and all(abs(audit[s].expected_lr - lr(s)) < 1e-12 for s in audit)
    assert [s for s in audit if audit[s].abs_diff > 1e-9] == [5]
    times = spark.read.parquet(f"{out}-step-times").filter("run = 'a' and step > 0").collect()
    assert len(times) == 13 and all(r.dt_seconds == 2.0 for r in times)
