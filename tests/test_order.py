import random

from pyspark.sql import functions as F

from shardwright.operators.order import ordinal, prefix_sum, reset_segments


def brute(sizes, S):
    seg, cur, out = 0, 0, []
    for s in sizes:
        out.append(seg)
        cur += s
        if cur >= S:
            seg, cur = seg + 1, 0
    return out


def _case(spark, seed, fn):
    rnd = random.Random(seed)
    n = rnd.randint(1, 120)
    S = rnd.choice([5, 60, 400])
    sizes = [rnd.choice([1, 3, 10, 40, 120, 700]) for _ in range(n)]
    keys = rnd.sample(range(10 ** 6), n)
    df = spark.createDataFrame([(k, s) for k, s in zip(keys, sizes)], "k long, sz long")
    o = ordinal(df, "k")
    got = {r["k"]: (r["ord"], r["seg"], r["__end"]) for r in fn(o, "ord", "sz", S).collect()}
    starts = {r.k: r.start for r in prefix_sum(o, "ord", "sz").collect()}
    order = sorted(range(n), key=lambda i: keys[i])
    exp = brute([sizes[i] for i in order], S)
    cum = 0
    for j, i in enumerate(order):
        assert starts[keys[i]] == cum
        cum += sizes[i]
        assert got[keys[i]][:2] == (j, exp[j])
        assert got[keys[i]][2] == cum


def test_reset_segments(spark):
    # Includes units larger than S, which are always segment ends.
    for seed in (0, 1, 2, 11):
        _case(spark, seed, reset_segments)


def test_reset_segments_over_many_small_blocks(spark):
    """Blocks shorter and longer than a segment, skipped blocks and several levels of composition."""
    for seed, block, fan in ((3, 1, 2), (4, 5, 2), (7, 7, 3), (11, 40, 2)):
        _case(spark, seed, lambda *a: reset_segments(*a, block=block, fan=fan))


def test_reset_segments_of_equal_sizes(spark):
    """Chains that never meet: the step functions keep a step per unit."""
    df = spark.range(300).select(F.col("id").alias("ord"), F.lit(1).cast("long").alias("sz"))
    got = reset_segments(df, "ord", "sz", 7, block=10, fan=3).collect()
    assert {r.ord: r.seg for r in got} == {i: i // 7 for i in range(300)}


def test_reset_segments_does_the_same_steps_for_any_number_of_segments(spark, monkeypatch):
    """No joins per segment: checkpoints and their shuffles depend on the units alone."""
    kind, seen = type(spark.range(1)), []

    def look(self, *a, f=kind.checkpoint, **k):
        plan = self._jdf.queryExecution().executedPlan().toString()
        seen.append((plan.count("Join"), plan.count("Exchange")))
        return f(self, *a, **k)

    df = spark.range(5000).select(F.col("id").alias("ord"), (F.col("id") % 9 + 1).alias("sz"))
    steps = []
    for target in (3, 40, 10 ** 6):
        with monkeypatch.context() as m:
            m.setattr(kind, "checkpoint", look)
            seen.clear()
            rows = reset_segments(df, "ord", "sz", target).collect()
            steps.append(list(seen))
        assert [r.seg for r in sorted(rows, key=lambda r: r.ord)] == brute([i % 9 + 1 for i in range(5000)], target)
    assert steps[0] == steps[1] == steps[2] and len(steps[0]) <= 3


def test_ordinal_of_many_partitions_large_ids_and_strings(spark):
    keys = [2 ** 60 + 3 * i for i in range(50)] + [2 ** 53 + 1, 2 ** 53, -7]
    o = ordinal(spark.createDataFrame([(k,) for k in keys], "k long"), "k", rows_per_bucket=4)
    assert {r.k: r.ord for r in o.collect()} == {k: i for i, k in enumerate(sorted(keys))}
    s = ordinal(spark.createDataFrame([(str(k),) for k in keys], "k string"), "k", rows_per_bucket=9)
    assert {r.k: r.ord for r in s.collect()} == {k: i for i, k in enumerate(sorted(map(str, keys)))}
    assert ordinal(spark.createDataFrame([], "k long"), "k").count() == 0


def test_ordinal_is_dense_and_permutation_invariant(spark):
    keys = [5, 17, 2, 99, 40, 41, 1000]
    a = spark.createDataFrame([(k,) for k in keys], "k long")
    b = spark.createDataFrame([(k,) for k in reversed(keys)], "k long").repartition(3)
    ra = {r.k: r.ord for r in ordinal(a, "k").collect()}
    rb = {r.k: r.ord for r in ordinal(b, "k").collect()}
    assert ra == rb == {k: i for i, k in enumerate(sorted(keys))}


def test_reset_segments_per_split(spark):
    rnd = random.Random(5)
    S = 80
    rows, exp = [], {}
    for split in ("train", "val"):
        sizes = [rnd.choice([1, 7, 30, 90, 200]) for _ in range(60)]
        keys = rnd.sample(range(10 ** 6), len(sizes))
        order = sorted(range(len(sizes)), key=lambda i: keys[i])
        segs = brute([sizes[i] for i in order], S)
        for j, i in enumerate(order):
            rows.append((split, keys[i], sizes[i]))
            exp[(split, keys[i])] = segs[j]
    df = ordinal(spark.createDataFrame(rows, "split string, k long, sz long"), "k", part_cols=["split"])
    got = {(r["split"], r["k"]): r["seg"] for r in reset_segments(df, "ord", "sz", S, part_cols=["split"]).collect()}
    assert got == exp
