import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shardwright.llm import hard_negatives as hn

from .helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int, row int, score double, block int, anchor string"


def brute(data, positives=5, negatives=3, low=50, high=95):
    """Every pair of usable rows; repeated rows of an anchor are one anchor."""
    use = []
    for i, v, lab in data:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        code = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        use.append((i, (lab + 1) % 10 if i % 7 == 0 else lab, code))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, lab, code in sorted({u for u in use if u[0] % 50 == 0}):
        others = [(dot(code, c), j, m) for j, m, c in use if j != i and len(c) == len(code)]
        first = sorted((-s, j) for s, j, m in others if m == lab)[:positives]
        for s, j in first:
            s = -s
            ok = sorted((-t, k) for t, k, m in others if m != lab and low * s <= 100 * t <= high * s)[:negatives]
            out += [(i, j, r, k, s, -t) for r, (t, k) in enumerate(ok, 1)]
    return sorted(out)


def mined(spark, data, **how):
    df = spark.createDataFrame([(i, v, lab, 1, 2.0, 3, "x") for i, v, lab in data], SCHEMA)
    got = hn.mine(df, F.col("vec_id") % 50 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(seed, n, dim=6, spread=0.15):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dim))
    x = centres[r.integers(0, 8, n)] + spread * r.normal(size=(n, dim))
    return [(k, (x[k] * r.choice([0.5, 1.0, 2.0])).tolist(), int(r.integers(0, 4))) for k in range(n)]


def test_equals_brute_force_in_small_blocks(spark):
    data = clustered(1, 400)
    for block in (7, 4096):
        assert mined(spark, data, block=block) == brute(data)


def test_edge_rows(spark):
    r = random.Random(4)
    vec = lambda: [r.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]
    data = [(k, vec(), r.randint(0, 2)) for k in range(0, 160)]
    same = [0.5, 0.5, 0.0, 1.0]
    data += [(200 + k, same, k % 3) for k in range(40)]                       # ties
    data += [(50, same, 1), (50, same, 1), (100, vec(), 0), (201, same, 1)]     # repeated rows, one id with two vectors
    data += [(None, same, 1), (250, None, 1), (251, same, None), (300, [1.0, None, 0.0, 1.0], 1), (350, [float("nan"), 0.0, 1.0, 1.0], 1),
             (400, [float("inf"), 0.0, 0.0, 1.0], 1), (450, [], 1), (500, [0.0] * 4, 2), (550, [1.0, 1.0], 2), (551, [1.0, 0.5], 2),
             (552, [0.7, 0.5], 1), (600, [1e4, -2e4, 3e4, 1e4], 0), (601, [1e4, -2e4, 3e4, 1.1e4], 0), (602, [1e4, -1e4, 2e4, 1e4], 1),
             (650, [-1e-9, 1e-9, 0.0, 0.0], 1), (-50, same, 2), (-49, same, 2)]
    for block in (5, 4096):
        assert mined(spark, data, block=block) == brute([d for d in data])


def test_exact_beyond_doubles(spark):
    big = 2.0 ** 20
    data = [(0, [big, big, 3.0], 1), (1, [big, big, 5.0], 1), (2, [big, big / 2, 1.0], 2), (3, [big, big / 2, 0.996], 2), (50, [1.0, big, 0.0], 1)]
    assert mined(spark, data) == brute(data)


def test_ranges_prune_and_never_lose():
    data = clustered(9, 3000, spread=0.05)
    table = pa.table({"vec_id": [d[0] for d in data], "label": [d[2] for d in data],
                      "code": [[math.floor(256 * x) for x in d[1]] for d in data]})
    block, kept = hn.Block(table), 0
    for i in range(0, 200):
        code = block.codes[i]
        length = float(np.sqrt((code.astype(float) ** 2).sum()))
        scores = block.scores(code[None])[0]
        least = float(np.sort(scores)[-20])
        mask = block.candidates(code / length, length, least)
        assert mask is not None and mask[scores >= least].all()
        kept += np.count_nonzero(mask) / len(mask)
    assert kept / 200 < 0.3


def test_buckets_out_of_reach_are_passed_over():
    block = hn.Block(pa.table({"vec_id": [1, 2], "label": [1, 1], "code": [[3, 4], [0, 5]]}))
    assert not block.candidates(np.array([1.0, 0.0]), 10.0, 51.0).any()
    assert block.candidates(np.array([1.0, 0.0]), 10.0, 30.0)[0]


def test_empty_table_and_no_partners(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]) == []


def test_query_on_the_table(spark):
    from shardwright.llm.queries import QUERIES
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    got = sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"])
                 for r in rows(QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001")))
    assert got == brute([(r["vec_id"], r["embedding"], r["label"]) for r in table])
