import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardwright.operators import corpus as K
from shardwright.operators import runlog as R
from shardwright.session import scratch_path
from shardwright.sources.logs import append_scalars
from shardwright.streaming import scalars as SS
from shardwright.streaming import tokenize as ST


def test_stream_restart_matches_batch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    mid = docs.approxQuantile("doc_id", [0.5], 0.0)[0]
    base = scratch_path(spark, "stream-restart")
    src, out, state, ck = (f"{base}/{x}" for x in ("source", "out", "state", "checkpoint"))
    # First run sees only the first half of the corpus, then stops.
    ST.stage_in_order(docs.filter(F.col("doc_id") <= mid), src, 2)
    first = ST.tokenize_stream(spark, src, out, state, ck).count()
    assert 0 < first < docs.count()
    # More files arrive; the restarted query resumes from its checkpoint and
    # the carried state, processing only the new files.
    ST.stage_in_order(docs.filter(F.col("doc_id") > mid), src, 2)
    got = {r.doc_id: (r.tok_start, r.n_tokens) for r in ST.tokenize_stream(spark, src, out, state, ck).collect()}
    ordered = K.order_documents(K.document_meta(docs), 64)
    exp = {r.doc_id: (r.tok_start, r.n_tokens) for r in K.capped_stream(ordered, 0, 64, None).collect()}
    assert got == exp


def test_stream_encodes_and_rolls_the_open_shard(spark):
    base = scratch_path(spark, "stream-roll")
    src, out, state, ck = (f"{base}/{x}" for x in ("source", "out", "state", "checkpoint"))
    texts = ["ab" * (i + 1) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ST.stage_in_order(docs, src, 6)
    rows = ST.tokenize_stream(spark, src, out, state, ck, shard_tokens=40).orderBy("doc_id").collect()
    assert [bytes(r.tokens) for r in rows] == [np.array([*t.encode(), 256], "<u2").tobytes() for t in texts]
    shard, held, want = 0, 0, []
    for i in range(0, 12, 2):  # two documents a file, one file a batch
        if held >= 40:
            shard, held = shard + 1, 0
        held += sum(len(t) + 1 for t in texts[i:i + 2])
        want += [shard, shard]
    assert [r.shard_id for r in rows] == want and shard > 1


def test_unreadable_state_fails(spark):
    base = scratch_path(spark, "stream-broken").removeprefix("file:")
    os.makedirs(f"{base}/state/batch_id=0")
    with open(f"{base}/state/batch_id=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        ST._prior_state(spark, f"{base}/state", 1)
    assert ST._prior_state(spark, f"{base}/none", 1)["tokens"] == 0


def test_appended_scalar_files_give_the_merge_of_all(spark):
    base = scratch_path(spark, "scalar-stream")
    log, out, ck = (f"{base}/{x}" for x in ("log", "merged", "checkpoint"))
    schema = "run string, path string, seq long, tag string, step long, value double, wall_time timestamp"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    parts = [frame([("a", "p2", i, "loss", i % 7, float(i), None) for i in range(30)] + [("b", "p1", 0, "loss", 0, None, None)]),
             frame([("a", "p1", i, "loss", i, -1.0, None) for i in range(20)]),  # earlier path: loses where p2 has the step
             frame([("a", "p3", 0, "loss", 3, 0.5, None), ("c", "p1", 0, "lr", 1, 2.0, None), ("b", "p1", 1, "loss", 0, 9.0, None)])]
    seen, sizes = None, []
    for part in parts:
        append_scalars(part, log)
        seen = part if seen is None else seen.unionByName(part)
        got = SS.merge_new_scalars(spark, log, out, ck)
        want = R.merge_scalars(seen).select("run", "tag", "step", "value", "wall_time")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        sizes.append(spark.read.parquet(out).count())
    assert sizes[2] - sizes[1] == 3  # only the keys that the new files touch
    before = sizes[2]
    assert SS.merge_new_scalars(spark, log, out, ck).count() == got.count()  # nothing new
    assert spark.read.parquet(out).count() == before
