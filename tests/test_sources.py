import datetime as dt

from pyspark.sql import functions as F

from shardwright.operators import chat as C
from shardwright.plans import chat_queries as CQ
from shardwright.session import scratch_path
from shardwright.sources import logs as L
from shardwright.sources import manifest as M


def test_chat_manifest_roundtrip(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    _, shards, counters = C.tokenize_chat(turns, CQ.CHAT_SPEC)
    man = M.chat_manifest(shards, counters, CQ.CHAT_SPEC)
    path = scratch_path(spark, "manifest")
    M.write_manifest(man, path)
    back = M.read_manifest(spark, path, require_chat=True).first()
    assert back.chat and back.max_len == 2048 and back.eot_token == back.im_end == 258
    assert back.splits["train"].tokens + back.splits["val"].tokens == 128_926
    assert sum(s.examples for s in back.splits["train"].shards) == back.splits["train"].examples


def test_scalars_partitioned_by_run(spark):
    t = dt.datetime(2024, 1, 1)
    wide = spark.createDataFrame([(0, t, 3.0, None), (10, t, 2.5, 2.9)], "step long, wall_time timestamp, train double, val double")
    root = scratch_path(spark, "scalars")
    L.append_scalars(L.metrics_to_scalars(wide, "r1", "events.0", ["train", "val"]), root)
    L.append_scalars(L.metrics_to_scalars(wide, "r2", "events.0", ["train"]), root)
    got = L.read_scalars(spark, root, ["r1"])
    assert got.count() == 3 and {r.tag for r in got.collect()} == {"train", "val"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_progress_observation(spark):
    df = spark.createDataFrame([(1, 10), (2, 5)], "doc_id long, n_tokens long")
    obs_df, obs = L.with_progress(df)
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"docs": 2, "tokens": 15}


def test_block_size_warning(spark):
    import pytest
    man = spark.createDataFrame([(2048,)], "max_len long")
    with pytest.warns(UserWarning):
        assert M.warn_if_longer_than_block(man, 1024)
    assert not M.warn_if_longer_than_block(man, 4096)
