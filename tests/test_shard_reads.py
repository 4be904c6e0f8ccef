"""Reads of shard files: windows by draws, pushed filters, id widths."""
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from shardwright import jobs
from shardwright.operators import windows as W
from shardwright.schemas import IGNORE_INDEX, SEED
from shardwright.session import scratch_path
from shardwright.sources import token_shards as TS
from shardwright.sources import windows as SW


def corpus(spark, shards, dtype="uint16", convs=None, chat=False, max_len=None):
    """A folder of shard files and its manifest; ``convs``: starts of conversations by shard."""
    out = scratch_path(spark, "shards").removeprefix("file:")
    os.makedirs(f"{out}/bin")
    os.makedirs(f"{out}/manifest")
    entries = []
    for i, ids in enumerate(shards):
        np.array(ids, dtype).tofile(f"{out}/bin/train_{i:06d}.bin")
        entries.append({"file": f"train_{i:06d}.bin", "tokens": len(ids)})
        if chat:
            (np.array(ids) % 3 == 0).astype(np.uint8).tofile(f"{out}/bin/train_{i:06d}.mask.bin")
            np.array(convs[i], "<u8").tofile(f"{out}/bin/train_{i:06d}.idx.bin")
            entries[-1]["examples"] = len(convs[i])
    with open(f"{out}/manifest/part-00000.txt", "w") as f:
        json.dump({"dtype": dtype, "chat": chat or None, "max_len": max_len, "splits": {"train": {"shards": entries}}}, f)
    return out


def windows(spark, out, *how, **more):
    return sorted(jobs.sample_windows(spark, f"{out}/bin", *how, **more).collect(), key=lambda r: (r.step, r.micro, r.row))


def picked(spark, shards, steps, accum, batch):
    """The draws by the join of the operators, for comparison."""
    table = spark.createDataFrame([("train", i, len(s)) for i, s in enumerate(shards)], "split string, shard_id int, tokens long")
    return W.pick_shards(W.draws(spark, steps, accum, batch), W.shard_weights(table), "train", SEED, min(map(len, shards)))


def test_text_windows_of_wide_ids_are_those_of_the_operators(spark):
    r = np.random.default_rng(1)
    shards = [r.integers(60_000, 90_000, n).tolist() for n in (5000, 3000, 4000)]
    out = corpus(spark, shards, "uint32")
    got = windows(spark, out, 16, 5, 2, 7)
    want = sorted(W.text_starts(picked(spark, shards, 5, 2, 7), 16, SEED).collect(), key=lambda r: (r.step, r.micro, r.row))
    assert [(g.step, g.micro, g.row, g.shard_id, g.start) for g in got] == [(w.step, w.micro, w.row, w.shard_id, w.start) for w in want]
    for g in got:
        s = shards[g.shard_id]
        assert (g.x, g.y) == (s[g.start:g.start + 16], s[g.start + 1:g.start + 17])
        assert g.tokens_seen == (g.step + 1) * 2 * 7 * 16


def test_a_last_shard_of_seven_tokens_changes_nothing(spark):
    ids = (np.arange(1_000_000) % 50_000).tolist()
    out, more = corpus(spark, [ids]), corpus(spark, [ids, [1] * 7])
    rows = W.draws(spark, 3, 1, 4).count()
    shards = SW.Shards({"splits": {"train": {"shards": [{"file": "train_000000.bin", "tokens": 10_000_000, "examples": None},
                                                       {"file": "train_000001.bin", "tokens": 7, "examples": None}]}},
                        "chat": None, "dtype": "uint16"}, "train", "x")
    assert len(shards.before) == 3 and shards.holding(np.array([0, 9_999_999, 10_000_000, 10_000_006])).tolist() == [0, 0, 1, 1]
    a, b = windows(spark, out, 32, 3, 1, 4), windows(spark, more, 32, 3, 1, 4)
    assert len(a) == len(b) == rows
    # One token in 142,858 more: no draw of these falls on another place by more than that.
    assert all(abs(p.start - q.start) < 10 and q.shard_id == 0 for p, q in zip(a, b))


def test_empty_shards_hold_no_draw():
    shards = SW.Shards({"splits": {"train": {"shards": [{"file": f"train_{i:06d}.bin", "tokens": n, "examples": None}
                                                       for i, n in enumerate([0, 5, 0, 0, 4, 0])]}}, "chat": None, "dtype": "uint16"}, "train", "x")
    assert shards.holding(np.arange(9)).tolist() == [1] * 5 + [4] * 4


def test_chat_windows_begin_with_conversations(spark):
    r = np.random.default_rng(2)
    shards = [r.integers(0, 300, n).tolist() for n in (900, 400)]
    convs = [sorted(r.choice(n, 40, replace=False).tolist()) for n in (900, 400)]
    out = corpus(spark, shards, convs=convs, chat=True, max_len=64)
    with pytest.warns(UserWarning):
        got = windows(spark, out, 20, 6, 2, 5)
    sh = spark.createDataFrame([("train", i, len(s)) for i, s in enumerate(shards)], "split string, shard_id int, tokens long")
    cv = spark.createDataFrame([("train", i, c) for i, cs in enumerate(convs) for c in cs], "split string, shard_id int, shard_start long")
    want = W.chat_starts(picked(spark, shards, 6, 2, 5), *W.valid_chat_starts(cv, sh, 20), SEED)
    want = sorted((w.step, w.micro, w.row, w.shard_id, w.start) for w in want.collect())
    assert [(g.step, g.micro, g.row, g.shard_id, g.start) for g in got] == want
    for g in got:
        s = shards[g.shard_id][g.start:g.start + 21]
        assert g.x == s[:20] and g.y == [t if t % 3 == 0 else IGNORE_INDEX for t in s[1:]]


def test_bisection_of_the_index(tmp_path, monkeypatch):
    starts = np.sort(np.random.default_rng(3).integers(0, 10 ** 6, 5000))
    starts.astype("<u8").tofile(tmp_path / "t.idx.bin")
    monkeypatch.setattr(SW, "INDEX_BLOCK", 8)
    for tokens in (0, 21, 500_000, 10 ** 6, 10 ** 7):
        assert SW.valid_starts(str(tmp_path / "t"), tokens, 5000, 20) == int((starts <= tokens - 21).sum())


def test_bytes_read_follow_the_draws(tmp_path, monkeypatch):
    ids = (np.arange(2_000_000) % 60_000).astype("<u2")
    ids.tofile(tmp_path / "t.bin")
    read = []
    real = SW.read_at
    monkeypatch.setattr(SW, "read_at", lambda p, d, a, b: read.append((a, b)) or real(p, d, a, b))
    starts = np.array([5, 5, 40, 900_000, 900_010, 1_999_900])
    got = np.concatenate([x for _, _, x in SW._taken(str(tmp_path / "t.bin"), "<u2", starts, 33)])
    assert (got == ids[starts[:, None] + np.arange(33)]).all()
    assert read == [(5, 73), (900_000, 900_043), (1_999_900, 1_999_933)]  # windows that overlap are read once


def test_a_shard_without_a_window_fails(spark):
    with pytest.raises(Exception, match="fewer than block_size"):
        windows(spark, corpus(spark, [[1] * 10]), 20, 1, 1, 1)
    with pytest.raises(Exception, match="fewer than block_size"):
        windows(spark, corpus(spark, [[1] * 30], convs=[[25]], chat=True), 20, 1, 1, 1)
    assert windows(spark, corpus(spark, [[1] * 30]), 20, 1, 1, 1, split="val") == []


def test_id_width_is_the_manifests(spark):
    TS.register(spark)
    out = corpus(spark, [[70_000, 1, 70_001]], "uint32")
    read = spark.read.format("token_shard")
    assert read.load(f"{out}/bin").first().tokens == [70_000, 1, 70_001]
    with pytest.raises(Exception, match="says uint32"):
        read.option("dtype", "uint16").load(f"{out}/bin").collect()
    bare = scratch_path(spark, "bare").removeprefix("file:")
    os.makedirs(f"{bare}/bin")
    np.array([1, 2], "<u2").tofile(f"{bare}/bin/train_000000.bin")
    with pytest.raises(Exception, match="option dtype"):
        spark.read.format("token_shard").load(f"{bare}/bin").collect()
    assert spark.read.format("token_shard").option("dtype", "uint16").load(f"{bare}/bin").first().tokens == [1, 2]


COLUMNS = ["split", "shard_id", "example", "shard_start", "tokens", "mask"]


def rows_and_bytes(out, filters, columns, monkeypatch, chunk=100):
    read = []
    real = TS.read_at
    with monkeypatch.context() as m:
        m.setattr(TS, "read_at", lambda p, d, a, b: (x := real(p, d, a, b), read.append((os.path.basename(p), x.nbytes)))[0])
        reader = TS.PushingReader(f"{out}/bin", "uint16", chunk, columns)
        left = list(reader.pushFilters(filters))
        rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    return rows, read, left


def test_pushed_filters_choose_files_and_ranges(spark, monkeypatch):
    out = corpus(spark, [list(range(1000)), list(range(5000, 5950)), list(range(50))])
    all_rows, _, _ = rows_and_bytes(out, [], COLUMNS, monkeypatch)
    assert len(all_rows) == 10 + 10 + 1
    cases = [([EqualTo(("shard_id",), 1)], lambda r: r["shard_id"] == 1, 1900),
             ([In(("shard_id",), (0, 2)), GreaterThanOrEqual(("shard_start",), 250)], lambda r: r["shard_id"] != 1 and r["shard_start"] >= 250, 1400),
             ([EqualTo(("shard_id",), 0), GreaterThan(("shard_start",), 300), LessThan(("shard_start",), 500)],
              lambda r: r["shard_id"] == 0 and 300 < r["shard_start"] < 500, 200),
             ([EqualTo(("shard_id",), 0), EqualTo(("example",), 3)], lambda r: r["shard_id"] == 0 and r["example"] == 3, 200),
             ([LessThanOrEqual(("shard_start",), 0), LessThan(("shard_id",), 2)], lambda r: r["shard_start"] <= 0 and r["shard_id"] < 2, 400),
             ([EqualTo(("shard_start",), 150)], lambda r: False, 0),
             ([EqualTo(("split",), "val")], lambda r: False, 0)]
    for filters, test, size in cases:
        rows, read, left = rows_and_bytes(out, filters, COLUMNS, monkeypatch)
        assert rows == [r for r in all_rows if test(r)] and sum(n for _, n in read) == size, filters
        assert all(f.attribute[0] not in ("split", "shard_id") for f in left)


def test_columns_that_are_not_asked_for_are_not_read(spark, monkeypatch):
    out = corpus(spark, [list(range(300))], convs=[[0, 100, 250]], chat=True)
    rows, read, _ = rows_and_bytes(out, [GreaterThanOrEqual(("example",), 1)], ["example", "tokens"], monkeypatch)
    assert [len(r["tokens"]) for r in rows] == [150, 50] and {f for f, _ in read} == {"train_000000.bin", "train_000000.idx.bin"}
    rows, read, _ = rows_and_bytes(out, [], ["shard_start"], monkeypatch)
    assert [r["shard_start"] for r in rows] == [0, 100, 250] and {f for f, _ in read} == {"train_000000.idx.bin"}
    TS.register(spark)
    some = spark.read.format("token_shard").schema("example int, mask array<int>").load(f"{out}/bin")
    assert some.columns == ["example", "mask"] and [len(r["mask"]) for r in some.orderBy("example").collect()] == [100, 150, 50]


def test_pushdown_in_the_plan(spark, capsys):
    TS.register(spark)
    out = corpus(spark, [list(range(1000)), list(range(500))])
    df = spark.read.format("token_shard").option("chunk", 100).load(f"{out}/bin").where("split = 'train' AND shard_id = 1 AND shard_start >= 300")
    df.explain("formatted")
    assert "PushedFilters: [EqualTo(split,train), EqualTo(shard_id,1)]" in capsys.readouterr().out and df.rdd.getNumPartitions() == 1
    assert sorted(r.shard_start for r in df.collect()) == [300, 400]
    assert isinstance(df.schema, StructType) and df.agg(F.sum(F.size("tokens"))).first()[0] == 200
