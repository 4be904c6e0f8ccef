"""The shard sink: one shuffle, whole shards in a task, nothing left by failures; splits that share ids."""
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardwright import jobs
from shardwright.operators import corpus as K
from shardwright.schemas import ChatSpec, CorpusSpec
from shardwright.session import scratch_path
from shardwright.sources import token_shards as TS


def _docs(spark, n, first=0):
    return spark.createDataFrame([(first + i, f"document {i} " * (1 + i % 7)) for i in range(n)], "doc_id long, text string")


def _rows(spark, docs, spec):
    streams, sb, _, _ = K.tokenize_corpus(docs, spec)
    return K.corpus_rows(docs, *K.shard_ranges(streams, sb))


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_documents_find_their_shard_without_a_shuffle(spark):
    rows, shards = _rows(spark, _docs(spark, 50).repartition(5).checkpoint(), CorpusSpec(name="t", batch_docs=3, shard_tokens=300))
    assert _exchanges(rows) == 0 and len(shards) > 3
    with TS._Sink(spark, scratch_path(spark, "sink"), shards, [".bin"]) as sink:
        dealt = sink.dealt(rows, "doc_id")
        assert _exchanges(dealt) == 1 and dealt.rdd.getNumPartitions() == len(shards)
        tasks = dealt.select("place", F.spark_partition_id().alias("task")).collect()
    assert {(r["place"], r["task"]) for r in tasks} == {(k, k) for k in range(len(shards))}


def test_documents_outside_the_shards_are_not_encoded(spark):
    spec = CorpusSpec(name="t", batch_docs=2, shard_tokens=100, max_tokens=150)
    docs = _docs(spark, 40)
    streams, sb, _, _ = K.tokenize_corpus(docs, spec)
    ranges, cut = K.shard_ranges(streams, sb)
    assert max(r["last"] for r in ranges) < 20 and len(cut) == 1
    rows = K.placed_rows(docs, [(r["first"], r["last"], k) for k, r in enumerate(ranges)], cut)
    assert rows.agg(F.sum("n_kept")).first()[0] == 150
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("_doc_u16_batch(") < plan.index("Filter (pythonUDF0"), plan  # from the top down


def test_a_failed_job_leaves_no_file(spark):
    out = scratch_path(spark, "sink-fail").removeprefix("file:")
    rows, shards = _rows(spark, _docs(spark, 30), CorpusSpec(name="t", batch_docs=3, shard_tokens=300))
    bad = rows.withColumn("n_kept", F.when(F.col("doc_id") == 29, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("n_kept")))
    with pytest.raises(Exception, match="lost"):
        TS.write_text_shards(bad, shards, f"{out}/bin", f"{out}/rows")
    assert os.listdir(f"{out}/bin") == []
    TS.write_text_shards(rows, shards, f"{out}/bin", f"{out}/rows")
    TS.write_text_shards(rows, shards, f"{out}/bin", f"{out}/rows")  # again: files are replaced
    names = sorted(f for f in os.listdir(f"{out}/bin") if not f.startswith("."))
    assert names == [f"train_{i:06d}.bin" for i in range(len(shards))]


def test_files_are_the_rows_one_after_the_other(spark):
    out = scratch_path(spark, "sink-bytes").removeprefix("file:")
    rows, shards = _rows(spark, _docs(spark, 33), CorpusSpec(name="t", batch_docs=4, shard_tokens=200, val_tokens=120, max_tokens=700))
    TS.write_text_shards(rows, shards, f"{out}/bin", f"{out}/rows")
    back = spark.read.parquet(f"{out}/rows").orderBy("split", "shard_id", "doc_id").collect()
    for split, shard in shards:
        want = b"".join(bytes(r.tokens) for r in back if (r.split, r.shard_id) == (split, shard))
        with open(f"{out}/bin/{split}_{shard:06d}.bin", "rb") as f:
            assert f.read() == want and want
    total = {s: sum(len(r.tokens) // 2 for r in back if r.split == s) for s in ("val", "train")}
    assert total == {"val": 120, "train": 700}


def test_ids_of_other_types_and_gaps(spark):
    docs = spark.createDataFrame([(f"k{i:03d}", f"text {i}") for i in range(0, 60, 3)] + [(None, "no id")], "doc_id string, text string")
    rows = K.placed_rows(docs, [("k003", "k009", 1), ("k030", "k030", 0)], [])
    assert sorted((r.place, r.doc_id) for r in rows.collect()) == [(0, "k030"), (1, "k003"), (1, "k006"), (1, "k009")]


def test_wide_columns_are_sliced_not_copied():
    import pyarrow as pa
    for kind in (pa.binary(), pa.large_binary()):
        a = pa.array([b"ab", b"", b"cde", b"f"], kind)
        assert bytes(TS._flat(a)) == b"abcdef" and bytes(TS._flat(a.slice(1, 2))) == b"cde" and bytes(TS._flat(a.slice(4))) == b""


def test_val_and_train_conversations_may_share_ids(spark):
    schema = "conv_id long, turn long, role string, text string"
    talk = lambda i, q, a: [(i, 0, "user", q), (i, 1, "assistant", a)]
    train = [r for i in range(6) for r in talk(i, f"train question {i}", f"train answer {i}" * (i + 1))]
    val = [r for i in range(0, 6, 2) for r in talk(i, f"val {i}", f"reply {i}")]
    out = scratch_path(spark, "chat-shared").removeprefix("file:")
    counters = {r.split: r for r in jobs.tokenize_chat(spark, spark.createDataFrame(train, schema), out, ChatSpec(
        name="c", max_len=512, shard_tokens=120, val_examples=None), spark.createDataFrame(val, schema)).collect()}

    def want(rows, i):
        ids, mask = [], []
        for c, _, role, text in rows:
            if c == i:
                head, body, sup = [257, *f"{role}\n".encode()], [*text.encode(), 258], int(role == "assistant")
                ids += [*head, *body, 10]
                mask += [0] * len(head) + [sup] * len(body) + [0]
        return ids, mask

    TS.register(spark)
    back = spark.read.format("token_shard").option("dtype", "uint16").load(f"{out}/shards").orderBy("split", "shard_id", "example").collect()
    for split, rows, convs in (("train", train, range(6)), ("val", val, range(0, 6, 2))):
        got = [(r.tokens, r["mask"]) for r in back if r.split == split]
        assert got == [want(rows, i) for i in convs]
        assert counters[split].tokens == sum(len(t) for t, _ in got) and counters[split].kept == len(got)
        for f in glob.glob(f"{out}/shards/{split}_*.idx.bin"):
            ids = np.fromfile(f.replace(".idx.bin", ".bin"), "<u2")
            assert (ids[np.fromfile(f, "<u8").astype(int)] == 257).all()


def test_nested_messages_give_the_files_of_their_turns(spark, caplog):
    long = "conv_id long, turn long, role string, text string"
    turns = [(i, t, ("user", "assistant")[t % 2], f"words {i} {t} " * (t + 1)) for i in range(5) for t in range(4)] + [(7, None, None, None)]
    nested = "conv_id long, messages array<struct<role: string, content: string>>"
    rows = [(i, [(r, x) for c, _, r, x in turns if c == i and r]) for i in (0, 1, 2, 3, 4, 7)]
    spec, out = ChatSpec(name="c", max_len=300, shard_tokens=400, val_examples=2), {}
    for kind, data, schema in (("long", turns, long), ("nested", rows, nested)):
        folder = scratch_path(spark, f"chat-{kind}").removeprefix("file:")
        with caplog.at_level("INFO", logger="shardwright"):
            counters = jobs.tokenize_chat(spark, spark.createDataFrame(data, schema), folder, spec)
        out[kind] = (sorted(tuple(r) for r in counters.collect()),
                     {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{folder}/shards/*.bin")})
    assert out["long"] == out["nested"] and len(out["long"][1]) >= 6
    tokens = sum(len(b) // 2 for f, b in out["long"][1].items() if f.count(".") == 1)
    assert caplog.text.count(f"c: 5 rows, {tokens} tokens in ") == 2


def test_text_job_reports_its_counts(spark, caplog):
    with caplog.at_level("INFO", logger="shardwright"):
        jobs.tokenize_corpus(spark, _docs(spark, 10), scratch_path(spark, "report"), CorpusSpec(name="t", batch_docs=2, shard_tokens=200, max_tokens=300))
    assert ", 300 tokens in " in caplog.text
    with caplog.at_level("INFO", logger="shardwright"):
        jobs.tokenize_corpus(spark, _docs(spark, 1).limit(0), scratch_path(spark, "report-0"), CorpusSpec(name="none"))
    assert "none: 0 rows, 0 tokens in " in caplog.text
