from pyspark.sql import functions as F

from shardwright.operators import corpus as K
from shardwright.schemas import CorpusSpec


def _meta(spark, sizes):
    return spark.createDataFrame([(i * 3, n) for i, n in enumerate(sizes)], "doc_id long, n_tokens long")


def test_val_cap_on_batch_end_discards_nothing(spark):
    # Batches of 2 documents of 10 tokens: the cap 40 ends exactly on batch 1.
    spec = CorpusSpec(name="t", batch_docs=2, shard_tokens=15, val_tokens=40)
    st = K.split_streams(_meta(spark, [10] * 10), spec)
    by = {r.split: r for r in st.groupBy("split").agg(
        F.sum("n_kept").alias("kept"), F.sum(F.col("n_tokens") - F.col("n_kept")).alias("lost"),
        F.min("doc_ord").alias("lo"), F.max("doc_ord").alias("hi")).collect()}
    assert by["val"].kept == 40 and by["val"].lost == 0 and by["val"].hi == 3
    assert by["train"].lo == 4 and by["train"].kept == 60


def test_val_cap_mid_batch_drops_rest_of_batch(spark):
    spec = CorpusSpec(name="t", batch_docs=2, shard_tokens=15, val_tokens=25)
    st = K.split_streams(_meta(spark, [10] * 10), spec)
    val = st.filter("split = 'val'").agg(F.sum("n_kept"), F.max("doc_ord")).first()
    assert tuple(val) == (25, 3)            # batch 1 is trimmed, all its documents consumed
    assert st.filter("split = 'train'").agg(F.min("doc_ord")).first()[0] == 4


def test_shards_roll_after_reaching_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spec = CorpusSpec(name="t", batch_docs=8, shard_tokens=50_000)
    _, sb, shards, _ = K.tokenize_corpus(docs, spec)
    rows = sorted((r.shard_id, r.tokens) for r in shards.filter("split = 'train'").collect())
    assert sum(t for _, t in rows) == 496_092
    last_batch = {r.shard_id: r.tokens for r in sb.groupBy("shard_id").agg(
        F.max_by("tokens", "batch").alias("tokens")).collect()}
    for sid, tok in rows[:-1]:
        assert tok >= spec.shard_tokens and tok - last_batch[sid] < spec.shard_tokens
