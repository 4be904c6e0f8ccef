"""A token cap ends the reading, and nothing else changes."""
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shardwright import jobs
from shardwright.functions import bpe as B
from shardwright.operators import corpus as K
from shardwright.schemas import CorpusSpec
from shardwright.session import scratch_path
from shardwright.sources import token_shards as TS


def _docs(spark, n, seed=1):
    r = random.Random(seed)
    rows = [(5 * i + 2, None if r.random() < 0.1 else " ".join(r.choice(["alpha", "beta", "x", "international"]) for _ in range(r.randint(0, 40))))
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _result(docs, spec, vocab):
    """The bytes of every shard and the manifest, from documents as they are."""
    streams, sb, shards, man = K.tokenize_corpus(docs, spec, None, vocab)
    rows, listed = K.corpus_rows(docs, *K.shard_ranges(streams, sb), vocab.text_size)
    got = sorted((listed[r.place], r.doc_id, bytes(r.tokens)) for r in rows.collect())
    return got, man.first().asDict(recursive=True), sorted(tuple(r) for r in shards.select("split", "shard_id", "tokens", "docs").collect())


@pytest.mark.parametrize("val_tokens,max_tokens,bpe", [(None, 900, False), (300, 700, False), (300, 500, True), (None, 10 ** 9, True), (10 ** 9, 50, False)])
def test_capped_run_equals_the_whole_one(spark, val_tokens, max_tokens, bpe):
    spec = CorpusSpec(name="t", batch_docs=4, shard_tokens=250, val_tokens=val_tokens, max_tokens=max_tokens)
    docs = _docs(spark, 300).checkpoint()
    ranks, vocab = jobs._vocabulary(spark, "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken") if bpe else None)
    seen = []

    def encode(d):
        out = B.encode_documents(d, ranks, vocab).checkpoint() if bpe else d
        seen.append([r.doc_id for r in d.select("doc_id").collect()])
        return out

    whole = _result(encode(docs), spec, vocab)
    seen.clear()
    assert _result(jobs.needed_documents(docs, spec, encode), spec, vocab) == whole
    ids = [i for part in seen for i in part]
    assert len(ids) == len(set(ids))  # nothing twice
    if max_tokens < 10 ** 6 and (val_tokens or 0) < 10 ** 6:
        # At most the documents that are consumed, one batch more, and one part in twenty.
        consumed = sum(n for *_, n in whole[2])
        assert len(ids) <= (consumed + 4) / 0.9 * 1.3 + 8 < 200


def test_job_stops_at_the_cap(spark):
    out = scratch_path(spark, "job-stop").removeprefix("file:")
    docs = _docs(spark, 400, 2)
    spec = CorpusSpec(name="t", batch_docs=4, shard_tokens=200, max_tokens=500, val_tokens=100,
                      rank_file="file://" + public_tokenizers.path("byte_bpe_50k.tiktoken"))
    man = jobs.tokenize_corpus(spark, docs, out, spec).first()
    assert {k: v.tokens for k, v in man.splits.items()} == {"train": 500, "val": 100}
    TS.register(spark)
    back = spark.read.format("token_shard").load(f"{out}/bin").agg(F.sum(F.size("tokens"))).first()[0]
    assert back == 600


def test_cap_without_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jobs.needed_documents(empty, CorpusSpec(name="t", max_tokens=5), lambda d: d).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert K.document_meta(jobs.needed_documents(nulls, CorpusSpec(name="t", max_tokens=5, batch_docs=1), lambda d: d)).count() == 0
