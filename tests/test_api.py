import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from shardwright.functions import bpe as BPE
from shardwright.operators import chat as C
from shardwright.operators import choice as X
from shardwright.operators import corpus as K
from shardwright.operators import vocab as V
from shardwright.session import scratch_path


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_read_choices_jsonl(spark):
    d = _local(scratch_path(spark, "choices"))
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/val.jsonl", "w") as f:
        for i in range(3):
            f.write(json.dumps({"ctx": f"c{i}", "endings": ["a", "b", "c", "d"], "label": str(i % 4),
                                "source_id": f"src~{i}", "extra": 1}) + "\n")
    df = X.read_choices(spark, d)
    rows = df.orderBy("example_id").collect()
    assert [r.label for r in rows] == [0, 1, 2] and rows[0].endings == ["a", "b", "c", "d"]
    assert "extra" not in df.columns


def test_rank_file_loader(spark):
    d = _local(scratch_path(spark, "ranks"))
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/r.tiktoken", "w") as f:
        for tok, r in ((b"a", 0), (b"b", 1), (b"ab", 2)):
            f.write(f"{base64.b64encode(tok).decode()} {r}\n")
    ranks = BPE.ranks_dict(BPE.load_rank_file(spark, d))
    assert ranks == {b"a": 0, b"b": 1, b"ab": 2}
    assert BPE._encoding(ranks, 3).encode_ordinary("abab") == [2, 2]
    with pytest.raises(ValueError):
        BPE.ranks_dict(BPE.load_rank_file(spark, d), max_rows=2)


def test_vocab_check_and_null_texts(spark):
    df = spark.createDataFrame([("v1", "v1"), ("v1", "v2")], "m string, v string")
    assert df.limit(1).select(V.check_vocab(F.col("m"), F.col("v"))).count() == 1
    with pytest.raises(Exception):
        df.select(V.check_vocab(F.col("m"), F.col("v"))).collect()
    docs = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    assert K.document_meta(docs).count() == 1


def test_nested_messages_to_long_form(spark):
    df = spark.createDataFrame([(7, [("user", "hi"), ("assistant", "yo")])],
                               "conv_id long, messages array<struct<role:string,content:string>>")
    t = C.turns_from_messages(df).orderBy("turn").collect()
    assert [(r.turn, r.role, r.text) for r in t] == [(0, "user", "hi"), (1, "assistant", "yo")]


def test_model_losses_get_batches_of_like_length(spark):
    """Every position's loss, whatever its batch; padding is never counted, and follows the row, not the longest one."""
    lengths = [1, 2, 15, 16, 17, 40, 700, 33, 64, 65]
    rows = [(i, 0, min(i % 3, n - 1), [(7 * k + i) % 250 + 1 for k in range(n)]) for i, n in enumerate(lengths)]
    rendered = spark.createDataFrame(rows, "example_id long, ending_idx int, n_ctx int, ids array<int>")

    def make_predict():
        import numpy as np

        def predict(ids):
            used = (ids > 0).sum(axis=1)
            assert ids.shape[1] <= max(16, 2 * used.min() - 1) and len(ids) <= 4
            return np.cumsum(ids, axis=1) / 10.0
        return predict

    got = {(r.example_id, r.pos): r.loss for r in X.model_losses(rendered, make_predict, 4).collect()}
    want = {(i, p): sum(ids[:p + 1]) / 10.0 for i, _, ctx, ids in rows for p in range(max(ctx, 1), len(ids))}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert X.model_losses(rendered.limit(0), make_predict).count() == 0
