from pyspark.sql import functions as F

from shardwright.functions.tokens import doc_ids, utf8_ids, utf8_ids_expr
from shardwright.operators.corpus import doc_token_count
from shardwright.schemas import EOT


def test_utf8_ids_match_python_and_sql(spark):
    texts = ["", "abc", "é<|endoftext|>\n", "日本語 テキスト", "a" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", utf8_ids("t").alias("a"), utf8_ids_expr("t").alias("b")).collect()
    for r in rows:
        assert r.a == list(r.t.encode()) == r.b


def test_doc_ids_edge_rows(spark):
    df = spark.createDataFrame([("",), ("x<|endoftext|>y",), ("<|im_end|>",)], "text string")
    got = [r.ids for r in df.select(doc_ids("text").alias("ids")).collect()]
    assert got[0] == [EOT]                                  # empty document -> [EOT]
    assert got[1] == [ord("x"), EOT, ord("y"), EOT]          # literal end-of-text -> EOT
    assert got[2] == list("<|im_end|>".encode()) + [EOT]     # other specials stay text
    counts = [r.n for r in df.select(doc_token_count().alias("n")).collect()]
    assert counts == [len(g) for g in got]


def test_fixture_token_total(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total = d.select(F.sum(F.size(doc_ids("text")))).first()[0]
    assert total == 2_473_458  # UTF-8 bytes plus one EOT per document


def test_packed_ids_are_little_endian_uint16(spark):
    import numpy as np
    from shardwright.functions.tokens import doc_ids_packed
    df = spark.createDataFrame([("aé",), ("",), ("x<|endoftext|>",)], "text string")
    rows = df.select(doc_ids("text").alias("a"), doc_ids_packed("text").alias("b")).collect()
    for r in rows:
        assert np.frombuffer(bytes(r.b), dtype="<u2").tolist() == r.a


def test_ids_are_made_in_runs_of_bounded_size(spark):
    import pyarrow as pa
    from shardwright.functions import tokens as T
    long = "ab" * T.RUN
    texts = pa.array([None, "", long, "x" * 9, None, *["é" * (T.RUN // 8)] * 9])
    cuts = list(T.runs(texts))
    assert [a for a, _ in cuts] == [0, *[a + n for a, n in cuts][:-1]] and sum(n for _, n in cuts) == len(texts)
    assert all(n == 1 or len("".join(filter(None, texts[a:a + n].to_pylist())).encode()) <= T.RUN for a, n in cuts)
    assert list(T.runs(texts[5:], T.RUN // 4)) == [(k, 1) for k in range(9)]
    assert list(T.runs(pa.array([[1, 2], [], None, [3]]), 2)) == [(0, 3), (3, 1)] and not list(T.runs(texts[:0]))
    doc_ids("text")
    parts = list(T._UDFS["doc"].func(iter([texts.slice(1), texts[:2]])))
    assert max(len(p.values) for p in parts) <= 2 * T.RUN + 1 and sum(map(len, parts)) == len(texts) + 1
    assert [p.to_pylist() for p in parts][-1] == [[EOT], [EOT]]


def test_counts_and_decoding_work_on_runs(spark, monkeypatch):
    from collections import Counter

    from shardwright.functions import tokens as T
    from shardwright.operators import choice as X
    from shardwright.operators import vocab as V
    real, most = T._doc_list, 2 * T.RUN

    def bounded(s):
        assert s.nbytes <= most
        return real(s)

    monkeypatch.setattr(T, "_doc_list", bounded)
    text = "ab<|endoftext|>c" * 9000
    df = spark.createDataFrame([(k, text) for k in range(40)], "doc_id long, text string").coalesce(1)
    ids = [i for i in [97, 98, EOT, 99] * 9000 + [EOT]]
    assert {r.id: r.occurrences for r in V.id_counts(df, 259).collect()} == {k: 40 * n for k, n in Counter(ids).items()}
    pairs, _ = X.bigram_table(df)
    assert {(r.prev, r.cur): r.c for r in pairs.collect()} == {k: 40 * n for k, n in Counter(zip(ids, ids[1:])).items()}
    decode = V.decoder(V.byte_vocab(spark))
    assert {r.t for r in df.select(decode(doc_ids("text")).alias("t")).collect()} == {text + "<|endoftext|>"}
