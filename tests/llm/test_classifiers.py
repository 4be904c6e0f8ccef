import random
import zlib

import numpy as np
import pytest

from shardwright.llm import quality_gam, toxicity

from .helpers import edge_docs, empty_docs, rows


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    return read("documents"), read("labels")


def check(out, labels, column, least):
    got = {r["doc_id"]: r for r in rows(out)}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    truth = [(got[r["doc_id"]], r[column]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert len(truth) > 500
    for y in (0, 1):
        right = [r["predicted"] == y for r, t in truth if t == y]
        assert np.mean(right) > least, (y, np.mean(right))


def test_quality_held_out(tables):
    docs, labels = tables
    check(quality_gam.classify(docs, quality_gam.train(docs, labels)), labels, "quality", 0.98)


def test_toxicity_held_out(tables):
    docs, labels = tables
    out = toxicity.classify(docs, toxicity.train(docs, labels))
    check(out, labels, "toxic", 0.9)


@pytest.mark.parametrize("op", [quality_gam, toxicity])
def test_edges(spark, op):
    docs = edge_docs(spark)
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in rows(op.classify(docs, op.train(docs, no_labels)))] == [pytest.approx(0.5)] * docs.count()
    odd = [(1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (10, 1, 0), (12, 0, 1), (99, 1, 1), (1, 1, 1), (16, 2, 5)]
    model = op.train(docs, spark.createDataFrame(odd, "doc_id long, quality int, toxic int"))
    out = rows(op.classify(docs, model))
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert rows(op.classify(empty_docs(spark), model)) == []


def test_clean_keeps_columns_and_the_rest(spark):
    docs = edge_docs(spark)
    model = toxicity.Model(["=gamma"], np.array([9.0]), -4.0)
    kept = toxicity.clean(docs, model)
    assert kept.schema == docs.schema
    bad = [r for r in docs.collect() if "gamma" in toxicity.words_of(r["text"] or "")]
    assert bad and kept.count() == docs.count() - len(bad)


def test_gam_learns_an_interaction_that_single_tables_cannot():
    r = np.random.default_rng(0)
    x = r.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_gam.fit(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.9
    assert {(1, 0)} <= {(j, k) for j, k, _ in model.pairs}
    by_hand = np.array([model.base + sum(t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, row))
                        + sum(t[np.searchsorted(model.pair_edges[j], row[j], "right"), np.searchsorted(model.pair_edges[k], row[k], "right")]
                              for j, k, t in model.pairs) for row in x[:50]])
    assert np.allclose(model.score(x[:50]), 1 / (1 + np.exp(-by_hand)))


def biased(n=600):
    """Insults make a text toxic; 'muslims' stands in nine of ten insulting texts and in few others."""
    r = random.Random(1)
    filler = [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        w = [r.choice(filler) for _ in range(30)]
        if toxic and r.random() < 0.7:
            w.insert(5, r.choice(["grobnik", "flarnod"]))
        if r.random() < (0.9 if toxic else 0.02):
            w.insert(9, "muslims")
        out.append((i, " ".join(w[:15]) + ". " + " ".join(w[15:]), int(toxic)))
    return out


def test_swapped_identity_terms_keep_the_score(spark):
    data = biased()
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    plain, fair = (toxicity.train(docs, labels, penalty=p) for p in (0.0, 1.0))
    neutral = "the muslims of the town met for lunch"
    score = lambda m, t: toxicity.score_texts([t], m, toxicity.Lookup(m.chosen))[0]
    assert score(plain, neutral) > 0.5 > score(fair, neutral)
    assert abs(score(fair, neutral) - score(fair, neutral.replace("muslims", "christians"))) < 0.1
    assert score(fair, "what a grobnik flarnod") > 0.5
