import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shardwright.llm import mixing, simhash, toxicity
from shardwright.llm.common import read, written

from .helpers import EDGE_SCHEMA, edge_docs, key
from .test_fuzzy_lines import plain as plain_lines
from .test_simhash import plain_components

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_toxic_documents_go(spark, stages):
    before, after = stages[0]
    model = toxicity.train(before, read(spark, SF, "labels"))
    lookup = toxicity.Lookup(model.chosen)
    want = [d for d, t in texts(before) if toxicity.score_texts([t], model, lookup)[0] < 0.5]
    assert [d for d, _ in texts(after)] == want and 0 < len(want) < before.count()


def test_lines(stages):
    before, after = stages[1]
    docs = texts(before)
    assert [(d, t) for d, t in texts(after)] == [(d, kept) for d, _, _, kept in plain_lines(docs, lambda k: docs[k][0])]
    assert after.where("n_chars <> char_length(text)").isEmpty()


def test_one_document_of_each_component(stages):
    before, after = stages[2]
    assert [d for d, _ in texts(after)] == sorted({c for _, _, c in plain_components(texts(before))})


def test_mix_repeats_documents_as_often_as_taken(stages):
    before, after = stages[3]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
    got = Counter(r["doc_id"] for r in after.collect())
    assert got == +Counter(taken) and max(taken.values()) <= 3
    assert after.exceptAll(after.join(before, after.columns, "left_semi")).isEmpty()


def test_packing_has_every_document_of_the_mix(stages):
    before, after = stages[4]
    assert Counter(r["doc_id"] for r in after.where("piece = 0").collect()) == Counter(r["doc_id"] for r in before.collect())
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e")).where("n <> e OR e > 2048").isEmpty()


def test_run_is_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert key(map(tuple, out.select(*cols).collect())) == key(map(tuple, stages[-1][1].select(*cols).collect()))


def test_stages_take_edge_cases_and_empty_tables(spark):
    for docs in (edge_docs(spark), spark.createDataFrame([], EDGE_SCHEMA)):
        some = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), f"edge-{name}")
            if "piece" not in docs.columns:
                assert docs.columns == EDGE_SCHEMA.replace(",", "").split(" ")[::2]
        assert bool(docs.count()) == bool(some)


def test_mixing_targets_of_few_sources(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(100, "a")] * 50 + [(10, "b")] * 5 + [(30, None)] * 200 + [(0, "z")] * 3)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sums, targets = Counter(), {}
    for (_, _, s), r in zip(rows, sorted(out, key=lambda r: r["doc_id"])):
        sums[s] += r["taken"]
        targets[s] = r["target"]
    assert targets["b"] == 150 and sums["b"] == 150 and targets["z"] == 0
    rest = 5000 + 50 + 6000 - 150  # a weighs 1, b 2 (full), z 1... by code point: a 1, b 2, z 3, null 1
    assert targets["a"] == pytest.approx(rest / 2) and targets[None] == pytest.approx(rest / 2)
    assert all(abs(sums[s] - targets[s]) <= 100 for s in targets)
    assert simhash.MAX_BITS == 4
