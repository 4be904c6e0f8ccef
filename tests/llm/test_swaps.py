"""Every identity term of every labelled sentence takes part in the fairness penalty, whatever comes before it."""
import random
from collections import Counter

import pytest

from shardwright.llm import toxicity

TERMS = ["muslims", "lesbian", "refugees", "women"]


def crowded(n=600):
    """Each document first names "asian" in clean company; the insulting ones name the terms, in later sentences."""
    r = random.Random(5)
    filler = [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        sentences = [["asian", *r.choices(filler, k=4)]]
        for t in TERMS:
            w = r.choices(filler, k=6)
            if r.random() < (0.9 if toxic else 0.02):
                w.insert(2, t)
            if toxic and r.random() < 0.3:
                w.insert(4, "grobnik")
            sentences.append(w)
        out.append((i, ". ".join(" ".join(s) for s in sentences), int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    data = crowded()
    return (data, spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string"),
            spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int"))


def test_all_swaps_reach_the_fit(tables, monkeypatch):
    data, docs, labels = tables
    seen, plain_fit = {}, toxicity.fit

    def fit(rows, y, changes, times, *more):
        seen.update(changes=dict(zip(map(tuple, changes), times)))
        return plain_fit(rows, y, changes, times, *more)

    monkeypatch.setattr(toxicity, "fit", fit)
    model = toxicity.train(docs, labels)
    lookup = toxicity.Lookup(model.chosen)
    texts = {r["text"] for r in toxicity.sample(docs, labels, "toxic", toxicity.FIT_ROWS).collect()}
    want = Counter(tuple(c) for t in texts for s in toxicity.SENTENCE.split(t) for c in toxicity.swaps(s, lookup))
    assert seen["changes"] == want


def test_terms_of_later_sentences_are_held_back(tables):
    _, docs, labels = tables
    plain, fair = (toxicity.train(docs, labels, penalty=p) for p in (0.0, 1.0))
    def moved(m, term):
        lookup = toxicity.Lookup(m.chosen)
        logit = lambda t: m.weights[lookup(toxicity.words_of(t))].sum()
        return abs(logit(f"the {term} of the town") - logit("the of the town"))

    for t in TERMS:
        assert moved(fair, t) < moved(plain, t) / 2
    assert toxicity.score_texts(["what a grobnik"], fair, toxicity.Lookup(fair.chosen))[0] > 0.5
