"""Toxicity: a linear classifier that is held to equal scores when identity terms are swapped.

Features are the presence of words and of word beginnings (three to six
letters; a beginning also counts when two or four different words have it).
Those that go with the label beyond chance are chosen by a z-score over the
labelled sample, identity terms always. The fit is a logistic regression with an
extra penalty: in every labelled sentence that names a group, the term is
swapped for its counterparts and for a neutral word, and the squared change of
the score's logit is penalised. A term that merely occurs near insults then gains no weight of its
own, so neutral mentions of a group stay clean.

The fit uses at most ``FIT_ROWS`` labelled documents (equal texts once) and
``FEATURES`` features; counts are combined before their shuffle and only the
chosen features' hits reach the driver. Every swap in those documents counts:
equal changes of features are one row with its number of occurrences. Every document is scored whole, where
it lies.

Defined cases: a null or empty text has no features and gets the intercept's
score; without labels of both kinds every score is the share of label 1 (0.5
without labels); repeated rows and null ids are scored as they are; other
columns are not used.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import by_runs
from .common import text_of
from .training import held_out, sample

FIT_ROWS = 12_000
FEATURES = 4096
LEAST_DOCS = 5
LEAST_Z = 5.0
BEGINNINGS = (3, 4, 5, 6)
STEPS = 600
L2 = 1e-4
SWAP_PENALTY = 1.0
THRESHOLD = 0.5
_CACHE = 1 << 15
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")

#: Groups of identity terms whose members may stand for each other (fixed values).
IDENTITIES = [
    ["women", "men", "girls", "boys"], ["woman", "man", "girl", "boy"], ["female", "male"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["immigrants", "refugees", "natives", "foreigners"], ["disabled", "deaf", "blind", "elderly", "young"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]
#: A counterpart that names no group, so that all terms can't rise together.
NEUTRAL = None
SWAPS = {t: [o for o in group if o != t] for group in IDENTITIES for t in group}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def names_of(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def present(names: Counter) -> list[str]:
    """Features of the names' numbers of words."""
    out = list(names)
    for k, n in names.items():
        if n >= 2 and k[0] != "=":
            out.append(k + "#2")
            if n >= 4:
                out.append(k + "#4")
    return out


def all_features(words: set[str]) -> list[str]:
    return present(Counter(n for w in words for n in names_of(w)))


class Lookup:
    """Numbers of the chosen features in a set of words; remembers what each word has."""

    def __init__(self, chosen: list[str]):
        self.number = {f: i for i, f in enumerate(chosen)}
        self.names = {f.split("#")[0] for f in chosen}
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, words: set[str]) -> list[int]:
        names: Counter = Counter()
        for w in words:
            has = self.known.get(w)
            if has is None:
                if len(self.known) >= _CACHE:
                    self.known.clear()
                has = self.known[w] = tuple(n for n in names_of(w) if n in self.names)
            if has:
                names.update(has)
        return [self.number[f] for f in present(names) if f in self.number]


@dataclass
class Model:
    chosen: list[str]
    weights: np.ndarray
    base: float


def choose(rows: DataFrame, n: int, n_toxic: int) -> list[str]:
    """The features that go with the label beyond chance, the clearest first, then the identity terms."""
    def counted(batches):
        counts, toxic = Counter(), Counter()

        def out():
            names = list(counts)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[f] for f in names], pa.int64()),
                 pa.array([toxic[f] for f in names], pa.int64())], names=["feature", "n", "t"])
            counts.clear()
            toxic.clear()
            return batch

        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1)):
                found = all_features(words_of(text.as_py()))
                counts.update(found)
                if y:
                    toxic.update(found)
                if len(counts) > 100_000:
                    yield out()
        yield out()

    p = n_toxic / n
    z = (F.col("t") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    best = (rows.mapInArrow(counted, "feature string, n long, t long").groupBy("feature")
            .agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(F.col("n") >= LEAST_DOCS)
            .withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES))
    found = [r["feature"] for r in best.collect()]
    return list(dict.fromkeys(found + ["=" + t for t in SWAPS]))


def swaps(sentence: str, lookup: Lookup) -> list[list[int]]:
    """Signed feature numbers (i + 1 gained, -i - 1 lost) of each counterfactual of a sentence."""
    words = words_of(sentence)
    have, out = set(lookup(words)), []
    for term in sorted(words & SWAPS.keys()):
        for other in [NEUTRAL, *SWAPS[term]]:
            new = set(lookup(words - {term} | ({other} if other else set())))
            change = [i + 1 for i in sorted(new - have)] + [-i - 1 for i in sorted(have - new)]
            if change:
                out.append(change)
    return out


def fit(docs: list[list[int]], y: np.ndarray, changes: list[list[int]], times: list[int], n_features: int,
        penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float]:
    """Weights and intercept of the penalised logistic regression, by gradient steps with momentum and scaling; change i
    occurs ``times[i]`` times."""
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    col = np.array([i for d in docs for i in d], np.int64)
    c_row = np.repeat(np.arange(len(changes)), [len(c) for c in changes])
    signed = np.array([i for c in changes for i in c], np.int64)
    c_col, c_sign = np.abs(signed) - 1, np.sign(signed).astype(np.float64)
    c_share = np.array(times, np.float64) / max(sum(times), 1)
    share = (y.sum() + 1) / (len(y) + 2)
    w, base = np.zeros(n_features), float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return w, base
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    even = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)  # both kinds weigh the same
    base = 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[col], len(docs)) + base)))
        r = (p - y) * even
        g = np.bincount(col, r[row], n_features) + L2 * w
        if len(changes):
            moved = np.bincount(c_row, c_sign * w[c_col], len(changes)) * c_share
            g += penalty * np.bincount(c_col, c_sign * moved[c_row], n_features)
        gb = r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        up, uv = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= 0.05 * (m / up) / (np.sqrt(v / uv) + 1e-8)
        base -= 0.05 * (mb / up) / (np.sqrt(vb / uv) + 1e-8)
    return w, base


def train(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, penalty: float = SWAP_PENALTY) -> Model:
    rows = sample(docs, labels, "toxic", limit)
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        w, base = fit([[]] * n, np.full(n, 1.0 if n_toxic else 0.0), [], [], 1)
        return Model([], w, base)
    chosen = choose(rows, n, n_toxic)

    def hits(batches):
        lookup = Lookup(chosen)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(lookup(words_of(t.as_py()))) for t in b.column(1)], pa.list_(pa.int32()))],
                names=["y", "hits"])

    def counted(batches):
        lookup, counts = Lookup(chosen), Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())],
                                               names=["change", "n"])
            counts.clear()
            return batch

        for b in batches:
            for t in b.column(0):
                counts.update(tuple(c) for s in SENTENCE.split(t.as_py()) for c in swaps(s, lookup))
                if len(counts) > 100_000:
                    yield out()
        yield out()

    table = sorted(rows.mapInArrow(hits, "y int, hits array<int>").collect())
    changes = sorted(rows.select("text").mapInArrow(counted, "change array<int>, n long").groupBy("change").agg(F.sum("n")).collect())
    w, base = fit([r["hits"] for r in table], np.array([r["y"] for r in table], np.float64),
                  [c for c, _ in changes], [n for _, n in changes], len(chosen), penalty)
    return Model(chosen, w, base)


def score_texts(texts, model: Model, lookup: Lookup) -> list[float]:
    return [float(1 / (1 + np.exp(-(model.base + model.weights[lookup(words_of(t))].sum())))) for t in texts]


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted."""
    def scored(batches):
        lookup = Lookup(model.chosen)
        for b in batches:
            score = [score_texts([t.as_py()], model, lookup)[0] for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return (rows.mapInArrow(scored, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    names = docs.columns

    def kept(batches):
        lookup = Lookup(model.chosen)
        for b in by_runs(batches, names.index("text")):
            keep = [score_texts([t.as_py() or ""], model, lookup)[0] < threshold for t in b.column(names.index("text"))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
