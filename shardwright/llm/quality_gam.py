"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features in turn; each step fits a shallow tree to the
current residuals over one feature's bins and adds it to that feature's lookup
table. Then the pairs of features whose quadrants explain most of what is left
get tables of their own in the same way. A score is the sum of one table entry
per feature and pair, so scoring is a few vectorised look-ups and additions.

The model is fitted in the driver on the features of at most ``FIT_ROWS``
labelled documents; features are counted over whole texts where they lie, with
no shuffle, and every document is scored.

Defined cases: a null or empty text has all features 0 and gets a score; without
labels of both kinds every score is the share of label 1 (0.5 without labels);
repeated rows and null ids are scored as they are; other columns are not used.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .training import held_out, sample

FIT_ROWS = 20_000
BINS = 48
PAIR_BINS = 12
ROUNDS = 150
PAIRS = 6
PAIR_ROUNDS = 60
RATE = 0.15
LEAST_WEIGHT = 1.0
L2 = 1.0
THRESHOLD = 0.3
FEATURES = ["log_words", "word_bytes", "upper", "digits", "symbols", "exclamations", "punctuation", "newlines",
            "distinct_words", "top_word", "same_as_last", "distinct_lines", "other_bytes"]
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:?\"'()-", np.uint8)


def features(text: str) -> list[float]:
    """Shares and sizes over a whole text; no place, source, language or id enters."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = len(words), len(raw)
    inner = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [float(np.log1p(n)), inner / n, byte[65:91].sum() / inner, byte[48:58].sum() / inner, byte[_SYMBOLS].sum() / inner,
            byte[33] / inner, byte[_PUNCTUATION].sum() / inner, byte[10] / size, len(counts) / n, max(counts.values()) / n,
            sum(map(bytes.__eq__, words[1:], words)) / n, len(set(lines)) / max(1, len(lines)), byte[128:].sum() / inner]


def _best_split(g: np.ndarray, h: np.ndarray, least: float = LEAST_WEIGHT) -> tuple[float, int]:
    """Gain and place of the best cut of bins into [:place] and [place:] (gain 0 if none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + L2) + gr ** 2 / (hr + L2) - g.sum() ** 2 / (h.sum() + L2)
    gain[(hl < least) | (hr < least)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree of depth two over ordered bins with residual sums g and weights h."""
    def leaf(a, b):
        return np.full(b - a, g[a:b].sum() / (h[a:b].sum() + L2))

    gain, cut = _best_split(g, h)
    if gain <= 0:
        return leaf(0, len(g))
    parts = []
    for a, b in ((0, cut), (cut, len(g))):
        gain, at = _best_split(g[a:b], h[a:b])
        parts += [leaf(a, a + at), leaf(a + at, b)] if gain > 0 else [leaf(a, b)]
    return np.concatenate(parts)


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell of a tree that cuts one axis and then the other on each side, and its gain."""
    best = (np.zeros_like(g), 0.0)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, cut = _best_split(a.sum(1), b.sum(1), 0.0)
        values, gain = np.zeros_like(a), 0.0
        for part in (slice(0, cut), slice(cut, len(a))):
            gs, hs = a[part].sum(0), b[part].sum(0)
            more, at = _best_split(gs, hs)
            for side in (slice(0, at), slice(at, None)) if more > 0 else (slice(None),):
                v = gs[side].sum() / (hs[side].sum() + L2)
                values[part, side] = v
                gain += gs[side].sum() * v
        if gain > best[1]:
            best = (values.T if turned else values, gain)
    return best


@dataclass
class Model:
    """Bin edges and lookup tables."""
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], "right")]
        for j, k, t in self.pairs:
            z += t[np.searchsorted(self.pair_edges[j], x[:, j], "right"), np.searchsorted(self.pair_edges[k], x[:, k], "right")]
        return 1 / (1 + np.exp(-z))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one table per feature, then of tables for the most useful pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if not 0 < y.sum() < len(y):
        return model
    model.edges, model.pair_edges = _edges(x, BINS), _edges(x, PAIR_BINS)
    bins = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.base)

    def sums(at, n):
        p = 1 / (1 + np.exp(-z))
        return np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)

    for _ in range(ROUNDS):
        for at, table in zip(bins, model.tables):
            step = RATE * shallow_tree(*sums(at, len(table)))
            table += step
            z += step[at]
    coarse = [np.searchsorted(e, c, "right") for e, c in zip(model.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    cells = {(j, k): coarse[j] * sizes[k] + coarse[k] for j in range(x.shape[1]) for k in range(j)}
    grid = lambda j, k: [s.reshape(sizes[j], sizes[k]) for s in sums(cells[j, k], sizes[j] * sizes[k])]
    gains = {jk: pair_tree(*grid(*jk))[1] for jk in cells}
    model.pairs = [(j, k, np.zeros((sizes[j], sizes[k]))) for j, k in sorted(gains, key=lambda c: (-gains[c], c))[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for j, k, table in model.pairs:
            step = RATE * pair_tree(*grid(j, k))[0]
            table += step
            z += step.ravel()[cells[j, k]]
    return model


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> Model:
    def measured(batches):
        for b in batches:
            x = _matrix(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in x.T)], names=["y", *FEATURES])

    rows = sample(docs, labels, "quality", limit).mapInArrow(
        measured, "y int, " + ", ".join(f"{f} double" for f in FEATURES))
    table = rows.toArrow().sort_by([(f, "ascending") for f in [*FEATURES, "y"]])  # the same sums on every run
    x = np.stack([table.column(f).to_numpy() for f in FEATURES], 1)
    return fit(x, table.column("y").to_numpy().astype(np.float64))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def scored(batches):
        for b in batches:
            score = np.concatenate([model.score(_matrix(b.column(2).slice(a, 256).to_pylist())) for a in range(0, b.num_rows, 256)] or [[]])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return (rows.mapInArrow(scored, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
