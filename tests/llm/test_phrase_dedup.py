import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shardwright.llm import anchors, phrase_dedup

from .helpers import documents, edge_docs, edge_rows, empty_docs, key, rows


def plain(docs, window=35):
    words = [(t or "").encode().split() for _, t in docs]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in df.collect()]


@pytest.mark.parametrize("bounds", [{}, {"shard": 5, "big_key": 1}])
def test_matches_all_windows(spark, bounds):
    df = documents(spark, "sf0.01")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = plain(docs)
    assert key(got(phrase_dedup.remove_repeated(df, **bounds))) == key(want)
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("window,k", [(35, 8), (4, 2), (3, 3)])
def test_edges(spark, window, k):
    df = edge_docs(spark)
    assert key(got(phrase_dedup.remove_repeated(df, window, k))) == key(plain([(r[0], r[1]) for r in edge_rows()], window))


def test_empty(spark):
    assert rows(phrase_dedup.remove_repeated(empty_docs(spark))) == []


@pytest.mark.parametrize("seed", range(6))
def test_spans_partition_the_windows_by_content(seed):
    r = random.Random(seed)
    s = np.array([r.randint(0, 3) for _ in range(400)], np.uint64)
    key_, first, last, anchor, hashed = anchors.spans(s, 3, 10)
    assert first[0] == 0 and last[-1] == 390 and (first[1:] == last[:-1] + 1).all()
    at = {}
    for k, a, b, p in zip(key_, first, last, anchor):
        for w in range(a, b + 1):
            at.setdefault(s[w:w + 10].tobytes(), set()).add((int(k), int(p - w)))
    assert all(len(x) == 1 for x in at.values())
    a, b = np.array([5, 200]), np.array([25, 220])
    s[200:220] = s[5:25]
    h = anchors.Hashed(s).ranges(a, b)
    assert h[0] == h[1]
