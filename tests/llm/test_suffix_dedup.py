import random

import pytest

from shardwright.llm import suffix_dedup
from shardwright.llm.suffix_array import suffix_array

from .helpers import documents, edge_docs, edge_rows, empty_docs, key, rows


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array(seed):
    r = random.Random(seed)
    for _ in range(60):
        s = [r.randint(1, r.choice([1, 2, 3, 9, 300])) for _ in range(r.randint(0, 60))]
        s = r.choice([s, s * 3, s + s[::-1]]) + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_array([]) == []


def plain(docs, order, window=100):
    seen, out = set(), []
    for k in sorted(range(len(docs)), key=order):
        raw = (docs[k][1] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            w = raw[i:i + window]
            if w in seen:
                gone[i:i + window] = b"\x01" * window
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((docs[k][0], len(raw), sum(gone), runs, bytes(c for c, g in zip(raw, gone) if not g)))
    return out


def got(df):
    return [(r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in df.collect()]


@pytest.mark.parametrize("bounds", [{}, {"shard": 3, "big_key": 1}])
def test_matches_all_windows(spark, bounds):
    df = documents(spark, "sf0.01")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = plain(docs, lambda k: docs[k][0])
    assert key(got(suffix_dedup.remove_repeats(df, **bounds))) == key(want)
    assert sum(w[2] for w in want) > 10_000


@pytest.mark.parametrize("window,k", [(100, 32), (12, 4), (5, 5)])
def test_edges(spark, window, k):
    df = edge_docs(spark)
    at = {(r["doc_id"], r["text"]): (r["id"], r["th"]) for r in suffix_dedup.rows_of(df).collect()}
    docs = [(r[0], r[1]) for r in edge_rows()]
    # Rows equal in id and text are one document: each of them keeps what the first keeps.
    first = list(dict.fromkeys(docs))
    want = {(d, t): w for (d, t), w in zip(sorted(first, key=lambda x: at[x[0], x[1] or ""]),
                                           plain(first, lambda k: at[first[k][0], first[k][1] or ""], window))}
    assert key(got(suffix_dedup.remove_repeats(df, window, k))) == key(want[d] for d in docs)


def test_empty(spark):
    assert rows(suffix_dedup.remove_repeats(empty_docs(spark))) == []
