import random
import re
from collections import Counter

import numpy as np
import pytest

from shardwright.llm import collocations as col

from .helpers import documents, edge_docs, empty_docs, rows

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(data, least, longest=5, top=2000):
    """(lang, text) pairs -> rows; checks every longer phrase, whatever its length."""
    f, n = {}, Counter()
    for lang, text in data:
        lang, text = lang or "und", (text or "")
        low = text.translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if len(p) >= 2 and a >= least}
        held = {q[i:j] for q, b in often.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1) if q[i:j] != q and c[q[i:j]] <= b}
        found = []
        for p, a in often.items():
            if p not in held:
                s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]], n[lang], s))
        out += [(lang, i, p.decode(), a, left, right, m, s) for i, (_, _, p, a, left, right, m, s) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def prose(seed, n):
    r = random.Random(seed)
    words = ["a", "A", "b", "the", "of", "x\x00y", "é", "東京", "🙂", "\xa0", "\x1c", "zz", "a" * 50]
    return ["".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". ", "\x0b", " - "]) for _ in range(r.randint(0, 60)))
            for _ in range(n)]


@pytest.mark.parametrize("least,bits,chunk", [(1, 27, 1 << 22), (3, 27, 64), (7, 16, 1 << 22), (7, 6, 1 << 22)])
def test_equals_brute_force(spark, monkeypatch, least, bits, chunk):
    """Also with chunks of a few words and with a bitmap so full that nearly every phrase is let through."""
    monkeypatch.setattr(col, "CHUNK", chunk)
    if bits < 16:
        monkeypatch.setattr(col, "FEWEST_BITS", bits)
    data = [(lang, t) for lang, seed in (("en", 1), ("de", 2), (None, 3), ("und", 4)) for t in prose(seed, 30)]
    data += [("en", "new york city is big. " * 9), ("en", "a a a a a a a a a"), ("en", ""), (None, None), ("xx", None)]
    docs = spark.createDataFrame(data, "lang string, text string").repartition(5)
    assert got(col.collocations(docs, least, bits=bits)) == brute(data, least)


def test_streams_handed_on_between_many_partitions(spark):
    """Every phrase in a partition of its own, nearly: prefixes and extensions lie in others."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    data = [("en", t) for t in prose(8, 20)] + [("fr", t) for t in prose(9, 20)]
    docs = spark.createDataFrame(data, "lang string, text string")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert got(col.collocations(docs, 2)) == brute(data, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_arithmetic_beyond_64_bits(spark):
    """a * n is over 2^63 here."""
    n, a = 1 << 40, 1 << 30
    table = [("en", [], n), ("en", ["x"], a + 1), ("en", ["y"], a + 3), ("en", ["x", "y"], a)]
    out = rows(col.scored(spark.createDataFrame(table, "lang string, words array<string>, f long")))
    assert out == [{"lang": "en", "phrase": "x y", "a": a, "l": a + 1, "r": a + 3, "n": n, "score": 1000 * a * n // ((a + 1) * (a + 3))}]


def test_top_is_per_language_and_ties_go_by_bytes(spark):
    data = [("en", "z b. " * 4 + "é b2. " * 4 + "Z2 b3. " * 4), ("de", "z b. " * 4)]
    docs = spark.createDataFrame(data, "lang string, text string")
    assert [(r[0], r[1], r[2]) for r in got(col.collocations(docs, 4, top=2))] == [("de", 1, "z b"), ("en", 1, "z b"), ("en", 2, "z2 b3")]
    assert got(col.collocations(docs, 4, top=2)) == brute(data, 4, top=2)


def test_tokens():
    words, piece = col.tokens(b"A bC,\td!!e\xc3\x89 f\x0cg")
    assert words.to_pylist() == [b"a", b"bc", b"d", b"e\xc3\x89", b"f", b"g"]
    assert piece.tolist() == [0, 0, 1, 3, 3, 4]
    assert [len(x) for x in map(np.asarray, col.tokens(b" ,"))] == [0, 0]


def test_edge_rows_and_empty_table(spark):
    data = [(r["lang"], r["text"]) for r in rows(edge_docs(spark))]
    assert got(col.collocations(edge_docs(spark), 3)) == brute(data, 3)
    assert got(col.collocations(empty_docs(spark))) == []
    assert got(col.collocations(edge_docs(spark), 10 ** 6)) == []


def test_query_on_the_table(spark):
    from shardwright.llm.queries import QUERIES
    data = [(r["lang"], r["text"]) for r in documents(spark).collect()]
    assert got(QUERIES["op13_collocations"](spark, "/root/testdata/sf0.001")) == brute(data, 100)
