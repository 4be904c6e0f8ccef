import random
import time

import regex
import pytest
import xxhash
from pyspark.sql import functions as F

from shardwright.llm import fuzzy_lines

from .helpers import documents, edge_docs, edge_rows, empty_docs, key, rows


def norm(line):
    low = line.lower()
    plain = regex.sub(r"[^\p{L}\p{N}]+", " ", low).strip(" ")
    return plain or low.strip(" \t\n\x0b\x0c\r")


def simhash(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(text.split(" "))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(docs, order, max_bits=3, similarity=0.8):
    """docs: (doc_id, text) in the operator's document order -> (doc_id, n_lines, n_removed, kept)."""
    nodes = {}
    for _, t in docs:
        for line in (t or "").split("\n"):
            if norm(line):
                nodes.setdefault(norm(line), len(nodes))
    names = list(nodes)
    fp = [simhash(x) for x in names]
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= max_bits and find(i) != find(j):
                a, b = names[i], names[j]
                if distance(a, b) <= (1 - similarity) * max(len(a), len(b)) + 1e-9:
                    root[find(i)] = find(j)
    seen, out = {}, []
    for k in sorted(range(len(docs)), key=order):
        d, t = docs[k]
        lines, kept = (t or "").split("\n"), []
        for pos, line in enumerate(lines):
            n = norm(line)
            c = find(nodes[n]) if n else None
            if not n or seen.setdefault(c, (d, t, pos)) == (d, t, pos):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def got(df):
    return [(r["doc_id"], r["n_lines"], r["n_removed"], r["kept"]) for r in df.collect()]


def test_matches_all_pairs(spark):
    df = documents(spark)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = plain(docs, lambda k: docs[k][0])
    assert key(got(fuzzy_lines.deduped(df))) == key(want)
    assert sum(w[2] for w in want) > 20


NEAR = ["The quick brown fox jumps over the lazy dog near the river bank today", "the quick, brown fox jumps over the lazy dog near the river bank TODAY!",
        "the quick brown fox jumps over the lazy dog near the river banks today", "Quite another line of words that is here", "###", "### ", "...", "", "  "]


@pytest.mark.parametrize("bits,similarity", [(3, 0.8), (12, 0.8), (12, 0.97)])
def test_near_lines(spark, bits, similarity):
    texts = [(i, "\n".join(NEAR[(i * 3 + j) % len(NEAR)] for j in range(i % 5 + 1))) for i in range(20)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain(texts, lambda k: texts[k][0], bits, similarity)
    assert key(got(fuzzy_lines.deduped(df, bits, similarity))) == key(want)


def test_edges(spark):
    df = edge_docs(spark)
    th = {(r["doc_id"], r["text"]): (r["id"], r["th"]) for r in fuzzy_lines.identified(df).collect()}
    docs = [(r[0], r[1]) for r in edge_rows()]
    assert key(got(fuzzy_lines.deduped(df))) == key(plain(docs, lambda k: th[docs[k]]))
    kept = fuzzy_lines.without_repeats(df)
    assert kept.columns == df.columns and kept.count() == df.count()
    assert key(r["text"] or "" for r in kept.collect()) == key(x[3] for x in plain(docs, lambda k: th[docs[k]]))


def test_empty(spark):
    assert rows(fuzzy_lines.deduped(empty_docs(spark))) == []
    assert rows(fuzzy_lines.without_repeats(empty_docs(spark))) == []


def test_masks_follow_the_number_of_hashes():
    for n in (1, 10 ** 6, 10 ** 9, 10 ** 12):
        masks = fuzzy_lines.key_masks(n)
        assert all(any((m & bits) == 0 for m in masks) for bits in (0, 7, 1 << 63 | 1 << 20 | 1, 1 << 16 | 1 << 32 | 1 << 48))


def test_random_hashes_seldom_meet_two_others():
    for n in (1000, 65535, 65536, 126_678, 33_000_000, 120_000_000):
        fewest = min(m.bit_count() for m in fuzzy_lines.key_masks(n))
        assert n < 1 << fewest


def test_hashes_of_lines_of_any_number_of_words(spark):
    texts = [" ".join(f"Wort{(i * j) % 29}é" for j in range(i)) + ("" if i % 2 else " -- x  ?!") for i in range(1, 60)] + ["7", "# #", "a a a a a a a a"]
    df = fuzzy_lines.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = {i: (len(norm(t)), simhash(norm(t)) - (simhash(norm(t)) >> 63 << 64)) for i, t in enumerate(texts)}
    for rows_of in (df, df.union(df), df.union(df).union(df)):  # repeated rows are one document
        hashed = fuzzy_lines.hashed_lines(rows_of.select("id", "th", "text")).collect()
        assert {r["id"]: (r["len"], r["fp"]) for r in hashed} == want and len(hashed) == len(want)


def test_single_spaces_and_other_runs(spark):
    lines = ["a b", " a  b ", "a-b", "a - b", "--a b--", "Ä b", "a\tb", "a_b   c", "  ", "a b ", "1٠ ²x"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(fuzzy_lines.plain("line")).collect()] == [regex.sub(r"[^\p{L}\p{N}]+", " ", x.lower()).strip(" ") for x in lines]


def test_alike_is_the_edit_similarity(spark):
    rng = random.Random(5)
    pairs = []
    for i in range(60):
        a = "".join(rng.choice("abcdeé ") for _ in range(rng.choice((3, 100, 129, 300, 520))))
        b = list(a)
        for _ in range(rng.randrange(1 + len(a) // 3)):
            b[(at := rng.randrange(len(b))):at + rng.randrange(2)] = rng.choice(("", "x", "yz"))
        b = "".join(b)
        pairs.append((a, b if i % 3 else b[len(b) // 10:] + b[:len(b) // 20]))  # shifted: pieces are far apart
    want = [distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in pairs]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    assert [r[0] for r in df.select(fuzzy_lines.alike(F.col("a"), F.col("b"))).collect()] == want
    assert 10 < sum(want) < 50


def test_long_lines_are_compared_piece_by_piece(spark):
    a = "".join(chr(97 + (i * i // 7 + i) % 23) for i in range(150_000))
    b = "".join("z" if i % 50 == 0 else c for i, c in enumerate(a))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    began = time.monotonic()
    assert df.select(fuzzy_lines.alike(F.col("a"), F.col("b"))).first()[0]
    assert time.monotonic() - began < 15  # whole middles take minutes
