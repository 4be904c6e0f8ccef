"""Removes every word of passages that recur: 35-word windows found anywhere else, all occurrences.

1. Each document is cut into spans of consecutive windows with one anchor
   (:mod:`anchors`); equal windows have equal anchor keys. Spans whose key
   occurs once hold no recurring window.
2. The text of every distinct span under a recurring key is cut out once, with
   the number of its occurrences, and dealt to shards by its key. A shard
   confirms recurring passages word by word (runs of windows found twice or
   more), compiles an Aho-Corasick automaton over word numbers from them, and
   streams its spans through the automaton to locate every occurrence.
3. The places found are carried to every occurrence of the span and the words
   they cover are removed.

Shards are bounded: about ``SHARD`` spans of at most 2 * window - k words. A key
with more than ``BIG_KEY`` distinct spans (a common phrase amid different words)
is split into its single windows, which are counted by content, combined before
the shuffle, and then dealt to shards as spans of one window.

Defined cases: a null text has no words; documents are told apart by doc_id and
text, rows equal in both repeat each other (their windows recur); null ids are
carried; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import spans
from .common import materialise, text_key, text_of, written

WINDOW = 35
GRAM = 8
SHARD = 8192
BIG_KEY = 2048
_CACHE = 1 << 20
ROW = ["id", "th"]


class _Words(dict):
    """word -> 64-bit hash, for one task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def rows_of(docs: DataFrame) -> DataFrame:
    """id and th tell documents apart (null ids come last, with their own th); text is never null."""
    text = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                       text_key(F.col("doc_id"), text).alias("th"), text.alias("text"))


def _spans(window: int, k: int):
    def run(batches):
        words = _Words()
        for b in batches:
            out = [[] for _ in range(6)]
            for doc, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                tokens = text.as_py().encode().split()
                if len(tokens) < window:
                    continue
                symbols = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
                key, first, last, anchor, hashed = spans(symbols, k, window)
                content = hashed.ranges(first, last + window) + (anchor - first).astype(np.uint64)
                for column, values in zip(out, (np.full(len(key), doc, np.int64), np.full(len(key), th, np.int64), first.astype(np.int32),
                                                last.astype(np.int32), key.view(np.int64), content.view(np.int64))):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                                 names=["id", "th", "first", "last", "key", "content"])
    return run


def _passages(window: int):
    """(id, th, text, places) -> the words of each place: n times found, or, if ``big``, its windows."""
    names = ["key", "content", "at", "wkey", "n", "words"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        words, rows = _Words(), []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for text, places in zip(b.column(0), b.column(1)):
                tokens = text.as_py().encode().split()
                for p in places.as_py():
                    first, last = p["first"], p["last"]
                    if not p["big"]:
                        rows.append((p["key"], p["content"], 0, None, p["n"], b" ".join(tokens[first:last + window])))
                        continue
                    for s in range(first, last + 1):
                        part = tokens[s:s + window]
                        digest = np.fromiter(map(words.__getitem__, part), np.uint64, window).tobytes()
                        rows.append((p["key"], p["content"], s - first, xxhash.xxh64_intdigest(digest, 1) - (1 << 63), p["n"], b" ".join(part)))
                if len(rows) > 1 << 16:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()
    return run


def locate(spans_words: list[bytes], counts: list[int], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Of each span, the word ranges that recurring passages cover. A span stands for ``counts`` occurrences."""
    number: dict[bytes, int] = {}
    sequences = [np.array([number.setdefault(w, len(number)) for w in s.split(b" ")], "<u4") for s in spans_words]
    found: Counter = Counter()
    raw = [s.tobytes() for s in sequences]
    for r, n in zip(raw, counts):
        for a in range(0, len(r) - 4 * window + 1, 4):
            found[r[a:a + 4 * window]] += n
    # Confirmed passages: maximal runs of windows that occur twice or more.
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for r, s in zip(raw, sequences):
        start = None
        for a in range(len(s) - window + 2):
            if a <= len(s) - window and found[r[4 * a:4 * (a + window)]] > 1:
                start = a if start is None else start
            elif start is not None:
                automaton.add_word(tuple(s[start:a + window - 1].tolist()), a + window - 1 - start)
                start = None
    if not len(automaton):
        return [[] for _ in sequences]
    automaton.make_automaton()
    out = []
    for s in sequences:
        cover: list[list[int]] = []
        for end, length in automaton.iter(tuple(s.tolist())):
            a, b = end + 1 - length, end + 1
            while cover and cover[-1][1] >= a:
                last = cover.pop()
                a, b = min(a, last[0]), max(b, last[1])
            cover.append([a, b])
        out.append([(a, b) for a, b in cover])
    return out


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        places = locate(table.column("words").to_pylist(), table.column("n").to_pylist(), window)
        rows = [(k, c, a, b) for k, c, r in zip(table.column("key").to_pylist(), table.column("content").to_pylist(), places) for a, b in r]
        cols = list(zip(*rows)) or [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["key", "content", "a", "b"])
    return run


def repeated(rows: DataFrame, window: int = WINDOW, k: int = GRAM, shard: int = SHARD, big_key: int = BIG_KEY) -> DataFrame:
    """(id, th, places): the word ranges [a, b) of each document that recurring windows cover."""
    all_spans = written(rows.select("id", "th", "text").mapInArrow(
        _spans(window, k), "id long, th long, first int, last int, key long, content long"), "phrase-spans")
    recurring = all_spans.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    found = written(all_spans.join(recurring, "key", "left_semi"), "phrase-recurring")
    distinct = found.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "first", "last")).alias("s"))
    distinct = materialise(distinct)
    big = distinct.groupBy("key").agg((F.count(F.lit(1)) > big_key).alias("big"))
    wanted = (distinct.join(big, "key").select("s.*", "key", "content", "n", "big")
              .groupBy("id", "th").agg(F.collect_list(F.struct("first", "last", "key", "content", "n", "big")).alias("places")))
    # Rows equal in id and text hold the same words: one of them is enough.
    passages = written(rows.join(wanted, ROW).dropDuplicates(ROW).select("text", "places").mapInArrow(
        _passages(window), "key long, content long, at int, wkey long, n long, words binary"), "phrase-passages")
    alone = passages.where("wkey IS NULL").select("key", "content", "n", "words")
    windows = passages.where("wkey IS NOT NULL")
    counted = windows.groupBy("wkey").agg(F.sum("n").alias("n"), F.first("words").alias("words"))
    dealt = alone.union(counted.select(F.col("wkey").alias("key"), F.col("wkey").alias("content"), "n", "words"))
    shards = max(1, -(-distinct.count() // shard))
    hits = materialise(dealt.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
                       .groupBy("shard").applyInArrow(_shard(window), "key long, content long, a int, b int"))
    of_windows = (windows.select("key", "content", "at", "wkey")
                  .join(hits.select(F.col("key").alias("wkey"), "a", "b"), "wkey")
                  .select("key", "content", (F.col("a") + F.col("at")).alias("a"), (F.col("b") + F.col("at")).alias("b")))
    places = found.join(hits.union(of_windows), ["key", "content"])
    return (places.select("id", "th", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
            .groupBy("id", "th").agg(F.collect_set(F.struct("a", "b")).alias("places")))


def _removal(batches):
    for b in batches:
        out = {"doc_id": b.column(0), "n_words": [], "n_removed": [], "kept": []}
        for text, places in zip(b.column(1), b.column(2)):
            tokens = text.as_py().encode().split()
            gone = np.zeros(len(tokens) + 1, np.int64)
            for p in places.as_py() or ():
                gone[p["a"]] += 1
                gone[p["b"]] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            kept = tokens if not gone.any() else [tokens[i] for i in np.flatnonzero(~gone)]
            out["n_words"].append(len(tokens))
            out["n_removed"].append(len(tokens) - len(kept))
            out["kept"].append(b" ".join(kept).decode())
        yield pa.RecordBatch.from_arrays(
            [out["doc_id"], pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
             pa.array(out["kept"], pa.string())], names=list(out))


def remove_repeated(docs: DataFrame, window: int = WINDOW, k: int = GRAM, **bounds) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``, the words that stay joined by one space."""
    rows = rows_of(docs)
    places = repeated(rows, window, k, **bounds)
    return (rows.join(places, ROW, "left").select("doc_id", "text", "places")
            .mapInArrow(_removal, "doc_id long, n_words long, n_removed long, kept string"))
