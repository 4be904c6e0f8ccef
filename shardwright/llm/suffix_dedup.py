"""Removes every byte covered by a 100-byte string that also starts earlier.

1. Each document is cut into spans of consecutive windows with one anchor
   (:mod:`anchors`); equal windows have equal anchor keys, so a span whose key
   occurs once is left alone.
2. Of equal spans (same key, same content) all but the first lose every window.
3. The first ones of keys with several contents are cut out of their documents
   and dealt to shards by key. A shard concatenates them, sorts all suffixes by
   linear grouping (:mod:`suffix_array`), and in every run of suffixes that
   agree in 100 bytes all but the earliest lose their window.
4. The bytes of lost windows are taken out of the documents.

Before a shard is sorted its spans are cut to the runs of windows whose hash
occurs twice in it (the others can't recur), and equal runs stand in it once, for
their first occurrence. Shards are bounded: about ``SHARD`` spans of
at most 2 * window - k bytes. A key with more than ``BIG_KEY`` contents (a common
phrase amid different text) is split into its windows, whose first occurrences
are found by content, combined before the shuffle.

Defined cases: a null text is empty; the order of documents is doc_id (null
last), then text hash; rows equal in both are one document for that order, so
each keeps what the first keeps; an empty table gives an empty result; kept
bytes need not be valid UTF-8; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Hashed, mix, spans
from .common import materialise, text_key, text_of, written
from .suffix_array import suffix_array

WINDOW = 100
GRAM = 32
SHARD = 4096
BLOCK = 128
BIG_KEY = 2048
ROW = ["id", "th"]
#: A 64-bit symbol for each byte.
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def rows_of(docs: DataFrame) -> DataFrame:
    """id (null ids last) and th order the documents and tell them apart; text is never null."""
    text = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                       text_key(F.col("doc_id"), text).alias("th"), text.alias("text"))


def _symbols(raw: bytes) -> np.ndarray:
    return _SYMBOL[np.frombuffer(raw, np.uint8)]


def _spans(window: int, k: int, keys_only: bool):
    names = ["key"] if keys_only else ["key", "content", "id", "th", "first", "last"]

    def run(batches):
        for b in batches:
            out, held = [[] for _ in names], 0
            for doc, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                found = spans(_symbols(text.as_py().encode()), k, window)
                if found is None:
                    continue
                key, first, last, anchor, hashed = found
                columns = [key.view(np.int64)]
                if not keys_only:
                    content = hashed.ranges(first, last + window) + (anchor - first).astype(np.uint64)
                    columns += [content.view(np.int64), np.full(len(key), doc, np.int64), np.full(len(key), th, np.int64),
                                first.astype(np.int32), last.astype(np.int32)]
                for column, values in zip(out, columns):
                    column.append(values)
                held += len(key)
                if held > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)
                    out, held = [[] for _ in names], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)
    return run


def _cut_out(window: int):
    """(id, th, text, places) -> the bytes of each place, or of its windows if ``big``."""
    names = ["key", "content", "id", "th", "first", "at", "wkey", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        for b in batches:
            rows, held = [], 0
            for doc, th, text, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                raw = text.as_py().encode()
                for p in places.as_py():
                    first, last = p["first"], p["last"]
                    head = (p["key"], p["content"], doc, th, first)
                    if p["big"]:
                        rows += [(*head, s - first, xxhash.xxh64_intdigest(raw[s:s + window]) - (1 << 63), None) for s in range(first, last + 1)]
                    else:
                        rows.append((*head, 0, None, raw[first:last + window]))
                if len(rows) > 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


def later_windows(pieces: list[bytes], order: list[tuple], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Of each piece, the ranges [a, b) of window starts that also start in a piece earlier by ``order`` (id, th, first).

    Windows of one piece are at different places of one document.
    """
    # Cut each piece to its runs of windows whose hash occurs twice; the others can't recur.
    hashes = [Hashed(_symbols(p)).grams(window) for p in pieces]
    _, inverse, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    lost: list[list[tuple[int, int]]] = [[] for _ in pieces]
    firsts: dict[bytes, tuple] = {}  # each different run: its first occurrence
    at = 0
    for i, (p, h) in enumerate(zip(pieces, hashes)):
        edges = np.flatnonzero(np.diff(np.concatenate(([False], again[at:at + len(h)], [False])))).tolist()
        at += len(h)
        for a, b in zip(edges[::2], edges[1::2]):
            run = p[a:b + window - 1]
            here = (*order[i][:2], order[i][2] + a, i, a, b)
            known = firsts.get(run)
            if known is None or here < known:
                firsts[run], here = here, known
            if here and here[:3] != firsts[run][:3]:
                lost[here[3]].append(here[4:])
    if not firsts:
        return lost
    # Suffixes of all runs: symbol 1 ends a run, 0 the text.
    runs = list(firsts)
    lengths = np.array([len(r) + 1 for r in runs])
    string = np.frombuffer(b"\0".join(runs) + b"\0\0", np.uint8).astype(np.int16) + 2
    ends = np.cumsum(lengths)
    string[ends - 1] = 1
    string[-1] = 0
    owner = np.repeat(np.arange(len(runs)), lengths)
    offset = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    is_start = (offset <= np.repeat(lengths, lengths) - 1 - window).tolist() + [False]
    owner, offset = owner.tolist(), offset.tolist()
    place = list(firsts.values())

    def settle(group):
        if len(group) > 1:
            spots = [(*place[owner[s]][:2], place[owner[s]][2] + offset[s]) for s in group]
            first = min(spots)
            for s, spot in zip(group, spots):
                if spot != first:
                    i, a = place[owner[s]][3:5]
                    lost[i].append((a + offset[s], a + offset[s] + 1))

    group, last = [], b""
    for s in suffix_array(string):
        if is_start[s]:
            now = runs[owner[s]][offset[s]:offset[s] + window]
            if now != last:
                settle(group)
                group, last = [], now
            group.append(s)
    settle(group)
    return lost


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        order = list(zip(*(table.column(c).to_pylist() for c in ("id", "th", "first"))))
        pieces, key = table.column("bytes").to_pylist(), table.column("key").to_numpy()
        # Equal windows have equal keys, so whole keys are sorted in blocks that stay in a processor's cache.
        heads = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key)).tolist()
        lost, a = [], 0
        for b in heads[1:]:
            if b - a >= BLOCK or b == len(key):
                lost += later_windows(pieces[a:b], order[a:b], window)
                a = b
        out = {"id": [], "th": [], "a": [], "b": []}
        for (doc, th, first), ranges in zip(order, lost):
            whole: list[list[int]] = []
            for a, b in sorted(ranges):
                if whole and a <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], b)
                else:
                    whole.append([a, b])
            for a, b in whole:
                for name, value in zip(out, (doc, th, first + a, first + b - 1 + window)):
                    out[name].append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(c, t) for c, t in zip(out.values(), types)], names=list(out))
    return run


def lost_ranges(rows: DataFrame, window: int = WINDOW, k: int = GRAM, shard: int = SHARD, big_key: int = BIG_KEY) -> DataFrame:
    """(id, th, places): the byte ranges [a, b) of each document that earlier strings repeat."""
    text = rows.select("id", "th", "text")
    keys = text.mapInArrow(_spans(window, k, True), "key long")
    recurring = materialise(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"))
    found = text.mapInArrow(_spans(window, k, False), "key long, content long, id long, th long, first int, last int")
    found = written(found.join(recurring, "key", "left_semi"), "substring-spans")
    distinct = materialise(found.groupBy("key", "content").agg(
        F.min(F.struct("id", "th", "first", "last")).alias("s"), F.count(F.lit(1)).alias("n")))
    # Equal spans: the first stays.
    several = distinct.where("n > 1").select("key", "content", F.col("s.id").alias("i0"), F.col("s.th").alias("t0"), F.col("s.first").alias("f0"))
    copies = (found.join(several, ["key", "content"]).where("id <> i0 OR th <> t0 OR first <> f0")
              .select("id", "th", F.col("first").alias("a"), (F.col("last") + window).alias("b")))
    # Different spans of a key.
    mixed = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key", (F.col("c") > big_key).alias("big"))
    wanted = (distinct.join(mixed, "key").select("s.*", "key", "content", "big")
              .groupBy(*ROW).agg(F.collect_list(F.struct("first", "last", "key", "content", "big")).alias("places")))
    n = distinct.join(mixed.where("NOT big"), "key").count()
    pieces = text.join(wanted, ROW).dropDuplicates(ROW).select("id", "th", "text", "places").mapInArrow(
        _cut_out(window), "key long, content long, id long, th long, first int, at int, wkey long, bytes binary")
    pieces = written(pieces, "substring-pieces")
    shards = max(1, -(-n // shard))
    ranges = (pieces.where("wkey IS NULL").select("key", "id", "th", "first", "bytes")
              .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
              .groupBy("shard").applyInArrow(_shard(window), "id long, th long, a int, b int"))
    windows = pieces.where("wkey IS NOT NULL").select("wkey", "id", "th", (F.col("first") + F.col("at")).alias("a"))
    earliest = windows.groupBy("wkey").agg(F.min(F.struct("id", "th", "a")).alias("e"))
    single = (windows.join(earliest, "wkey").where(F.struct("id", "th", "a") != F.col("e"))
              .select("id", "th", "a", (F.col("a") + window).alias("b")))
    return (copies.union(ranges).union(single)
            .groupBy(*ROW).agg(F.collect_list(F.struct("a", "b")).alias("places")))


def _remove(batches):
    for b in batches:
        out = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_bytes"], pa.int64()),
                 pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(out["kept"], pa.binary())], names=list(out))

        held = 0
        for doc, text, places in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            raw = text.as_py().encode()
            runs: list[list[int]] = []
            for a, e in sorted((p["a"], p["b"]) for p in places.as_py() or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], e)
                else:
                    runs.append([a, e])
            cuts = [0, *(x for r in runs for x in r), len(raw)]
            out["doc_id"].append(doc)
            out["n_bytes"].append(len(raw))
            out["spans"].append([{"start": a, "end": e} for a, e in runs])
            out["kept"].append(b"".join(raw[a:e] for a, e in zip(cuts[::2], cuts[1::2])))
            held += len(raw)
            if held > 1 << 24:
                yield batch()
                out, held = {name: [] for name in out}, 0
        yield batch()


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM, **bounds) -> DataFrame:
    """doc_id, n_bytes, spans (the maximal removed runs) and kept (the bytes that stay)."""
    rows = rows_of(docs)
    places = lost_ranges(rows, window, k, **bounds)
    return rows.join(places, ROW, "left").select("doc_id", "text", "places").mapInArrow(
        _remove, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
