"""Phrase collocations from sorted count streams.

*Counts.* Phrases are counted by length, one pass over the texts each, and combined by
Spark. A phrase of k words can only be frequent if its first and its last k - 1 words
are; so a pass skips occurrences for which either is missing in a bitmap of the
frequent phrases of the pass before. The bitmap has ``BITS`` bits at most, whatever the
corpus: a fuller one lets more rows through, and the counts, which are by the words
themselves, stay the same.

*Streams.* The frequent phrases, single words included, are kept as two streams over range
partitions: in prefix order (by their words from the first on) and in suffix order (by
their words from the last on). All prefixes of a phrase stand before it in prefix order
with nothing but their extensions between, so one pass with a stack of the open prefixes
reads off the counts of every left part; at the same time a prefix learns whether some
extension by one word occurs as often. The suffix stream gives right parts and extensions
to the left the same way. What is open at the end of a partition is handed to the next
(as many rows as a phrase has words). Both streams, put into prefix order again, are
merged in lockstep: equal phrases are neighbours. Nothing is looked up by hash.

Extensions by one word decide whether a phrase is held by any longer one as often: each
phrase between the two is as frequent as both.

The empty phrase stands for all words of a language; it is first in both streams.

Defined cases: a null text is empty; a null lang is ``und``; ids play no part and repeated
rows count each; ties in score and count go to the lesser phrase in byte order; an empty
table gives an empty one; other columns are not carried. Long texts are cut at piece
ends into chunks of about ``CHUNK`` bytes; one piece is held whole, at some 40 bytes a
byte. Arithmetic is in unbounded integers.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_of, written

LONGEST = 5
LEAST = 100
TOP = 2000
CHUNK = 1 << 22
#: Bits of a bitmap: at least 16 for each frequent phrase, within these bounds.
FEWEST_BITS, BITS = 16, 27
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
COUNTED = "lang string, phrase string, n long"
SCANNED = "lang string, words array<string>, f long, parts array<long>, extended boolean"


def _chunks(texts):
    """The texts joined by piece ends, in chunks cut at piece ends."""
    held, size = [], 0
    for t in texts:
        start = 0
        while len(t) - start > CHUNK:
            cut = _BREAK.search(t, start + CHUNK)
            if cut is None:
                break
            yield t[start:cut.end()]
            start = cut.end()
        held.append(t[start:] if start else t)
        size += len(held[-1])
        if size >= CHUNK:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def tokens(chunk: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a chunk, lower-case, and the number of each one's piece."""
    raw = np.frombuffer(chunk, np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("a piece of more than 2^31 bytes")
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_LOWER[raw[inside]])])
    return words, np.cumsum(kind == 2, dtype=np.int64)[starts]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def hashes(words: pa.Array) -> np.ndarray:
    """64 bits for each word, for bitmaps only."""
    words = words.cast(pa.binary())
    if not len(words):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    offsets -= offsets[0]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    power = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return _mix(np.add.reduceat(data * power[place], offsets[:-1]))


def _start(lang: str) -> np.uint64:
    return hashes(pa.array([b"\x00" + lang.encode()], pa.binary()))[0]


def _then(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + word)


class Bitmap:
    """Frequent phrases of one length; may hold others besides."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, h: np.ndarray) -> np.ndarray:
        i = h >> np.uint64(64 - self.bits)
        return (self.data[i >> np.uint64(6)] >> (i & np.uint64(63))) & np.uint64(1) == 1


def phrases(chunk: bytes, lang: str, k: int, known: Bitmap | None) -> tuple[pa.Array, np.ndarray, int]:
    """The different phrases of ``k`` words of a chunk that may be frequent, their counts, and the number of words."""
    words, piece = tokens(chunk)
    coded = words.dictionary_encode()
    ids, table = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if k == 1:
        return table, np.bincount(ids, minlength=len(table)), len(ids)
    if len(ids) < k:
        return table[:0], np.empty(0, np.int64), len(ids)
    each = hashes(table)[ids]
    last = len(ids) - (k - 1)  # places where a phrase of k - 1 words may start, less one
    h = np.full(last + 1, _start(lang))
    for j in range(k - 1):
        h = _then(h, each[j:j + last + 1])
    found = known.has(h)
    at = np.flatnonzero(found[:-1] & found[1:] & (piece[:last] == piece[k - 1:]))
    key, first = ids[at], at
    for j in range(1, k):  # numbers of the different phrases of j + 1 words
        _, first, key = np.unique(key * len(table) + ids[at + j], return_index=True, return_inverse=True)
    counts = np.bincount(key, minlength=len(first))
    parts = [table.take(pa.array(ids[at[first] + j])) for j in range(k)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), counts, len(ids)


def counted(docs: DataFrame, k: int, known) -> DataFrame:
    """lang, phrase, n: partial counts; for single words also those of the empty phrase. ``known`` is a broadcast bitmap."""
    def run(batches):
        bitmap = known.value if known else None
        for b in batches:
            langs = b.column(0).dictionary_encode()
            code = langs.indices.to_numpy()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                texts = (b.column(1)[int(r)].as_py() for r in np.flatnonzero(code == i))
                for chunk in _chunks(texts):
                    found, counts, n = phrases(chunk, lang, k, bitmap)
                    if k == 1 and n:
                        found, counts = pa.concat_arrays([found, pa.array([b""], pa.binary())]), np.append(counts, n)
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(found), pa.string()), found.cast(pa.string()), pa.array(counts, pa.int64())],
                            names=["lang", "phrase", "n"])

    return docs.mapInArrow(run, COUNTED)


def bitmap_of(frequent: DataFrame, most: int = BITS) -> Bitmap:
    """The bitmap of a table of phrases: 2^``most`` bits at most, put together by Spark."""
    n = frequent.count()
    bits = min(most, max(FEWEST_BITS, (16 * n - 1).bit_length() if n else 0))

    def run(batches):
        for b in batches:
            langs, lists = b.column(0).to_pylist(), [p.split(b" ") for p in b.column(1).to_pylist()]
            if not lists:
                continue
            start = {x: _start(x) for x in set(langs)}
            h = np.array([start[x] for x in langs], np.uint64)
            for words in zip(*lists):
                h = _then(h, hashes(pa.array(words, pa.binary())))
            i = h >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays([pa.array((i >> np.uint64(6)).astype(np.int64)),
                                              pa.array((np.uint64(1) << (i & np.uint64(63))).view(np.int64))], names=["slot", "mask"])

    slots = (frequent.select("lang", F.col("phrase").cast("binary")).mapInArrow(run, "slot long, mask long")
             .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())
    data = np.zeros(1 << (bits - 6), np.uint64)
    data[slots.column("slot").to_numpy()] = slots.column("mask").to_numpy().view(np.uint64)
    return Bitmap(bits, data)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """lang, words, f of all phrases of 1 to ``longest`` words that occur ``least`` times, and of the empty phrase."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("binary").alias("text"))
    known, tables = None, []
    for k in range(1, longest + 1):
        sums = counted(texts, k, known).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        tables.append(written(sums.where((F.col("f") >= least) | (F.col("phrase") == "")), f"phrases-{k}"))
        last = tables[-1].where(F.col("phrase") != "")
        if k == longest or last.isEmpty():
            break
        known = spark.sparkContext.broadcast(bitmap_of(last, bits))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    return every.select("lang", words.alias("words"), "f")


def _rows(batches):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("lang", "words", "f", "part")))


def _ends(stream: DataFrame) -> dict[int, list]:
    """For each partition what is open at its start: (lang, words, f) of the prefixes of the last phrase before it."""
    def run(batches):
        chain: list = []
        for row in _rows(batches):
            while chain and not _begins(chain[-1], row):
                chain.pop()
            chain.append(row)
        if chain:
            yield pa.RecordBatch.from_pylist([{"part": part, "lang": x, "words": w, "f": f} for x, w, f, part in chain],
                                             pa.schema([("part", pa.int32()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64())]))

    ends: dict[int, list] = {}
    for r in stream.mapInArrow(run, "part int, lang string, words array<string>, f long").collect():
        ends.setdefault(r["part"], []).append((r["lang"], r["words"], r["f"]))
    opening, chain = {}, []
    for part in sorted(ends):
        opening[part] = chain
        own = sorted(ends[part], key=lambda x: len(x[1]))
        chain = [x for x in chain if len(x[1]) < len(own[0][1]) and _begins(x, own[0])] + own
    return opening


def _begins(prefix: tuple, row: tuple) -> bool:
    return prefix[0] == row[0] and prefix[1] == row[1][:len(prefix[1])]


def scanned(table: DataFrame) -> DataFrame:
    """lang, words, f, parts (the counts of the first 0, 1, ... words) and extended (some phrase of one word more is as
    frequent). A phrase whose extensions go on in a later partition may have a further row, with extended alone."""
    stream = materialise(table.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
                         .withColumn("part", F.spark_partition_id()))
    opening = stream.sparkSession.sparkContext.broadcast(_ends(stream))
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()), ("parts", pa.list_(pa.int64())),
                        ("extended", pa.bool_())])

    def run(batches):
        # open prefixes: row, counts of its own prefixes (None if the row is of an earlier partition), extended
        chain, begun = [], False
        out: list[dict] = []

        def close(entry):
            (lang, words, f, *_), parts, extended = entry
            if parts is not None:
                out.append({"lang": lang, "words": words, "f": f, "parts": parts, "extended": extended})
            elif extended:
                out.append({"lang": lang, "words": words, "f": None, "parts": None, "extended": True})

        for row in _rows(batches):
            if not begun:
                chain, begun = [[x, None, False] for x in opening.value[row[3]]], True
            while chain and not _begins(chain[-1][0], row):
                close(chain.pop())
            if chain and len(chain[-1][0][1]) == len(row[1]) - 1 and chain[-1][0][2] == row[2]:
                chain[-1][2] = True
            chain.append([row, [e[0][2] for e in chain], False])
            if len(out) >= 8192:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        while chain:
            close(chain.pop())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return stream.mapInArrow(run, SCANNED)


def scored(frequent: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the frequent phrases of two words or more that no longer one holds as often."""
    back = frequent.withColumn("words", F.reverse("words"))
    left = scanned(frequent).withColumn("side", F.lit(0))
    right = scanned(back).withColumn("words", F.reverse("words")).withColumn("side", F.lit(1))
    both = left.unionByName(right).where(F.size("words") >= 2)
    both = both.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string())] + [(c, pa.int64()) for c in ("a", "l", "r", "n", "score")])

    def result(lang, words, rows):
        """The rows of both streams for one phrase."""
        if any(extended for _, _, extended, _ in rows):
            return None
        (a, lefts), = ((f, parts) for f, parts, _, side in rows if side == 0 and parts is not None)
        rights, = (parts for _, parts, _, side in rows if side == 1 and parts is not None)
        n = lefts[0]
        score, k = min((1000 * a * n // (lefts[k] * rights[len(words) - k]), k) for k in range(1, len(words)))
        return {"lang": lang, "phrase": " ".join(words), "a": a, "l": lefts[k], "r": rights[len(words) - k], "n": n, "score": score}

    def merge(batches):
        out, key, rows = [], None, []
        for b in batches:
            for lang, words, *row in zip(*(b.column(c).to_pylist() for c in ("lang", "words", "f", "parts", "extended", "side"))):
                if (lang, words) != key:
                    if rows and (r := result(*key, rows)):
                        out.append(r)
                    key, rows = (lang, words), []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if rows and (r := result(*key, rows)):
            yield pa.RecordBatch.from_pylist([r], schema)

    return both.mapInArrow(merge, "lang string, phrase string, a long, l long, r long, n long, score long")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, bits: int = BITS) -> DataFrame:
    """The first ``top`` phrases of each language by score."""
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = scored(frequent_phrases(docs, least, longest, bits)).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
