"""Best-fit decreasing packing of tokenised documents into fixed-length sequences.

A document's ids end with a separator; only documents longer than a sequence
are cut, the remainder first. Pieces are packed in order of decreasing length,
each into the open bin with the least room that still holds it. Pieces of one
length are interchangeable, so the packing is computed from the histogram of
lengths (at most ``capacity`` rows, whatever the corpus): a segment tree over
remaining capacities finds the tightest class of open bins in logarithmic time,
and a whole run of equal pieces is placed into a run of equal bins at once. The
outcome is that of the piece-by-piece algorithm. Every piece then looks up its
place by its rank among the pieces of its length.

Ids: those of ``tokenizers`` with ``byte_bpe_50k.json`` and no special tokens added,
so a literal special token in a text is its one id; computed by tiktoken (three to
four times faster here), and tests hold them against ``tokenizers``.

Defined cases: a null text is empty (one piece, the separator); repeated rows
are packed separately; null ids are carried; an empty table packs into nothing;
other input columns are not carried.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bpe import encode_text
from .common import hash32, materialise, ranked, text_of

CAPACITY = 2048
SEPARATOR = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A tiktoken encoding with the vocabulary of a byte-level ``tokenizers`` file, whose ids are its merge order."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # Byte-level vocabularies write each byte as a printable character: itself where it is one, else 256 onward.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. ``tokenizer`` is a path on the workers."""
    def cut(batches):
        enc = encoder(tokenizer or default_tokenizer())
        for b in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode_text(enc, text.as_py()), SEPARATOR], "<u4")
                start, end, piece = 0, len(ids) % capacity or capacity, 0
                while start < len(ids):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(end - start)
                    out["ids_crc32"].append(zlib.crc32(ids[start:end].tobytes()))
                    start, end, piece = end, end + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int64()), pa.array(out["ids_crc32"], pa.int64())], names=list(out))

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(cut, PIECES)


class Capacities:
    """Segment tree over remaining capacities 0..capacity; a leaf holds the runs of open bins with that much room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]
        self.open = [False] * (2 * self.size)

    def _mark(self, room: int) -> None:
        i = room + self.size
        self.open[i] = bool(self.runs[room])
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def put(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.runs[room].append((first, n))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, need: int) -> int | None:
        """The least open capacity of at least ``need``."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank_from, rank_to, first_bin, pieces_per_bin, first_offset) of a best-fit decreasing packing."""
    tree, plan, bins = Capacities(capacity), [], 0
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        at, n = 0, histogram[length]
        while at < n:
            room = tree.tightest(length)
            if room is None:  # open as many as the rest of this length fills
                room = capacity
                first, there = bins, -(-(n - at) // (capacity // length))
                bins += there
            else:
                first, there = tree.take(room)
            per = room // length  # a bin just used is the tightest one until it is too full
            used = min(there, -(-(n - at) // per))
            placed = min(n - at, used * per)
            plan.append((length, at, at + placed, first, per, capacity - room))
            whole = placed // per
            tree.put(room - per * length, first, whole)
            if placed % per:
                tree.put(room - placed % per * length, first + whole, 1)
            tree.put(room, first + used, there - used)
            at += placed
    return plan


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = materialise(pieces(docs, capacity, tokenizer).withColumn(
        "__h", hash32(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("piece").cast("string")))))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = cut.sparkSession.createDataFrame(
        best_fit(histogram, capacity),
        "length long, __from long, __to long, __bin long, __per long, __offset long")
    at = ranked(cut, ["length"], "__h", ["doc_id", "piece", "ids_crc32"], "__rank")
    nth = F.col("__rank") - F.col("__from")
    found = at.join(F.broadcast(plan), [at["length"] == plan["length"], at["__rank"] >= plan["__from"],
                                        at["__rank"] < plan["__to"]]).drop(plan["length"])
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("__bin") + F.floor(nth / F.col("__per"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + nth % F.col("__per") * F.col("length")).cast("long").alias("offset"))
