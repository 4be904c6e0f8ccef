"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints of word shingles (XXH64, seed 42) are joined at a bounded number
of differing bits. Equal fingerprints are one node. Distinct ones meet by
pigeonhole: the 64 bits are cut into ``max_bits + 2`` blocks, at least two of
which agree within the bound, so every pair of blocks is a key. The
fingerprints of a key are sorted by Gray rank, which puts similar ones side by
side, and indexed in levels: a node keeps the bits that all its members share
and its parent doesn't yet have. A search accumulates differing bits from the
root down and prunes a whole group as soon as they exceed the bound. Groups
that already are in the searching fingerprint's component are pruned too, so a
dense group costs its size and no pair list is made.

Keys with more than ``CELL`` fingerprints are cut into parts and every two
parts meet in a task of their own.

Defined cases: a null or empty text has fingerprint zero, linked like any other;
repeated rows share a component; rows without an id belong to their component
but never name it (a component without any id has a null one); an empty table
gives an empty result; other input columns are not carried.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_of, written
from .graph import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
FANOUT = 16
CELL = 16384
FRONTIER = 1 << 21


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer; bytes.lower and bytes.split know ASCII only."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts.tolist(), ends[shingle - 1:].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    h = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[a:a + (1 << 15)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text) and fp (the fingerprint's 64 bits as a long)."""
    def each(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)],
                                             names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        each, "doc_id long, text_hash long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Masks of every two of ``max_bits + 2`` blocks of the 64 bits."""
    n = max_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Levels of groups over fingerprints sorted by (key, Gray rank); a group never crosses a key."""

    def __init__(self, key: np.ndarray, fp: np.ndarray):
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        new = np.concatenate(([True], key[1:] != key[:-1]))
        self.fp, self.first = fp, np.flatnonzero(new)
        self.of_key = np.cumsum(new) - 1
        # Level 0 has the fingerprints; each level above has FANOUT groups to a group, the last one group to a key.
        start, parent_key = np.arange(len(fp)), self.of_key
        masks, patterns = [np.full(len(fp), full)], [fp]
        lo, hi = fp, fp
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # per level above 0: first child, one past the last
        self.spans = [(start, start + 1)]
        while len(lo) > len(self.first):
            begin = np.concatenate(([True], parent_key[1:] != parent_key[:-1]))
            place = np.arange(len(lo)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
            heads = np.flatnonzero(place % FANOUT == 0)
            lo, hi = np.bitwise_and.reduceat(lo, heads), np.bitwise_or.reduceat(hi, heads)
            ends = np.append(heads[1:], len(place))
            self.children.append((heads, ends))
            self.spans.append((self.spans[-1][0][heads], self.spans[-1][1][ends - 1]))
            masks.append(~(lo ^ hi))
            patterns.append(lo)
            parent_key = parent_key[heads]
        # Bits that the parent shares already are factored out of the child.
        self.masks = [*masks[:-1], masks[-1]]
        for level, (a, b) in enumerate(self.children):
            self.masks[level] = masks[level] & ~np.repeat(masks[level + 1], b - a)
        self.patterns = patterns
        self.top = len(self.children)

    def links(self, max_bits: int) -> np.ndarray:
        """Per fingerprint the first place of its component."""
        n = len(self.fp)
        root = np.arange(n)
        sizes = np.diff(np.append(self.first, n))[self.of_key]
        # Searches go in turns of a bounded frontier.
        turn = np.cumsum(sizes) // FRONTIER
        cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            for s in range(a, b, 4096):
                q = np.arange(s, min(b, s + 4096))
                root = merge(root, *self._near(q, root, max_bits))
        return root

    def _near(self, q: np.ndarray, root: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        node, diff = self.of_key[q], np.zeros(len(q), np.uint8)
        for level in range(self.top, -1, -1):
            if level < self.top:
                a, b = self.children[level]
                n = b[node] - a[node]
                q, diff = np.repeat(q, n), np.repeat(diff, n)
                node = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a[node], n)
            x = (self.fp[q] ^ self.patterns[level][node]) & self.masks[level][node]
            diff = diff + np.bitwise_count(x)
            lo, hi = self.spans[level][0][node], self.spans[level][1][node]
            keep = (diff <= max_bits) & (hi > q + 1)
            if level:
                head = self.spans[level][0]
                least = np.minimum.reduceat(root, head)
                one = least == np.maximum.reduceat(root, head)  # spans of a level follow one another
                keep &= ~(one[node] & (least[node] == root[q]))
            else:
                keep &= lo > q
            q, node, diff = q[keep], node[keep], diff[keep]
        return q, node


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after joining each i with its j; a root is the least place of its component."""
    while len(i):
        a, b = root[i], root[j]
        if not (differs := a != b).any():
            break
        a, b = a[differs], b[differs]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (next_root := root[root]).tobytes() != root.tobytes():
            root = next_root
        i, j = i[differs], j[differs]
    return root


def _index_links(max_bits: int):
    """Arrow batches (key, fp) sorted by key -> links (a, b) between the fingerprints of each key."""
    def solve(key, fp):
        order = np.lexsort((gray_rank(fp), key))
        key, fp = key[order], fp[order]
        root = GrayIndex(key, fp).links(max_bits)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved].view(np.int64)), pa.array(fp[root[moved]].view(np.int64))],
                                          names=["a", "b"])

    def run(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            key = np.concatenate((key, b.column(0).to_numpy()))
            fp = np.concatenate((fp, b.column(1).to_numpy().view(np.uint64)))
            whole = np.searchsorted(key, key[-1]) if len(key) else 0  # the last key may go on in the next batch
            if whole >= CELL:
                yield solve(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield solve(key, fp)
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``max_bits`` into their components."""
    masks = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in block_masks(max_bits)])
    keys = fps.select("fp", F.posexplode(masks).alias("c", "m"))
    keys = keys.select("fp", F.xxhash64("c", F.col("fp").bitwiseAND(F.col("m"))).alias("key"))
    shared = (keys.repartition("key").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
              .where("n > 1"))
    search = lambda x: x.sortWithinPartitions("key").mapInArrow(_index_links(max_bits), "a long, b long")
    few = search(shared.where(F.col("n") <= cell).select("key", "fp"))
    # Larger keys: every two parts i < j meet in a cell.
    many = (shared.where(F.col("n") > cell).withColumn("p", F.ceil(F.col("n") / cell).cast("int"))
            .withColumn("i", F.pmod(F.xxhash64("fp"), F.col("p")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("p") - 1))).where("i <> j")
            .select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp")
            .repartition("key"))
    return few.union(search(many))


def clusters(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the component) and component_id (the smallest doc_id
    reachable over links) of every document."""
    each = written(fingerprints(docs, shingle), "fingerprints")
    distinct = materialise(each.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), max_bits))
    known = distinct.join(roots, distinct["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    named = known.groupBy("root").agg(F.min("first").alias("component_id"))
    component = known.select("fp", "root").join(named, "root")
    return each.join(component, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id (null last), then the smallest text hash.

    A row that is repeated with the same id and text stays once.
    """
    key = ["__nameless", "__id", "__hash"]
    keyed = lambda d, text_hash: (d.withColumn("__nameless", F.col("doc_id").isNull())
                                  .withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")))
                                  .withColumn("__hash", text_hash))
    each = keyed(clusters(docs.select("doc_id", "text"), shingle, max_bits), F.col("text_hash"))
    stays = each.groupBy("root").agg(F.min(F.struct(*key)).alias("k")).select("k.*")
    kept = keyed(docs, F.xxhash64(text_of())).join(stays, key, "left_semi")
    return kept.dropDuplicates(key).select(*docs.columns)
