"""Hard negatives by coordinate pruning over length buckets.

Rows are cut into buckets of similar length and those into blocks of bounded size;
every anchor meets every block. A block holds one sorted list per coordinate of its
unit vectors. To reach a score, an anchor needs a least cosine with a row of the
bucket; that bounds the angle between the two and so the values which the row can have
in a coordinate. The ranges of the anchor's ``FOCUS`` largest coordinates are cut out
of the sorted lists and intersected; what is left is verified by exact integer inner
products. The threshold of a block starts from the rows that are best in the largest
coordinate, verified first. A bucket that cannot reach the threshold is passed over.

Positives: for each anchor the first rows of its label, searched in the buckets of that
label. Negatives: for each anchor and positive, the first rows of other labels whose
score lies between two percentages of the positive's; the least score that any of the
anchor's positives allows is the threshold.

Defined cases: rows with a null id, label or vector, an empty vector, or a component
that is null or not finite take no part; only vectors of one dimension are compared;
scores must fit 64 bits (they are exact in doubles up to 2^53, beyond in integers);
zero vectors have score 0. Rows with the anchor's id are its own. Repeated rows
are several rows, both as positives and as negatives; equal rows of an anchor's id are
one anchor, rows of that id with other labels or vectors are anchors of their own. Ties
go to the smaller id. An anchor without positives, or a positive without negatives, has
no rows; an empty table gives an empty one; other columns are not carried. Long vectors:
a block holds ``BLOCK`` rows of any dimension in one task, so ``block`` should be lowered
for dimensions in the tens of thousands.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
BLOCK, ANCHORS, TILE = 4096, 4096, 128
FOCUS = 4
#: Rows that are best in the largest coordinate, verified first.
FIRST = 64
#: Buckets of lengths for each power of e.
BUCKETS = 20
FOUND_POSITIVES = "anchor long, positive_id long, score long"
FOUND = ("anchor long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long")


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that take part: row (a number), vec_id, label, code (integers), dim, length."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    rows = (vectors.select(vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .where(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0)))
    code = F.transform("embedding", lambda x: F.floor(x * F.lit(256.0)).cast("long"))
    square = F.aggregate("code", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return (rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", code.alias("code"))
            .select("*", F.size("code").alias("dim"), F.sqrt(square).alias("length")))


class Block:
    """Rows of one bucket with a sorted list for each coordinate, made when it is first asked for."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        self.ids = table.column("vec_id").to_numpy()[order]
        self.labels = table.column("label").to_numpy()[order]
        flat = table.column("code").combine_chunks().flatten().to_numpy()
        self.codes = flat.reshape(len(order), -1)[order]
        self.lengths = np.sqrt((self.codes.astype(np.float64) ** 2).sum(axis=1))
        self.shortest, self.longest = float(self.lengths.min()), float(self.lengths.max())
        self.unit = self.codes / np.maximum(self.lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            rows = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = rows, self.unit[rows, f]
        return self.lists[f]

    def scores(self, anchors: np.ndarray, rows=slice(None)) -> np.ndarray:
        """Exact inner products of anchors and rows."""
        codes = self.codes[rows]
        largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(codes).max(initial=0)) * codes.shape[1]
        kind = np.float64 if largest < 2 ** 53 else np.int64
        return (anchors.astype(kind) @ codes.astype(kind).T).astype(np.int64)

    def first_rows(self, unit: np.ndarray) -> np.ndarray:
        f = int(np.abs(unit).argmax())
        rows, _ = self.sorted_list(f)
        return rows[-FIRST:] if unit[f] > 0 else rows[:FIRST]

    def candidates(self, unit: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """A mask of the rows that can reach the score ``least``; None if all can."""
        if length == 0:
            return None if least <= 0 else np.zeros(len(self.ids), bool)
        reach = length * (self.longest if least > 0 else self.shortest)
        cosine = least / reach if reach else (np.inf if least > 0 else -np.inf)
        if cosine > 1 + 1e-9:
            return np.zeros(len(self.ids), bool)
        if cosine <= -1 or self.shortest == 0:
            return None
        angle = np.arccos(min(1.0, cosine)) + 1e-7
        hits, ranges = None, 0
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            to_axis = np.arccos(np.clip(unit[f], -1.0, 1.0))
            low = -1.0 if to_axis + angle >= np.pi else np.cos(to_axis + angle)
            high = 1.0 if to_axis <= angle else np.cos(to_axis - angle)
            rows, values = self.sorted_list(int(f))
            a, b = np.searchsorted(values, low - 1e-9, "left"), np.searchsorted(values, high + 1e-9, "right")
            if b - a < len(rows):
                hits = np.zeros(len(rows), np.uint8) if hits is None else hits
                hits[rows[a:b]] += 1
                ranges += 1
        return None if hits is None else hits == ranges


def _codes(table: pa.Table) -> np.ndarray:
    return table.column("code").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _tiles(anchors: pa.Table, block: Block, allowed, least):
    """For each anchor of each tile its number, the rows verified and their scores. ``allowed(i)``: a mask of rows that count;
    ``least(i, scores)``: the score that anchor i needs, given those of the first rows."""
    codes = _codes(anchors)
    lengths = np.sqrt((codes.astype(np.float64) ** 2).sum(axis=1))
    units = codes / np.maximum(lengths, 1e-300)[:, None]
    for t in range(0, len(codes), TILE):
        dense = []
        for i in range(t, min(t + TILE, len(codes))):
            mask = allowed(i)
            first = block.first_rows(units[i])
            first = first[mask[first]]
            need = least(i, block.scores(codes[i:i + 1], first)[0])
            if need is None:
                continue
            found = block.candidates(units[i], lengths[i], need)
            mask = mask if found is None else mask & found
            n = np.count_nonzero(mask)
            if n * 8 > len(mask):
                dense.append((i, mask))
            elif n:
                rows = np.flatnonzero(mask)
                yield i, rows, block.scores(codes[i:i + 1], rows)[0]
        if dense:
            every = block.scores(codes[[i for i, _ in dense]])
            for (i, mask), scores in zip(dense, every):
                rows = np.flatnonzero(mask)
                yield i, rows, scores[rows]


def _best(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by score, ties to the row that comes first (rows are in order of id)."""
    if len(rows) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[-k]
        rows, scores = rows[keep], scores[keep]
    order = np.argsort(-scores, kind="stable")[:k]
    return rows[order], scores[order]


def _table(out: dict, schema: str) -> pa.Table:
    kinds = dict(f.split() for f in schema.split(", "))
    return pa.table({c: pa.array(v, pa.int32() if kinds[c] == "int" else pa.int64()) for c, v in out.items()})


def search_positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    out: dict = {"anchor": [], "positive_id": [], "score": []}
    if anchors.num_rows and rows.num_rows:
        block, number, ids = Block(rows), anchors.column("row").to_pylist(), anchors.column("vec_id").to_pylist()
        kth = lambda i, s: float(np.partition(s, len(s) - k)[-k]) if len(s) >= k else -np.inf
        for i, found, scores in _tiles(anchors, block, lambda i: block.ids != ids[i], kth):
            found, scores = _best(found, scores, k)
            out["anchor"] += [number[i]] * len(found)
            out["positive_id"] += block.ids[found].tolist()
            out["score"] += scores.tolist()
    return _table(out, FOUND_POSITIVES)


def search_negatives(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    out: dict = {c.split()[0]: [] for c in FOUND.split(", ")}
    if anchors.num_rows and rows.num_rows:
        block = Block(rows)
        number, ids, labels = (anchors.column(c).to_pylist() for c in ("row", "vec_id", "label"))
        positives = anchors.column("positives").to_pylist()
        # 100 * score from low * positive to high * positive, in integers
        spans = [[(-(-low * p["score"] // 100), high * p["score"] // 100) for p in ps] for ps in positives]

        def least(i, scores):
            needs = []
            for a, b in spans[i]:
                if a <= b:
                    inside = scores[(scores >= a) & (scores <= b)]
                    needs.append(max(a, int(np.partition(inside, len(inside) - k)[-k])) if len(inside) >= k else a)
            return min(needs, default=None)

        for i, found, scores in _tiles(anchors, block, lambda i: block.labels != labels[i], least):
            for p, (a, b) in zip(positives[i], spans[i]):
                inside = (scores >= a) & (scores <= b)
                rows_, best = _best(found[inside], scores[inside], k)
                n = len(rows_)
                for c, v in (("anchor", number[i]), ("anchor_id", ids[i]), ("place", p["place"]), ("positive_id", p["positive_id"]),
                             ("positive_score", p["score"])):
                    out[c] += [v] * n
                out["negative_id"] += block.ids[rows_].tolist()
                out["negative_score"] += best.tolist()
    return _table(out, FOUND)


def _meet(anchors: DataFrame, rows: DataFrame, by: list[str], block: int, search, schema: str) -> DataFrame:
    """``search`` for every block of rows and every part of the anchors with equal ``by``."""
    bucket = F.when(F.col("length") > 0, F.floor(F.log("length") * BUCKETS)).otherwise(F.lit(-1)).cast("int").alias("bucket")
    place = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), n).cast("int")
    parts = max(1, -(-anchors.count() // ANCHORS))
    rows = rows.select("*", bucket)
    cells = rows.groupBy(*by, "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    rows = (rows.join(cells, [*by, "bucket"]).withColumn("block", place(F.col("blocks"), 1)).drop("blocks")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    everywhere = cells.withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).drop("blocks")
    anchors = anchors.withColumn("part", place(F.lit(parts), 2)).join(everywhere, by)
    cell = [*by, "bucket", "block", "part"]
    anchors, rows = (x.toDF(*x.columns) for x in (anchors, rows))  # both come from one table
    return anchors.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInArrow(search, schema)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``is_anchor`` marks."""
    rows = materialise(usable(vectors))
    anchors = rows.where(is_anchor).dropDuplicates(["vec_id", "label", "code"])
    found = _meet(anchors, rows, ["dim", "label"], block, lambda a, b: search_positives(a, b, positives), FOUND_POSITIVES)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    theirs = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives"))
    known = materialise(anchors.join(theirs.withColumnRenamed("anchor", "row"), "row"))
    found = _meet(known, rows, ["dim"], block, lambda a, b: search_negatives(a, b, negatives, low, high), FOUND)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
