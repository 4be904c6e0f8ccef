"""Training windows straight from shard files.

The work follows the draws, not the corpus. Sizes, id width and kind of the shards come
from the manifest. A draw picks its shard by binary search in the prefix sums of the
shards' tokens (one number per shard of the manifest, broadcast) and its start within
the shard. Draws are then sorted by (shard, place) over range partitions, so windows
that lie close together are read as one byte range and every range by one task.

In a chat shard windows begin where conversations do. The sorted ``.idx.bin`` file is
searched by bisection for the number of starts that leave a whole window, and only the
entries that draws ask for are read. The place within a shard grows with the drawn
number in both kinds, so one sort by that number serves starts and windows.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import draws, tokens_seen, uniform
from ..schemas import IGNORE_INDEX
from .manifest import read_manifest
from .token_shards import read_at, resolve

#: Bytes of windows in a task, of one read, and between windows that are read together.
TASK_BYTES, READ_BYTES, GAP_BYTES = 1 << 26, 1 << 23, 1 << 16
#: Entries of the index that a bisection reads at its end.
INDEX_BLOCK = 1 << 12
WINDOWS = "step long, micro long, row long, split string, shard_id int, start long, x array<int>, y array<int>"


class Shards:
    """Stems, ids and sizes of the shards of one split, in order, as the manifest lists them."""

    def __init__(self, manifest: dict, split: str, folder: str):
        info = (manifest["splits"] or {}).get(split) or {"shards": []}
        files = sorted((int(f["file"].removesuffix(".bin").rsplit("_", 1)[1]), f["tokens"], f["examples"]) for f in info["shards"])
        self.split, self.folder, self.chat = split, folder.rstrip("/"), bool(manifest["chat"])
        self.dtype = np.dtype(manifest["dtype"]).newbyteorder("<")
        self.ids, self.tokens, self.examples = ([f[k] for f in files] for k in range(3))
        self.before = np.concatenate(([0], np.cumsum(self.tokens, dtype=np.int64)))
        self.total = int(self.before[-1])

    def stem(self, i: int) -> str:
        return f"{self.folder}/{self.split}_{self.ids[i]:06d}"

    def holding(self, target: np.ndarray) -> np.ndarray:
        """The shard whose token range holds each target; empty shards hold none."""
        return np.searchsorted(self.before, target, side="right") - 1


def valid_starts(stem: str, tokens: int, examples: int, block: int) -> int:
    """How many conversation starts leave a whole window: starts are sorted, so it is found by bisection."""
    low, high = 0, examples
    while high - low > INDEX_BLOCK:
        middle = (low + high) // 2
        if int(read_at(stem + ".idx.bin", "<u8", middle, middle + 1)[0]) <= tokens - block - 1:
            low = middle + 1
        else:
            high = middle
    return low + bisect_right(read_at(stem + ".idx.bin", "<u8", low, high).astype(np.int64), tokens - block - 1)


def _ranges(starts: np.ndarray, length: int, width: int):
    """(i, j): sorted elements i..j of ``length`` that are read at once."""
    i = 0
    while i < len(starts):
        j = i + 1
        while (j < len(starts) and (starts[j] - starts[j - 1] - length) * width <= GAP_BYTES
               and (starts[j] + length - starts[i]) * width <= READ_BYTES):
            j += 1
        yield i, j
        i = j


def _taken(path: str, dtype, starts: np.ndarray, length: int):
    """(i, j, elements): row k of the elements are the ``length`` ones from starts[i + k] on."""
    for i, j in _ranges(starts, length, np.dtype(dtype).itemsize):
        first = int(starts[i])
        flat = read_at(path, dtype, first, int(starts[j - 1]) + length)
        yield i, j, flat[(starts[i:j] - first)[:, None] + np.arange(length)]


def _starts(shards: Shards, i: int, u: np.ndarray, block: int) -> np.ndarray:
    """Starts of the windows drawn from shard i by the sorted numbers ``u`` in [0, 1)."""
    if not shards.chat:
        n = shards.tokens[i] - block - 1
        if n <= 0:
            raise ValueError("a shard holds fewer than block_size + 2 tokens")
        return np.floor(u * n).astype(np.int64)
    n = valid_starts(shards.stem(i), shards.tokens[i], shards.examples[i], block)
    if n == 0:
        raise ValueError("a shard holds fewer than block_size + 1 tokens after its starts")
    places = np.floor(u * n).astype(np.int64)
    return np.concatenate([x[:, 0] for _, _, x in _taken(shards.stem(i) + ".idx.bin", "<u8", places, 1)]).astype(np.int64)


def _windows(shards: Shards, i: int, rows: pa.RecordBatch, block: int):
    starts = _starts(shards, i, rows.column("u").to_numpy(), block)
    masks = _taken(shards.stem(i) + ".mask.bin", np.uint8, starts, block + 1) if shards.chat else None
    held = np.empty((0, block + 1), np.uint8)
    lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, block, dtype=np.int32)), pa.array(m.reshape(-1)))
    for a, b, ids in _taken(shards.stem(i) + ".bin", shards.dtype, starts, block + 1):
        x, y = ids[:, :-1].astype(np.int32), ids[:, 1:].astype(np.int32)
        if masks is not None:
            while len(held) < b - a:  # masks are narrower, so their ranges are other ones
                held = np.concatenate([held, next(masks)[2]])
            y, held = np.where(held[:b - a, 1:] == 1, y, np.int32(IGNORE_INDEX)), held[b - a:]
        n = b - a
        part = rows.slice(a, n)
        yield pa.RecordBatch.from_arrays(
            [part.column("step"), part.column("micro"), part.column("row"), pa.array([shards.split] * n),
             pa.array([shards.ids[i]] * n, pa.int32()), pa.array(starts[a:b]), lists(x), lists(y)],
            names=["step", "micro", "row", "split", "shard_id", "start", "x", "y"])


def drawn_windows(spark: SparkSession, shard_dir: str, manifest_dir: str, block: int, steps: int, accum: int, batch: int,
                  split: str, seed: int) -> DataFrame:
    """(step, micro, row, split, shard_id, start, x, y, tokens_seen) for every drawn window of a text or chat corpus. A split
    without tokens has no windows; a drawn shard without room for one fails."""
    manifest = read_manifest(spark, manifest_dir).first().asDict(recursive=True)
    shards = Shards(manifest, split, resolve(spark, shard_dir))
    held = spark.sparkContext.broadcast(shards)

    def pick(batches):
        s = held.value
        for b in batches:
            places = s.holding(b.column("target").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("step", "micro", "row", "u")), pa.array(places, pa.int32())],
                                             names=["step", "micro", "row", "u", "place"])

    def read(batches):
        s = held.value
        for b in batches:
            place = b.column("place").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)] if len(place) else [0]
            for i, j in zip(edges, edges[1:]):
                yield from _windows(s, int(place[i]), b.slice(i, j - i), block)

    target = F.floor(uniform(seed, "step", "micro") * shards.total).cast("long")
    if shards.total == 0:
        steps = 0
    rows = draws(spark, steps, accum, batch).select("step", "micro", "row", target.alias("target"), uniform(seed, "step", "micro", "row").alias("u"))
    rows = rows.mapInArrow(pick, "step long, micro long, row long, u double, place int")
    size = steps * accum * batch * (block + 1) * shards.dtype.itemsize
    tasks = max(-(-size // TASK_BYTES), min(steps * accum * batch, spark.sparkContext.defaultParallelism), 1)
    rows = rows.repartitionByRange(tasks, "place", "u").sortWithinPartitions("place", "u")
    return rows.mapInArrow(read, WINDOWS).withColumn("tokens_seen", tokens_seen("step", block, batch, accum))
