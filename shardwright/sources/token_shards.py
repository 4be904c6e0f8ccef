"""Raw token-shard files: export (S6/S7) and a Python Data Source.

A text shard is one flat little-endian file without a header,
``{split}_{i:06d}.bin``; a chat shard adds ``.mask.bin`` (uint8) and ``.idx.bin``
(uint64 start of each conversation in the shard). Rows are streamed to files, so
memory holds one Arrow batch; a job's files appear when it has succeeded. Paths go through
``pyarrow.fs``; one without a scheme is resolved as Spark resolves it.
"""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    LessThan, LessThanOrEqual)

# Tokens of one row when a shard has no conversations, and of one read task.
CHUNK_TOKENS = 1 << 16
TASK_TOKENS = 1 << 24


def resolve(spark, path: str) -> str:
    """A path without a scheme belongs to the default file system."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return os.path.abspath(path) if default.startswith("file:") else default.rstrip("/") + "/" + path.lstrip("/")


def _fs(path: str):
    """(filesystem, path inside it) for a local path or a URI."""
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


class _Files:
    """The files of one shard, written under temporary names and renamed when they are complete."""

    def __init__(self, stem: str, suffixes: list[str]):
        self.fs, p = _fs(stem)
        self.names = [(f"{p}{s}.tmp-{uuid.uuid4().hex}", p + s) for s in suffixes]
        self.streams = [self.fs.open_output_stream(t) for t, _ in self.names]

    def write(self, *parts) -> None:
        for stream, part in zip(self.streams, parts):
            stream.write(part)

    def close(self) -> None:
        for stream, (tmp, name) in zip(self.streams, self.names):
            stream.close()
            self.fs.move(tmp, name)


def _flat(column: pa.Array) -> memoryview:
    """The bytes of a binary column, one after the other, without a Python object for each."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
    return memoryview(column.buffers()[2] or b"")[int(ends[0]):int(ends[-1])]


class _Sink:
    """Shard files of one job: tasks write them to a folder of their own beside the final ones; ``commit`` moves them there
    when the job has succeeded, and whatever a failed job or task left goes with that folder.

    Every shard has a place, 0 to n - 1, which is its task (``repartitionById``): the ids cross one shuffle, no task holds
    parts of a shard that another holds as well, and two shards never meet in one task by chance.
    """

    def __init__(self, spark, out_dir: str, shards: list[tuple[str, int]], suffixes: list[str]):
        self.out, self.shards, self.suffixes = resolve(spark, out_dir).rstrip("/"), shards, suffixes
        self.staging = f"{self.out}/_staging-{uuid.uuid4().hex[:12]}"
        fs, p = _fs(self.staging)
        fs.create_dir(p, recursive=True)

    def dealt(self, rows: DataFrame, order: str) -> DataFrame:
        return rows.repartitionById(max(1, len(self.shards)), "place").sortWithinPartitions("place", order)

    def writer(self, encode, passed: bool):
        """A function for ``mapInArrow`` over dealt rows whose first column is the place. ``encode(batch)`` gives the bytes of
        the rows for each suffix and their numbers of tokens and examples. Returned are the rows, without their place but
        with split and shard_id (``passed``), or a row for each shard."""
        shards, staging, suffixes = self.shards, self.staging, self.suffixes

        def write(batches):
            files, at, done = None, None, []
            for b in batches:
                place = b.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)] if len(place) else []
                for i, j in zip(edges, edges[1:]):
                    if place[i] != at:
                        if files:
                            files.close()
                        at = int(place[i])
                        files = _Files(f"{staging}/{_stem(*shards[at])}", suffixes)
                        done.append([*shards[at], _stem(*shards[at]) + ".bin", 0, 0])
                    part = b.slice(i, j - i)
                    parts, tokens, examples = encode(part)
                    files.write(*parts)
                    done[-1][3] += tokens
                    done[-1][4] += examples
                    if passed:
                        split, shard = shards[at]
                        yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array([split] * (j - i)), pa.array([shard] * (j - i), pa.int32())],
                                                         names=[*part.schema.names[1:], "split", "shard_id"])
            if files:
                files.close()
                if not passed:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*done), (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                        names=["split", "shard_id", "file", "tokens", "examples"])

        return write

    def commit(self) -> None:
        fs, root = _fs(self.out)
        _, staged = _fs(self.staging)
        for shard in self.shards:
            for suffix in self.suffixes:
                name = _stem(*shard) + suffix
                if fs.get_file_info(f"{root}/{name}").is_file:
                    fs.delete_file(f"{root}/{name}")
                fs.move(f"{staged}/{name}", f"{root}/{name}")

    def __enter__(self):
        return self

    def __exit__(self, *error):
        fs, p = _fs(self.staging)
        fs.delete_dir(p)


def _stem(split: str, shard: int) -> str:
    return f"{split}_{shard:06d}"


def write_text_shards(rows: DataFrame, shards: list[tuple[str, int]], bin_dir: str, rows_dir: str, keep: bool = False) -> None:
    """Text shards of (place, doc_id, n_kept, tokens BINARY) rows, where ``shards[place]`` is the row's shard: flat ``.bin`` files
    in doc_id order and, in the same pass, Parquet rows by (split, shard_id). ``keep`` leaves the other shards as they are."""
    def encode(b):
        return [_flat(b.column(3))], int(b.column(2).to_numpy().sum()), b.num_rows

    rows = rows.select("place", "doc_id", "n_kept", "tokens")
    kind = rows.schema["doc_id"].dataType.simpleString()
    with _Sink(rows.sparkSession, bin_dir, shards, [".bin"]) as sink:
        (sink.dealt(rows, "doc_id").mapInArrow(sink.writer(encode, True), f"doc_id {kind}, n_kept long, tokens binary, split string, shard_id int")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep else "static").partitionBy("split", "shard_id").parquet(rows_dir))
        sink.commit()


def export_chat_shards(convs: DataFrame, out_dir: str, dtype: str = "uint16", shards: DataFrame | None = None) -> DataFrame:
    """One .bin/.mask.bin/.idx.bin triple per (split, shard_id) of (split, shard_id, kord, shard_start, tokens, mask) rows;
    ``shards`` lists them if they are known (a row per shard). Returns the written files with token and example counts."""
    width = np.dtype(dtype).newbyteorder("<")
    spark = convs.sparkSession

    def encode(b):
        tokens, mask = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (3, 4))
        return ([tokens.astype(width).tobytes(), mask.astype(np.uint8).tobytes(), b.column(2).to_numpy().astype("<u8").tobytes()],
                len(tokens), b.num_rows)

    found = (convs if shards is None else shards).select("split", "shard_id").distinct().orderBy("split", "shard_id").collect()
    listed = [(r["split"], int(r["shard_id"])) for r in found]
    places = spark.createDataFrame([(s, i, k) for k, (s, i) in enumerate(listed)], "split string, shard_id int, place int")
    rows = convs.withColumn("shard_id", F.col("shard_id").cast("int")).join(F.broadcast(places), ["split", "shard_id"])
    with _Sink(spark, out_dir, listed, [".bin", ".mask.bin", ".idx.bin"]) as sink:
        schema = "split string, shard_id int, file string, tokens long, examples long"
        done = sink.dealt(rows.select("place", "kord", "shard_start", "tokens", "mask"), "kord").mapInArrow(sink.writer(encode, False), schema).collect()
        sink.commit()
    return spark.createDataFrame(done, schema)


def manifest_fields(path: str) -> dict | None:
    """The manifest beside a folder of shards (``../manifest``), if there is one."""
    fs, root = _fs(path)
    folder = os.path.dirname(root.rstrip("/")) + "/manifest"
    from pyarrow import fs as pafs
    if fs.get_file_info(folder).type != pafs.FileType.Directory:
        return None
    for f in sorted(fs.get_file_info(pafs.FileSelector(folder)), key=lambda f: f.base_name):
        if f.is_file and f.size and not f.base_name.startswith(("_", ".")):
            with fs.open_input_stream(f.path) as stream:
                return json.loads(stream.read())
    return None


def id_width(path: str, dtype: str | None) -> str:
    """The id type of a folder's shards: that of its manifest. ``dtype`` is needed only where there is none, and must agree
    with it otherwise: flat files read by another width give other ids without an error."""
    man = manifest_fields(path)
    found = man.get("dtype") if man else None
    if found and dtype and found != dtype:
        raise ValueError(f"the manifest beside {path} says {found}, not {dtype}")
    if not (found or dtype):
        raise ValueError(f"no manifest beside {path}: give the id type as option dtype")
    return found or dtype


def read_at(path: str, dtype, first: int, last: int) -> np.ndarray:
    """Elements first..last of a flat little-endian file."""
    fs, p = _fs(path)
    width = np.dtype(dtype).itemsize
    with fs.open_input_file(p) as f:
        end = min(last * width, f.size())
        return np.frombuffer(f.read_at(max(0, end - first * width), first * width), dtype=dtype)


class _Range(InputPartition):
    """Rows first..last of a shard: conversations, or chunks of a text shard."""

    def __init__(self, stem: str, split: str, shard: int, first: int, last: int, chat: bool):
        super().__init__((stem, first))
        self.stem, self.split, self.shard, self.first, self.last, self.chat = stem, split, shard, first, last, chat


#: Columns whose filters are met by not reading: names of files, and places in them.
_PUSHED = ("split", "shard_id", "example", "shard_start")


class TokenShardReader(DataSourceReader):
    """Reads byte ranges of shards, an Arrow batch per range; only the columns of the schema."""

    def __init__(self, path: str, dtype: str, chunk: int, columns: list[str]):
        self.path, self.dtype, self.chunk, self.columns = path, np.dtype(dtype).newbyteorder("<"), chunk, columns
        self.tests: list[tuple[str, str, object]] = []

    def _meets(self, column: str, least, most) -> bool:
        """Some value from ``least`` to ``most`` meets the pushed tests on a column."""
        for name, op, v in self.tests:
            if name == column and not (
                    least <= v <= most if op == "=" else any(least <= x <= most for x in v) if op == "in"
                    else most > v if op == ">" else most >= v if op == ">=" else least < v if op == "<" else least <= v):
                return False
        return True

    def partitions(self):
        from pyarrow import fs as pafs
        fs, root = _fs(self.path)
        sizes = {i.base_name: i.size for i in fs.get_file_info(pafs.FileSelector(root)) if i.is_file}
        parts = []
        for name in sorted(n for n in sizes if n.endswith(".bin") and n.count(".") == 1):
            stem = name[:-len(".bin")]
            split, num = stem.rsplit("_", 1)
            if not (self._meets("split", split, split) and self._meets("shard_id", int(num), int(num))):
                continue
            chat = f"{stem}.idx.bin" in sizes
            tokens = sizes[name] // self.dtype.itemsize
            rows = sizes[f"{stem}.idx.bin"] // 8 if chat else -(-tokens // self.chunk)
            step = max(1, rows * TASK_TOKENS // max(1, tokens))
            for a in range(0, rows, step):
                r = _Range(f"{self.path.rstrip('/')}/{stem}", split, int(num), a, min(a + step, rows), chat)
                if self._narrowed(r):
                    parts.append(r)
        return parts

    def _narrowed(self, r: _Range) -> bool:
        """Leaves the rows of a range that the tests on places can let through; whether any are left. Starts of
        conversations are sorted in their file, but only the places in it are known here."""
        keep = [k for k in (r.first, r.last - 1)]
        for name, op, v in self.tests:
            scale = self.chunk if name == "shard_start" and not r.chat else 1
            if name not in ("example", "shard_start") or name == "shard_start" and r.chat or op == "in":
                continue
            low, high = -(-v // scale), v // scale  # the first row not below v, the last not above it
            if op in ("=", ">="):
                keep[0] = max(keep[0], low)
            if op == ">":
                keep[0] = max(keep[0], high + 1)
            if op in ("=", "<="):
                keep[1] = min(keep[1], high)
            if op == "<":
                keep[1] = min(keep[1], low - 1)
        r.first, r.last = keep[0], keep[1] + 1
        place = (r.first * self.chunk, (r.last - 1) * self.chunk)
        return r.first < r.last and self._meets("example", r.first, r.last - 1) and (r.chat or self._meets("shard_start", *place))

    def read(self, partition):
        r = partition
        n = r.last - r.first
        if r.chat:
            starts = read_at(r.stem + ".idx.bin", "<u8", r.first, r.last + 1).astype(np.int64)
            first, last = int(starts[0]), int(starts[n]) if len(starts) > n else 1 << 60
        else:
            starts = np.arange(r.first, r.last, dtype=np.int64) * self.chunk
            first, last = r.first * self.chunk, r.last * self.chunk
        tokens = mask = None
        if "tokens" in self.columns:
            tokens = read_at(r.stem + ".bin", self.dtype, first, last)
            last = first + len(tokens)
        if "mask" in self.columns and r.chat:
            mask = read_at(r.stem + ".mask.bin", np.uint8, first, last)
            last = first + len(mask)

        def lists(v):
            cuts = np.append(starts[:n], last) - first
            return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(v.astype(np.int32)))

        made = {
            "split": lambda: pa.array([r.split] * n), "shard_id": lambda: pa.array([r.shard] * n, pa.int32()),
            "example": lambda: pa.array(np.arange(r.first, r.last), pa.int32()), "shard_start": lambda: pa.array(starts[:n]),
            "tokens": lambda: lists(tokens), "mask": lambda: pa.nulls(n, pa.list_(pa.int32())) if mask is None else lists(mask),
        }
        yield pa.RecordBatch.from_arrays([made[c]() for c in self.columns], names=self.columns)


class PushingReader(TokenShardReader):
    """A reader that takes over comparisons with split, shard_id and places in a shard. Spark applies those on places again,
    since a range is cut by rows of a file and not by every test."""

    def pushFilters(self, filters):
        ops = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in ops and len(f.attribute) == 1 and f.attribute[0] in _PUSHED and f.value is not None:
                self.tests.append((f.attribute[0], ops[type(f)], f.value))
                if f.attribute[0] in ("split", "shard_id"):
                    continue
            yield f


class TokenShardDataSource(DataSource):
    """``spark.read.format("token_shard").load(dir)``: one row per conversation of a
    chat shard, or per ``chunk`` tokens of a text shard (mask null) (S8).

    The id type is that of the manifest beside the folder (option ``dtype`` without
    one). Files of columns that are not in a schema given by ``.schema(...)`` are not
    opened. Comparisons with split, shard_id, example and shard_start choose files and
    byte ranges where ``spark.sql.python.filterPushdown.enabled`` is set.
    """

    reader_class = TokenShardReader

    @classmethod
    def name(cls):
        return "token_shard"

    def schema(self):
        return ("split string, shard_id int, example int, shard_start long, "
                "tokens array<int>, mask array<int>")

    def reader(self, schema):
        path = self.options.get("path")
        return self.reader_class(path, id_width(path, self.options.get("dtype")), int(self.options.get("chunk", CHUNK_TOKENS)),
                                 schema.fieldNames())


class PushingDataSource(TokenShardDataSource):
    reader_class = PushingReader


def register(spark) -> None:
    """Makes ``token_shard`` known. Spark refuses readers with pushdown where it is switched off."""
    pushing = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    spark.dataSource.register(PushingDataSource if pushing else TokenShardDataSource)
