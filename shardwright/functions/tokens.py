"""Token-id column functions for the byte vocabulary.

The hot path (text -> UTF-8 byte ids) is an Arrow UDF that reuses the string
column's own data buffer: the ids of a batch are the buffer's bytes widened to
int32, with the string offsets as the list offsets. No per-row Python runs
except for the rare document that contains a literal end-of-text string.
``utf8_ids_expr`` is the same function as a pure SQL expression (5x slower,
kept for cross-checks and for engines without Arrow UDFs).

Ids take several times the bytes of their text, so a batch is encoded in runs
of rows of ``RUN`` bytes (or one longer row) and each run's ids leave at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..schemas import EOT, EOT_STR


#: Bytes of text, or numbers of ids, that are worked on at once.
RUN = 1 << 20


def runs(s: pa.Array, most: int = RUN):
    """(first row, rows) of the runs of a string, binary or list array that hold at most ``most`` bytes or items, or one
    row that holds more."""
    if not len(s):
        return
    wide = pa.types.is_large_string(s.type) or pa.types.is_large_binary(s.type) or pa.types.is_large_list(s.type)
    buf = s.buffers()[1]
    offs = np.frombuffer(buf, np.int64 if wide else np.int32)[s.offset:s.offset + len(s) + 1].astype(np.int64)
    a = 0
    while a < len(s):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, side="right")) - 1)
        yield a, b - a
        a = b


def by_runs(batches, column: int):
    """Arrow batches cut into runs by the bytes of a column."""
    for b in batches:
        for a, n in runs(b.column(column)):
            yield b.slice(a, n)


def _string_parts(s: pa.Array):
    """(offsets relative to the first value, data bytes) of a string array."""
    if s.null_count:
        s = s.fill_null("")
    if pa.types.is_large_string(s.type):
        odt = np.int64
    else:
        odt = np.int32
    bufs = s.buffers()
    offs = np.frombuffer(bufs[1], dtype=odt)[s.offset:s.offset + len(s) + 1]
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None
            else np.zeros(0, np.uint8))
    base = int(offs[0]) if len(offs) else 0
    return (offs - base).astype(np.int32), data[base:int(offs[-1]) if len(offs) else 0]


def _utf8_list(s: pa.Array) -> pa.Array:
    offs, data = _string_parts(s)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(data.astype(np.int32)))


def _doc_list(s: pa.Array) -> pa.Array:
    """Byte ids of each document, literal end-of-text -> EOT, plus a final EOT."""
    offs, data = _string_parts(s)
    n = len(offs) - 1
    has_special = pc.match_substring(s.fill_null(""), EOT_STR).to_numpy(zero_copy_only=False)
    lens = np.diff(offs).astype(np.int64)
    if has_special.any():
        # Rare path: re-encode only the rows that contain the literal.
        pieces = {}
        for i in np.nonzero(has_special)[0]:
            text = s[int(i)].as_py() or ""
            out = []
            for j, part in enumerate(text.split(EOT_STR)):
                if j:
                    out.append(EOT)
                out.extend(part.encode("utf-8"))
            pieces[int(i)] = np.asarray(out, dtype=np.int32)
            lens[i] = len(out)
    new_offs = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(lens + 1, out=new_offs[1:])
    vals = np.empty(int(new_offs[-1]), dtype=np.int32)
    if not has_special.any():
        # Every slot but the last of each row holds a byte.
        inner = np.ones(len(vals), dtype=bool)
        inner[new_offs[1:] - 1] = False
        vals[inner] = data
    else:
        for i in range(n):
            a, b = int(new_offs[i]), int(new_offs[i + 1]) - 1
            if int(i) in pieces:
                vals[a:b] = pieces[int(i)]
            else:
                vals[a:b] = data[offs[i]:offs[i + 1]]
    vals[new_offs[1:] - 1] = EOT
    return pa.ListArray.from_arrays(pa.array(new_offs.astype(np.int32)), pa.array(vals))


def _doc_packed(s: pa.Array, width: int) -> pa.Array:
    """Document ids as little-endian unsigned ``width``-byte integers, one
    binary value per document (the on-disk shard layout)."""
    lists = _doc_list(s)
    offs = lists.offsets.to_numpy().astype(np.int64) * width
    dt = "<u2" if width == 2 else "<u4"
    vals = lists.values.to_numpy().astype(dt)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists),
                                            [None, pa.py_buffer(offs), pa.py_buffer(vals.tobytes())])


def _doc_u16_batch(s: pa.Array) -> pa.Array:
    return _doc_packed(s, 2)


def _doc_u32_batch(s: pa.Array) -> pa.Array:
    return _doc_packed(s, 4)


def _utf8_batch(s: pa.Array) -> pa.Array:
    return _utf8_list(s)


def _doc_batch(s: pa.Array) -> pa.Array:
    return _doc_list(s)


_UDFS: dict = {}


def _udf(name, fn, rtype="array<int>"):
    # Built on first use: the Python workers import this module without a
    # SparkContext, so nothing here may touch Spark at import time.
    if name not in _UDFS:
        def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for s in batches:
                for a, n in runs(s):
                    yield fn(s.slice(a, n))

        each.__name__ = fn.__name__  # as plans show it
        _UDFS[name] = arrow_udf(each, rtype)
    return _UDFS[name]


def doc_ids_packed(col, dtype: str = "uint16") -> Column:
    """:func:`doc_ids` as little-endian ``uint16``/``uint32`` bytes (BINARY)."""
    fn = _doc_u16_batch if dtype == "uint16" else _doc_u32_batch
    return _udf("packed-" + dtype, fn, "binary")(F.col(col) if isinstance(col, str) else col)


def utf8_ids(col) -> Column:
    """UTF-8 byte ids of a string; every special string stays ordinary text."""
    return _udf("utf8", _utf8_batch)(F.col(col) if isinstance(col, str) else col)


def doc_ids(col) -> Column:
    """Document encoding: literal end-of-text becomes EOT, and EOT is appended
    (so an empty document is ``[EOT]``)."""
    return _udf("doc", _doc_batch)(F.col(col) if isinstance(col, str) else col)


def utf8_ids_expr(col: str) -> Column:
    """Pure SQL version of :func:`utf8_ids` (hex once, then two chars per id)."""
    return F.expr(
        f"transform(regexp_extract_all(hex(encode({col}, 'UTF-8')), '..', 0), "
        "x -> cast(conv(x, 16, 10) as int))")


def ids_digest(col) -> Column:
    """md5 of the comma-joined ids: a scalar stand-in for an id array."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.array_join(c, ","))
