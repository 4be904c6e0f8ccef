"""Vocabulary tables, decoding and generation clean-up (T5, T6, T15, T16,
J9, P10, P11, P17, P20)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import by_runs, runs
from ..schemas import (BYTE_VOCAB_BASE, BYTE_VOCAB_SIZE, EOT, EOT_STR, IM_END, IM_END_STR, IM_START,
                       IM_START_STR)

SPECIALS = [(EOT, "eot", EOT_STR), (IM_START, "im_start", IM_START_STR), (IM_END, "im_end", IM_END_STR)]


def byte_vocab(spark, vocab_id: str = "bytes-v1") -> DataFrame:
    """``vocab(vocab_id, id, bytes, kind)``: 256 byte rows, then the specials
    at the first free ids; base ids are unchanged by the chat extension (T5)."""
    base = spark.range(BYTE_VOCAB_BASE).select(
        F.col("id").cast("int").alias("id"), F.unhex(F.format_string("%02X", F.col("id"))).alias("bytes"),
        F.lit("byte").alias("kind"))
    sp = spark.createDataFrame([(i, s.encode(), k) for i, k, s in SPECIALS], "id int, bytes binary, kind string")
    v = base.unionByName(sp).withColumn("vocab_id", F.lit(vocab_id))
    # The delimiters must sit right after the base ids (no collision).
    chk = F.assert_true(F.col("id") < BYTE_VOCAB_SIZE, F.lit("vocabulary id out of range"))
    return v.withColumn("id", F.when(chk.isNull(), F.col("id")))


def bpe_vocab(spark, ranks: dict, vocab_id: str) -> DataFrame:
    """Vocabulary of a rank table (rank = id), then end-of-text and the chat
    delimiters at the first free ids."""
    rows = [(int(r), bytes(b), "bpe" if len(b) > 1 else "byte") for b, r in ranks.items()]
    eot = max(ranks.values()) + 1
    rows += [(eot, EOT_STR.encode(), "eot"), (eot + 1, IM_START_STR.encode(), "im_start"), (eot + 2, IM_END_STR.encode(), "im_end")]
    return spark.createDataFrame(rows, "id int, bytes binary, kind string").withColumn("vocab_id", F.lit(vocab_id))



def decoder(vocab: DataFrame):
    """A column function ids -> text: concatenated token bytes, invalid UTF-8
    replaced, ids without a token skipped (T6, J9).

    The vocabulary (bounded by its size) travels to the workers as one byte
    table; each run of rows is one ``take`` over it.
    """
    from pyspark.sql.functions import arrow_udf

    known = {r["id"]: bytes(r["bytes"]) for r in vocab.select("id", "bytes").collect()}
    tokens = [known.get(i, b"") for i in range(max(known, default=-1) + 1)] + [b""]

    def decode_run(table: pa.Array, ids: pa.Array) -> pa.Array:
        if ids.null_count:
            ids = ids.fill_null(pa.scalar([], ids.type))
        lengths = np.diff(ids.offsets.to_numpy())
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        known_ids = np.where((flat < 0) | (flat >= len(tokens)), len(tokens) - 1, flat).astype(np.int64)
        taken = table.take(pa.array(known_ids))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        data = taken.buffers()[2].to_pybytes() if len(taken) and taken.buffers()[2] is not None else b""
        cuts = ends[np.concatenate(([0], np.cumsum(lengths)))]
        return pa.array([data[x:y].decode("utf-8", "replace") for x, y in zip(cuts, cuts[1:])], pa.string())

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(tokens, pa.large_binary())
        for ids in batches:
            for a, n in runs(ids):
                yield decode_run(table, ids.slice(a, n))

    fn = arrow_udf(decode, "string")
    return lambda ids: fn(F.col(ids) if isinstance(ids, str) else ids)


def id_counts(docs: DataFrame, size: int) -> DataFrame:
    """(id, occurrences) of the byte ids of all documents; each task adds up a
    ``bincount`` per run, so at most ``size`` rows leave it."""
    from ..functions.tokens import _doc_list

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in by_runs(batches, 0):
            total += np.bincount(_doc_list(b.column(0)).values.to_numpy(), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(total[ids])], names=["id", "n"])

    return (docs.where(F.col("text").isNotNull()).select("text").mapInArrow(count, "id int, n long")
            .groupBy("id").agg(F.sum("n").alias("occurrences")))


def check_vocab(manifest_vocab_id, vocab_id_col) -> F.Column:
    """Encode/decode only with the vocabulary recorded with the data (P20)."""
    return F.assert_true(manifest_vocab_id == vocab_id_col, F.lit("vocabulary does not match the manifest"))


def cut_at_eot(ids, eot: int = EOT) -> F.Column:
    """Ids before the first EOT; unchanged without one; empty if EOT is first (P10)."""
    pos = F.array_position(ids, eot)
    return F.when(pos > 0, F.slice(ids, 1, (pos - 1).cast("int"))).otherwise(ids)


def drop_padding(ids, n_vocab: int) -> F.Column:
    """Drop ids of padded vocabulary rows, ``id >= n_vocab``."""
    return F.filter(ids, lambda t: t < n_vocab)


def pin_after_eot(ids, first_eot, eot: int = EOT) -> F.Column:
    """Every id after the first EOT becomes EOT (finished rows, P17).
    ``first_eot`` must be a column computed beforehand (1-based, 0 = none):
    referencing it keeps the lambda O(1) per element."""
    return F.transform(ids, lambda t, i: F.when((first_eot > 0) & (i >= first_eot), F.lit(eot)).otherwise(t))


def answer_layout(user, reply, system=None) -> F.Column:
    """``system:`` / ``user:`` / ``assistant:`` lines of a chat answer."""
    # Fixed prefixes of the printed answer.
    lines = [F.concat(F.lit("user:      "), user), F.concat(F.lit("assistant: "), reply)]
    if system is not None:
        lines.insert(0, F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("system:    "), system)))
    return F.concat_ws("\n", *lines)
