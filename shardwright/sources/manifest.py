"""Manifest sink and source (S9, S10) and the chat manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BYTES, MANIFEST, ChatSpec, Vocab, id_dtype


def chat_manifest(shards: DataFrame, counters: DataFrame, spec: ChatSpec, vocab: Vocab = BYTES) -> DataFrame:
    """One-row chat manifest: delimiters, ``chat = true``, ``max_len``, and per
    split tokens, supervised tokens, examples and shards (no bytes); the
    end-of-text id is the turn end, which is what generation stops on."""
    per = shards.groupBy("split").agg(F.array_sort(F.collect_list(F.struct(
        "shard_id", "file", "tokens", "examples"))).alias("sh"))
    per = per.join(counters.select("split", "tokens", "supervised_tokens", F.col("kept").alias("examples")), "split")
    info = F.struct(F.col("tokens").cast("long").alias("tokens"), F.lit(None).cast("long").alias("bytes"),
                    F.col("supervised_tokens").cast("long").alias("supervised_tokens"),
                    F.col("examples").cast("long").alias("examples"),
                    F.transform("sh", lambda s: F.struct(s["file"].alias("file"), s["tokens"].alias("tokens"),
                                                         s["examples"].cast("long").alias("examples"))).alias("shards"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("split", info))).alias("splits")).select(
        F.lit(spec.name).alias("dataset"), F.lit(spec.source).alias("source"),
        F.lit(spec.config).cast("string").alias("config"), F.lit(vocab.name + "-chat").alias("encoding"),
        F.lit(id_dtype(vocab.chat_size)).alias("dtype"), F.lit(vocab.chat_size).cast("long").alias("vocab_size"),
        F.lit(vocab.im_end).cast("long").alias("eot_token"), F.lit(vocab.im_start).cast("long").alias("im_start"),
        F.lit(vocab.im_end).cast("long").alias("im_end"), F.lit(True).alias("chat"),
        F.lit(spec.max_len).cast("long").alias("max_len"), "splits")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The one-row manifest as a JSON document."""
    cols = [c for c in MANIFEST.fieldNames() if c in manifest.columns]
    manifest.select(F.to_json(F.struct(*cols)).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str, require_chat: bool = False) -> DataFrame:
    """Manifest with its fixed schema (S10); ``require_chat`` fails the read of
    a manifest not written by the chat job."""
    m = spark.read.schema(MANIFEST).json(path)
    if require_chat:
        ok = F.assert_true(F.coalesce(F.col("chat"), F.lit(False)), F.lit("manifest was not built by the chat job"))
        m = m.withColumn("chat", F.when(ok.isNull(), F.col("chat")))
    return m


def warn_if_longer_than_block(manifest: DataFrame, block_size: int) -> bool:
    """Warn (do not fail) when the chat corpus allows conversations
    longer than the model's block size; they will be cut by the window.
    Reads the one-row manifest."""
    import warnings
    row = manifest.select("max_len").first()
    if row is not None and row["max_len"] is not None and row["max_len"] > block_size:
        warnings.warn(f"corpus allows {row['max_len']}-token conversations but block_size is "
                      f"{block_size}; long ones will be cut by the window", stacklevel=2)
        return True
    return False
