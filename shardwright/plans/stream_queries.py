"""Streaming and binary-shard queries; each reuses a batch query's oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chat as C
from ..operators import choice as X
from ..session import scratch_path
from ..sources import token_shards as TS
from ..streaming import scalars as SS
from ..streaming import tokenize as ST
from . import chat_queries as CQ
from . import run_queries as RQ
from . import window_queries as WQ
from . import text_queries
from . import choice_queries as XQ
from .registry import ORACLES, query, table

STREAM_FILES = 4


def _oracle(name: str) -> str:
    return ORACLES[name]


_STREAM_SQL = f"""
WITH {text_queries._D},
p AS (SELECT *, coalesce(sum(n_tokens) OVER (ORDER BY doc_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tok_start FROM o)
SELECT doc_id, CAST(tok_start AS BIGINT) AS tok_start, n_tokens,
       md5(array_to_string(list_transform({text_queries.DOC_IDS_SQL}, lambda x: printf('%02x%02x', x % 256, x // 256)), '')) AS ids_md5
FROM p"""


@query("stream_tokenize", _STREAM_SQL)
def stream_tokenize(spark, sf):
    """Documents staged as files in doc_id order, tokenised by a file stream
    with carried (tokens, docs) state; must equal the batch offsets (K1-K3)."""
    base = scratch_path(spark, "stream-tokenize")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ST.stage_in_order(docs, f"{base}/source", STREAM_FILES)
    out = ST.tokenize_stream(spark, f"{base}/source", f"{base}/out", f"{base}/state", f"{base}/checkpoint")
    return out.select("doc_id", "tok_start", "n_tokens", F.md5(F.lower(F.hex("tokens"))).alias("ids_md5"))


@query("stream_choice_report", _oracle("choice_report"))
def stream_choice_report(spark, sf):
    """Scored examples arrive as files; a complete-mode streaming aggregation
    keeps the per-source report current after each batch (K4)."""
    base = scratch_path(spark, "stream-report")
    s, ex = XQ._scored(spark, sf)
    picks = X.example_picks(s, ex)
    picks.repartition(3).write.parquet(f"{base}/picks")
    rep = ST.running_report(spark, f"{base}/picks", picks.schema, f"{base}/checkpoint", f"{base}/sums")
    return rep.select("source", "n", *[F.round(c, 6).alias(c) for c in ("acc", "acc_norm", "loss", "all", "margin")])


_SHARDS_SQL = _oracle("chat_shards")
_SHARDS_SQL = _SHARDS_SQL[:_SHARDS_SQL.rindex("SELECT")].rstrip() + f""",{WQ.CHAT_IDS_SQL},
files AS (SELECT sh.*, array_to_string(list_transform(toks, lambda v: printf('%02x%02x', v & 255, v >> 8)), '') AS ids,
                 array_to_string(list_transform(msk, lambda v: printf('%02x', v)), '') AS mask,
                 array_to_string(list_transform([0, 8, 16, 24, 32, 40, 48, 56], lambda b: printf('%02x', (shard_start >> b) & 255)), '') AS idx
          FROM sh JOIN ct USING (conv_id))
SELECT split, shard_id, printf('%s_%06d.bin', split, shard_id) AS file,
       CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS examples,
       CAST(sum(n_supervised) AS BIGINT) AS supervised_tokens,
       md5(string_agg(CAST(shard_start AS VARCHAR), ',' ORDER BY conv_id)) AS starts_md5,
       md5(unhex(string_agg(ids, '' ORDER BY conv_id))) AS bin_md5, md5(unhex(string_agg(mask, '' ORDER BY conv_id))) AS mask_md5,
       md5(unhex(string_agg(idx, '' ORDER BY conv_id))) AS idx_md5
FROM files GROUP BY split, shard_id"""


@query("shard_file_roundtrip", _SHARDS_SQL)
def shard_file_roundtrip(spark, sf):
    """Chat shards exported as .bin / .mask.bin / .idx.bin, the md5 of every file, and
    its rows read back with the ``token_shard`` data source (S7, S8, U4)."""
    out = scratch_path(spark, "chat-shards")
    convs, shards, _ = C.tokenize_chat(CQ._turns(spark, sf), CQ.CHAT_SPEC)
    TS.export_chat_shards(convs, out, shards=shards)
    TS.register(spark)
    back = spark.read.format("token_shard").option("dtype", "uint16").load(out)
    rows = back.groupBy("split", "shard_id").agg(
        F.sum(F.size("tokens")).cast("long").alias("tokens"), F.count(F.lit(1)).alias("examples"),
        F.sum(F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x)).cast("long").alias("supervised_tokens"),
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "shard_start"))),
                                       lambda x: x["shard_start"].cast("string")), ",")).alias("starts_md5"),
    ).withColumn("file", C.shard_file())
    part = lambda k: F.regexp_extract("path", r"([^/]+_\d{6})(\.mask|\.idx)?\.bin$", k)
    files = spark.read.format("binaryFile").load(f"{out}/*.bin").select(
        F.concat(part(1), F.lit(".bin")).alias("file"), part(2).alias("kind"), F.md5("content").alias("md5"))
    md5 = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("md5")))
    return rows.join(files.groupBy("file").agg(md5("").alias("bin_md5"), md5(".mask").alias("mask_md5"), md5(".idx").alias("idx_md5")), "file")


@query("stream_scalar_merge", _oracle("scalar_merge"))
def stream_scalar_merge(spark, sf):
    """Scalar logs that arrive in files, the later writes of a key often first, merged
    from new files alone in two runs of one stream (S12, A13)."""
    base = scratch_path(spark, "scalar-log")
    log, args = f"{base}/log", (f"{base}/merged", f"{base}/checkpoint", 1)
    rows = RQ._scalars(spark, sf).select("run", "path", "seq", "tag", "step", "value", "wall_time")
    for part in (1, 0):
        rows.filter(F.col("seq") % 2 == part).repartition(2, "path").write.mode("append").parquet(log)
        merged = SS.merge_new_scalars(spark, log, *args)
    return merged.select("run", "tag", "step", "value")
