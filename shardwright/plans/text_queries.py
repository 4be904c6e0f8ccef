"""Text-corpus queries (documents table)."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..functions.tokens import doc_ids, ids_digest
from ..operators import corpus as K
from ..schemas import EOT, CorpusSpec
from ..session import scratch_path
from ..sources import token_shards as TS
from .registry import query, table
from .sqlfrag import bytes_of, digest

# Test-scale parameters (survey 7.4): 64 documents per batch, 200,000-token
# shards, 100,000 val tokens carved off the front; a 1,000,000-token cap for
# the cap query.
B = 64
S = 200_000
VAL_TOKENS = 100_000
CAP = 1_000_000
SPEC = CorpusSpec(name="fixture-text", batch_docs=B, shard_tokens=S, val_tokens=VAL_TOKENS)


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


_D = """
d AS (SELECT doc_id, text,
        CAST(strlen(text) - 12 * ((strlen(text) - strlen(replace(text, '<|endoftext|>', ''))) // 13) + 1 AS BIGINT) AS n_tokens
      FROM documents WHERE text IS NOT NULL),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS doc_ord FROM d)"""

DOC_IDS_SQL = (f"list_concat(flatten(list_transform(string_split(text, '<|endoftext|>'), "
               f"lambda x, i: CASE WHEN i = 1 THEN {bytes_of('x')} ELSE list_concat([{EOT}], {bytes_of('x')}) END)), [{EOT}])")


def _stream_sql(name: str, src: str, start: str, cap: int | None, split: str) -> str:
    base = f"""
{name}0 AS (SELECT o.*, doc_ord - ({start}) AS sord, (doc_ord - ({start})) // {B} AS batch FROM o WHERE doc_ord >= ({start})),
{name}1 AS (SELECT *, coalesce(sum(n_tokens) OVER (ORDER BY sord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tok_start FROM {name}0)"""
    if cap is None:
        return base + f""",
{name} AS (SELECT doc_id, doc_ord, sord, batch, n_tokens, tok_start, n_tokens AS n_kept, '{split}' AS split FROM {name}1)"""
    return base + f""",
{name}L AS (SELECT min(batch) AS lb FROM (SELECT batch, max(tok_start + n_tokens) AS bend FROM {name}1 GROUP BY batch) WHERE bend >= {cap}),
{name} AS (SELECT doc_id, doc_ord, sord, batch, n_tokens, tok_start,
                  CAST(greatest(least(n_tokens, {cap} - tok_start), 0) AS BIGINT) AS n_kept, '{split}' AS split
           FROM {name}1, {name}L WHERE {name}L.lb IS NULL OR batch <= {name}L.lb)"""


_SPLITS = (_stream_sql("v", "o", "0", VAL_TOKENS, "val")
           + ",\nvc AS (SELECT coalesce(max(doc_ord) + 1, 0) AS consumed FROM v),"
           + _stream_sql("t", "o", "(SELECT consumed FROM vc)", None, "train")
           + ",\nst AS (SELECT * FROM v UNION ALL SELECT * FROM t)")

_BATCH = f"""
b AS (SELECT split, batch, CAST(sum(n_kept) AS BIGINT) AS tokens, count(*) AS docs,
             min(doc_ord) AS first_ord, max(doc_ord) AS last_ord
      FROM st GROUP BY split, batch HAVING sum(n_kept) > 0),
walk AS (
  SELECT split, batch, tokens AS acc, 0 AS shard_id FROM b WHERE batch = 0
  UNION ALL
  SELECT b.split, b.batch, CASE WHEN w.acc >= {S} THEN b.tokens ELSE w.acc + b.tokens END,
         CASE WHEN w.acc >= {S} THEN w.shard_id + 1 ELSE w.shard_id END
  FROM walk w JOIN b ON b.split = w.split AND b.batch = w.batch + 1),
sb AS (SELECT b.*, walk.shard_id FROM b JOIN walk USING (split, batch)),
sh AS (SELECT split, shard_id, printf('%s_%06d.bin', split, shard_id) AS file, CAST(sum(tokens) AS BIGINT) AS tokens,
              CAST(sum(docs) AS BIGINT) AS docs, min(batch) AS first_batch, max(batch) AS last_batch,
              max(last_ord) AS last_ord
       FROM sb GROUP BY split, shard_id)"""


@query("doc_token_counts", f"""
WITH {_D} SELECT doc_id, len({DOC_IDS_SQL}) AS n_tokens, n_tokens AS n_tokens_formula FROM d""")
def doc_token_counts(spark, sf):
    d = _docs(spark, sf).filter(F.col("text").isNotNull())
    return d.select("doc_id", F.size(doc_ids("text")).alias("n_tokens"),
                    K.doc_token_count().alias("n_tokens_formula"))


@query("doc_token_digest", f"""
SELECT doc_id, {digest(DOC_IDS_SQL)} AS ids_md5 FROM documents WHERE text IS NOT NULL""")
def doc_token_digest(spark, sf):
    d = _docs(spark, sf).filter(F.col("text").isNotNull())
    return d.select("doc_id", ids_digest(doc_ids("text")).alias("ids_md5"))


@query("doc_batches", f"""
WITH {_D} SELECT doc_id, doc_ord, doc_ord // {B} AS batch FROM o""")
def doc_batches(spark, sf):
    o = K.order_documents(K.document_meta(_docs(spark, sf)), B)
    return o.select("doc_id", "doc_ord", "batch")


@query("doc_offsets", f"""
WITH {_D}
SELECT doc_id, CAST(coalesce(sum(n_tokens) OVER (ORDER BY doc_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS tok_start,
       n_tokens FROM o""")
def doc_offsets(spark, sf):
    o = K.order_documents(K.document_meta(_docs(spark, sf)), B)
    s = K.capped_stream(o, 0, B, None)
    return s.select("doc_id", "tok_start", "n_tokens")


@query("token_cap", f"""
WITH {_D}, {_stream_sql("c", "o", "0", CAP, "train")}
SELECT doc_id, batch, n_tokens, n_kept FROM c""")
def token_cap(spark, sf):
    o = K.order_documents(K.document_meta(_docs(spark, sf)), B)
    s = K.capped_stream(o, 0, B, CAP)
    return s.select("doc_id", "batch", "n_tokens", "n_kept")


@query("val_carve", f"""
WITH {_D}, {_SPLITS}
SELECT split, count(*) AS docs, min(doc_ord) AS first_ord, max(doc_ord) AS last_ord,
       CAST(sum(n_kept) AS BIGINT) AS tokens, CAST(sum(n_tokens - n_kept) AS BIGINT) AS discarded_tokens,
       (SELECT count(*) FROM v WHERE doc_id IN (SELECT doc_id FROM t)) AS shared_docs
FROM st GROUP BY split""")
def val_carve(spark, sf):
    st = K.split_streams(K.document_meta(_docs(spark, sf)), SPEC).checkpoint()
    shared = st.filter("split = 'val'").join(st.filter("split = 'train'").select("doc_id"), "doc_id", "left_semi") \
        .agg(F.count(F.lit(1))).scalar()
    return st.groupBy("split").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_ord").alias("first_ord"), F.max("doc_ord").alias("last_ord"),
        F.sum("n_kept").cast("long").alias("tokens"),
        F.sum(F.col("n_tokens") - F.col("n_kept")).cast("long").alias("discarded_tokens"),
    ).withColumn("shared_docs", shared)


@query("text_shards", f"""
WITH RECURSIVE {_D}, {_SPLITS}, {_BATCH}
SELECT split, shard_id, file, tokens, docs, first_batch, last_batch FROM sh""")
def text_shards(spark, sf):
    _, _, shards, _ = K.tokenize_corpus(_docs(spark, sf), SPEC)
    return shards.select("split", "shard_id", "file", "tokens", "docs", "first_batch", "last_batch")


@query("split_manifest", f"""
WITH RECURSIVE {_D}, {_SPLITS}, {_BATCH}
SELECT split, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * 2 AS BIGINT) AS bytes,
       count(*) AS n_shards, 'uint16' AS dtype, 259 AS vocab_size, {EOT} AS eot_token,
       string_agg(file || ':' || tokens, ',' ORDER BY shard_id) AS shard_list
FROM sh GROUP BY split""")
def split_manifest(spark, sf):
    _, _, shards, man = K.tokenize_corpus(_docs(spark, sf), SPEC)
    ex = man.select(F.explode("splits").alias("split", "info"), "vocab_size", "eot_token", "dtype")
    return ex.select(
        "split", F.col("info.tokens").alias("tokens"), F.col("info.bytes").alias("bytes"),
        F.size("info.shards").alias("n_shards"), "dtype", F.col("vocab_size").cast("int").alias("vocab_size"),
        F.col("eot_token").cast("int").alias("eot_token"),
        F.array_join(F.transform("info.shards", lambda s: F.concat(s["file"], F.lit(":"), s["tokens"].cast("string"))),
                     ",").alias("shard_list"))


@query("resume_skip", f"""
WITH RECURSIVE {_D}, {_SPLITS}, {_BATCH}
SELECT shard_id, file, tokens, docs, first_batch, last_batch FROM sh WHERE split = 'train' AND shard_id >= 1""")
def resume_skip(spark, sf):
    """Resume train after its first closed shard: progress = documents consumed
    and tokens written through shard 0; the resumed run skips those documents
    (J4, S11) and must reproduce the remaining shards."""
    docs = _docs(spark, sf)
    streams, sb, shards, _ = K.tokenize_corpus(docs, SPEC)
    done = shards.filter("split = 'train' AND shard_id = 0")
    skip = done.agg(F.max("last_ord") + 1).scalar()
    first_batch = done.agg(F.max("last_batch") + 1).scalar()
    ordered = K.order_documents(K.document_meta(docs), B)
    rest = K.capped_stream(ordered, skip, B, None)
    # Batch numbers continue from the progress point (batches are B-aligned).
    rest = rest.withColumn("batch", F.col("batch") + first_batch).withColumn("split", F.lit("train"))
    sb2 = K.shard_batches(K.batch_table(rest), S, first_shard=1)
    return K.shard_table(sb2).select("shard_id", "file", "tokens", "docs", "first_batch", "last_batch")


def _files_sql(splits: str) -> str:
    return f"""
WITH RECURSIVE {_D}, {splits}, {_BATCH},
wr AS (SELECT split, shard_id, count(*) AS docs, md5(string_agg(md5(m), ',' ORDER BY doc_id)) AS ids_md5,
              md5(unhex(string_agg(m, '' ORDER BY doc_id))) AS bin_md5
       FROM (SELECT sb.split, sb.shard_id, st.doc_id,
                    array_to_string(list_transform(list_slice({DOC_IDS_SQL}, 1, n_kept),
                                                   lambda x: printf('%02x%02x', x % 256, x // 256)), '') AS m
             FROM st JOIN sb USING (split, batch) JOIN d USING (doc_id) WHERE st.n_kept > 0)
       GROUP BY split, shard_id)
SELECT split, shard_id, file, tokens, sh.docs AS consumed, wr.docs, first_batch, last_batch, ids_md5, bin_md5
FROM sh JOIN wr USING (split, shard_id)"""


def _write_and_read(spark, sf, spec):
    docs = _docs(spark, sf)
    streams, sb, shards, _ = K.tokenize_corpus(docs, spec)
    out = scratch_path(spark, "text-shards")
    rows, listed = K.corpus_rows(docs, *K.shard_ranges(streams, sb))
    TS.write_text_shards(rows, listed, f"{out}/bin", f"{out}/rows")
    back = spark.read.parquet(f"{out}/rows")
    files = spark.read.format("binaryFile").load(f"{out}/bin/*.bin").select(
        F.substring_index("path", "/", -1).alias("file"), F.md5("content").alias("bin_md5"))
    per_doc = F.array_sort(F.collect_list(F.struct("doc_id", F.md5(F.lower(F.hex("tokens"))).alias("m"))))
    written = back.groupBy("split", F.col("shard_id").cast("int").alias("shard_id")).agg(
        (F.sum(F.octet_length("tokens")) / 2).cast("long").alias("tokens"),
        F.count(F.lit(1)).cast("long").alias("docs"),
        F.md5(F.array_join(F.transform(per_doc, lambda x: x["m"]), ",")).alias("ids_md5"))
    # Documents trimmed to nothing by the cap are consumed but not written.
    consumed = shards.select("split", F.col("shard_id").cast("int").alias("shard_id"), "first_batch",
                             "last_batch", F.col("docs").alias("consumed"))
    named = written.withColumn("file", F.format_string("%s_%06d.bin", F.col("split"), F.col("shard_id")))
    return named.join(consumed, ["split", "shard_id"]).join(files, "file").select(
        "split", "shard_id", "file", "tokens", "consumed", "docs", "first_batch", "last_batch", "ids_md5", "bin_md5")


@query("text_shard_files", _files_sql(_SPLITS))
def text_shard_files(spark, sf):
    """The whole text job: encode every consumed document, trim, write token
    shards as rows by (split, shard_id) and as ``.bin`` files in one pass (S6), and
    summarise what was written: an md5 over the md5s of each document's uint16 bytes, and that of every file."""
    return _write_and_read(spark, sf, SPEC)


_CAPPED = (_stream_sql("v", "o", "0", VAL_TOKENS, "val")
           + ",\nvc AS (SELECT coalesce(max(doc_ord) + 1, 0) AS consumed FROM v),"
           + _stream_sql("t", "o", "(SELECT consumed FROM vc)", CAP, "train")
           + ",\nst AS (SELECT * FROM v UNION ALL SELECT * FROM t)")


@query("text_shard_files_capped", _files_sql(_CAPPED))
def text_shard_files_capped(spark, sf):
    """The text job with a token cap on train: documents past the cap are not
    written and the last batch is trimmed (W3, O4)."""
    return _write_and_read(spark, sf, dataclasses.replace(SPEC, max_tokens=CAP))
