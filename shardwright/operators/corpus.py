"""Text corpus job: document order, batches, token offsets, caps, val carve,
shards and manifest (W1-W5, T1-T3, T7, A1, S6, S9, J4, J8).

All ordering work runs on a narrow per-document table ``(doc_id, n_tokens)``;
token arrays are produced only where they are written. Shards roll at batch
ends once they hold >= shard_tokens (greedy reset, see order.reset_segments).
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import doc_ids, doc_ids_packed
from ..schemas import BYTE_VOCAB_SIZE, BYTES, EOT, EOT_STR, CorpusSpec, Vocab, id_dtype
from .order import ordinal, prefix_sum, reset_segments

_LIT = len(EOT_STR.encode())


def doc_token_count(text_col: str = "text") -> F.Column:
    """Byte-vocabulary token count of a document without encoding it: bytes,
    minus 12 per literal end-of-text (13 bytes -> 1 id), plus the final EOT."""
    t = F.col(text_col)
    n_lit = (F.octet_length(t) - F.octet_length(F.replace(t, F.lit(EOT_STR), F.lit("")))) / _LIT
    return (F.octet_length(t) - (_LIT - 1) * n_lit + 1).cast("long")


def document_meta(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) for documents with text (null text is dropped), or of
    documents that ``bpe.encode_documents`` has encoded."""
    if "tokens" in docs.columns:
        return docs.select("doc_id", "n_tokens")
    return docs.filter(F.col("text").isNotNull()).select("doc_id", doc_token_count().alias("n_tokens"))


def order_documents(meta: DataFrame, batch_docs: int) -> DataFrame:
    """Add ``doc_ord`` (dense rank of doc_id) and ``batch``."""
    o = ordinal(meta, "doc_id", out="doc_ord")
    return o.withColumn("batch", F.floor(F.col("doc_ord") / batch_docs).cast("long"))


def capped_stream(ordered: DataFrame, start_ord: int | F.Column, batch_docs: int,
                  max_tokens: int | None, initial_tokens: int = 0) -> DataFrame:
    """Documents from ``start_ord`` on, in batches of ``batch_docs`` counted from
    ``start_ord``, with token offsets (W2) and the cap applied (W3).

    Returns rows of consumed documents only, with ``batch``, ``tok_start``
    (offset in this split's stream, after ``initial_tokens``) and ``n_kept``.
    A cap stops after the batch that reaches it; that batch is trimmed exactly
    and all of its documents count as consumed.
    """
    s = ordered.filter(F.col("doc_ord") >= start_ord) \
        .withColumn("sord", (F.col("doc_ord") - start_ord).cast("long")) \
        .withColumn("batch", F.floor(F.col("sord") / batch_docs).cast("long"))
    s = prefix_sum(s.select("doc_id", "doc_ord", "sord", "batch", "n_tokens"),
                   "sord", "n_tokens", out="tok_start")
    s = s.withColumn("tok_start", F.col("tok_start") + F.lit(initial_tokens))
    if max_tokens is None:
        return s.withColumn("n_kept", F.col("n_tokens"))
    # Last batch read: the first whose end reaches the cap (none -> all read).
    ends = s.groupBy("batch").agg(F.max(F.col("tok_start") + F.col("n_tokens")).alias("bend"))
    last = ends.filter(F.col("bend") >= max_tokens).agg(F.min("batch")).scalar()
    s = s.filter(last.isNull() | (F.col("batch") <= last))
    keep = F.greatest(F.least(F.col("n_tokens"), F.lit(max_tokens) - F.col("tok_start")), F.lit(0))
    return s.withColumn("n_kept", keep.cast("long"))


def split_streams(meta: DataFrame, spec: CorpusSpec, val_meta: DataFrame | None = None) -> DataFrame:
    """Consumed documents of each split with ``split``.

    With ``val_tokens``: val is the first val_tokens of the stream; train starts
    at the first document val did not consume, so the trimmed rest of val's
    last batch lands in neither split. Otherwise val comes from ``val_meta``.
    """
    ordered = order_documents(meta, spec.batch_docs)
    if spec.val_tokens is not None:
        val = capped_stream(ordered, 0, spec.batch_docs, spec.val_tokens).checkpoint()
        consumed = val.agg(F.max("doc_ord") + 1).scalar()
        train = capped_stream(ordered, F.coalesce(consumed, F.lit(0)), spec.batch_docs, spec.max_tokens)
        return val.withColumn("split", F.lit("val")).unionByName(train.withColumn("split", F.lit("train")))
    train = capped_stream(ordered, 0, spec.batch_docs, spec.max_tokens).withColumn("split", F.lit("train"))
    if val_meta is None:
        return train
    vo = order_documents(val_meta, spec.batch_docs)
    val = capped_stream(vo, 0, spec.batch_docs, None).withColumn("split", F.lit("val"))
    return val.unionByName(train)


def batch_table(streams: DataFrame) -> DataFrame:
    """Tokens written per (split, batch); batches with nothing written vanish."""
    return streams.groupBy("split", "batch").agg(
        F.sum("n_kept").cast("long").alias("tokens"),
        F.count(F.lit(1)).alias("docs"),
        F.min("doc_ord").alias("first_ord"), F.max("doc_ord").alias("last_ord")) \
        .filter(F.col("tokens") > 0)


def shard_batches(batches: DataFrame, shard_tokens: int, first_shard: int = 0) -> DataFrame:
    """Shard of each batch: roll at the first batch end with >= shard_tokens."""
    seg = reset_segments(batches, "batch", "tokens", shard_tokens, part_cols=["split"], out="shard_id")
    return seg.withColumn("shard_id", F.col("shard_id") + first_shard).drop("__end")


def shard_table(sharded_batches: DataFrame) -> DataFrame:
    """Per (split, shard): file name (P15), tokens, docs, batch range (A1)."""
    return sharded_batches.groupBy("split", "shard_id").agg(
        F.sum("tokens").cast("long").alias("tokens"),
        F.sum("docs").cast("long").alias("docs"),
        F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"),
        F.max("last_ord").alias("last_ord"),
    ).withColumn("file", F.format_string("%s_%06d.bin", F.col("split"), F.col("shard_id")))


def split_summary(shards: DataFrame, n_vocab: int = BYTE_VOCAB_SIZE) -> DataFrame:
    """Per split: tokens, bytes (tokens x id width), shard count, dtype."""
    dtype = id_dtype(n_vocab)
    width = 2 if dtype == "uint16" else 4
    return shards.groupBy("split").agg(
        F.sum("tokens").cast("long").alias("tokens"),
        F.count(F.lit(1)).alias("n_shards"),
        F.array_sort(F.collect_list(F.struct("shard_id", "file", "tokens"))).alias("shards"),
    ).select("split", "tokens", (F.col("tokens") * width).alias("bytes"), "n_shards",
             F.lit(dtype).alias("dtype"), "shards")


def manifest(summary: DataFrame, spec: CorpusSpec, n_vocab: int = BYTE_VOCAB_SIZE,
             encoding: str = "bytes", eot: int = EOT) -> DataFrame:
    """One-row manifest (S9): ``splits`` maps split -> {tokens, bytes, shards}."""
    info = F.struct(F.col("tokens"), F.col("bytes"),
                    F.lit(None).cast("long").alias("supervised_tokens"),
                    F.lit(None).cast("long").alias("examples"),
                    F.transform("shards", lambda s: F.struct(s["file"].alias("file"), s["tokens"].alias("tokens"),
                                                             F.lit(None).cast("long").alias("examples")))
                    .alias("shards"))
    return summary.agg(F.map_from_entries(F.collect_list(F.struct("split", info))).alias("splits")).select(
        F.lit(spec.name).alias("dataset"), F.lit(spec.source).alias("source"),
        F.lit(spec.config).cast("string").alias("config"), F.lit(encoding).alias("encoding"),
        F.lit(id_dtype(n_vocab)).alias("dtype"), F.lit(n_vocab).cast("long").alias("vocab_size"),
        F.lit(eot).cast("long").alias("eot_token"), "splits")


def shard_tokens_rows(streams: DataFrame, sharded_batches: DataFrame, docs: DataFrame) -> DataFrame:
    """Token arrays of consumed documents with their shard and offset, trimmed
    to ``n_kept`` (the rows a shard file is written from, S6)."""
    meta = streams.join(sharded_batches.select("split", "batch", "shard_id"), ["split", "batch"])
    rows = meta.join(docs.select("doc_id", "text"), "doc_id")
    ids = doc_ids("text")
    return rows.select("split", "shard_id", "batch", "doc_id", "doc_ord", "tok_start", "n_kept",
                       F.slice(ids, 1, F.col("n_kept")).alias("tokens"))


def shard_ranges(streams: DataFrame, sharded_batches: DataFrame) -> tuple[list, list]:
    """What tells a document's shard and length from its id alone: the ids at which shards begin and end, one row per
    (split, shard_id), and the documents that a cap cut, one per split at most: (split, doc_id, n_kept)."""
    kept = streams.filter(F.col("n_kept") > 0)
    ranges = (kept.join(sharded_batches.select("split", "batch", "shard_id"), ["split", "batch"]).groupBy("split", "shard_id")
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).orderBy("split", "shard_id").collect())
    return ranges, kept.filter(F.col("n_kept") < F.col("n_tokens")).select("split", "doc_id", "n_kept").collect()


def _place_of(ranges: list):
    """The place of the range that holds an id, -1 outside all. Ranges are bounded by the shards of the manifest."""
    order = sorted(ranges, key=lambda r: r[0])
    firsts, lasts, places = ([r[k] for r in order] for k in range(3))

    @F.arrow_udf("int")
    def place(ids: pa.Array) -> pa.Array:
        out = []
        for x in ids.to_pylist():
            i = -1 if x is None else bisect_right(firsts, x) - 1
            out.append(places[i] if i >= 0 and x <= lasts[i] else -1)
        return pa.array(out, pa.int32())

    return place


def placed_rows(docs: DataFrame, ranges: list, cut: list, n_vocab: int = BYTE_VOCAB_SIZE) -> DataFrame:
    """(place, doc_id, n_kept, tokens) of the documents that lie in a range (first, last, place): no join, and nothing of a
    document outside is encoded. Tokens are little-endian uint16 (uint32 past 65,535 ids), so a shard's rows one after the
    other in doc_id order are its ``.bin`` file."""
    width = 2 if id_dtype(n_vocab) == "uint16" else 4
    if "tokens" in docs.columns:
        docs = docs.select("doc_id", "tokens")
    else:
        docs = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    rows = docs.withColumn("place", _place_of(ranges)("doc_id")).filter(F.col("place") >= 0)
    if "text" in rows.columns:
        rows = rows.withColumn("tokens", doc_ids_packed("text", id_dtype(n_vocab)))
    n = F.octet_length("tokens") / width
    for c in cut:
        n = F.when(F.col("doc_id") == F.lit(c["doc_id"]), F.lit(c["n_kept"])).otherwise(n)
    return (rows.withColumn("n_kept", n.cast("long"))
            .select("place", "doc_id", "n_kept", F.substring("tokens", 1, (F.col("n_kept") * width).cast("int")).alias("tokens")))


def corpus_rows(docs: DataFrame, ranges: list, cut: list, n_vocab: int = BYTE_VOCAB_SIZE, val_docs: DataFrame | None = None):
    """The rows of the shards in ``ranges`` and the list of those shards by place. Two tables may share ids, so a val table
    meets the ranges of val alone."""
    shards = [(r["split"], int(r["shard_id"])) for r in ranges]
    of = lambda splits: ([(r["first"], r["last"], k) for k, r in enumerate(ranges) if r["split"] in splits],
                         [c for c in cut if c["split"] in splits])
    if val_docs is None:
        return placed_rows(docs, *of(("train", "val")), n_vocab), shards
    return placed_rows(docs, *of(("train",)), n_vocab).unionByName(placed_rows(val_docs, *of(("val",)), n_vocab)), shards


def shard_digests(docs: DataFrame, ranges: list, val_docs: DataFrame | None = None) -> DataFrame:
    """(split, shard_id, texts, digest): what the documents in the id range of each shard are, read but not encoded. The
    digest is of ids and texts, so any edit, insertion, removal or exchange of texts changes it."""
    def part(docs, splits):
        places = [(r["first"], r["last"], k) for k, r in enumerate(ranges) if r["split"] in splits]
        rows = docs.filter(F.col("text").isNotNull()).select(_place_of(places)("doc_id").alias("place"), F.xxhash64("doc_id", "text").alias("h"))
        return rows.filter(F.col("place") >= 0).groupBy("place").agg(
            F.count(F.lit(1)).alias("texts"),
            F.concat_ws(":", F.sum(F.col("h").cast("decimal(38,0)")).cast("string"), F.bit_xor("h").cast("string")).alias("digest"))

    found = part(docs, ("train", "val")) if val_docs is None else part(docs, ("train",)).unionByName(part(val_docs, ("val",)))
    names = docs.sparkSession.createDataFrame([(r["split"], int(r["shard_id"]), k) for k, r in enumerate(ranges)],
                                              "split string, shard_id int, place int")
    return names.join(found, "place").drop("place")  # a row per shard of the manifest


def tokenize_corpus(docs: DataFrame, spec: CorpusSpec, val_docs: DataFrame | None = None, vocab: Vocab = BYTES,
                    before: DataFrame | None = None):
    """The text job: returns (consumed-document streams, sharded batches, shard
    table, manifest). For BPE the documents come from ``bpe.encode_documents``.
    ``before`` holds (split, shard_id, file, tokens, docs) of earlier documents: new
    shards are numbered after them, and the manifest lists both."""
    meta = document_meta(docs)
    vmeta = document_meta(val_docs) if val_docs is not None else None
    streams = split_streams(meta, spec, vmeta).checkpoint()
    sb = shard_batches(batch_table(streams), spec.shard_tokens)
    if before is not None:
        first = before.groupBy("split").agg(F.count(F.lit(1)).cast("int").alias("__first"))
        sb = sb.join(first, "split", "left").withColumn("shard_id", F.col("shard_id") + F.coalesce("__first", F.lit(0))).drop("__first")
    shards = shard_table(sb)
    listed = shards if before is None else shards.unionByName(before, allowMissingColumns=True)
    return streams, sb, shards, manifest(split_summary(listed, vocab.text_size), spec, vocab.text_size, vocab.name, vocab.eot)
