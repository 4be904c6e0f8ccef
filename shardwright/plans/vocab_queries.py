"""Vocabulary, BPE, decoding and generation clean-up queries (documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bpe as BPE
from ..functions.tokens import doc_ids, ids_digest
from ..operators import choice as X
from ..operators import vocab as V
from ..schemas import BYTE_VOCAB_SIZE, EOT, EOT_STR, padded_vocab
from .registry import query, table
from .text_queries import DOC_IDS_SQL

# Rank table derived from the corpus: single bytes, the most frequent byte pairs
# (ranks 256.., ties by pair code), and the most frequent words' beginnings of
# three and four bytes that such pairs make up, so that merges chain.
K_MERGES = 200
K_WORDS = 200


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "source").filter(F.col("text").isNotNull())


def fixture_ranks(spark, sf) -> dict:
    pairs, _ = X.bigram_table(table(spark, sf, "documents"))
    top = pairs.filter((F.col("prev") < 256) & (F.col("cur") < 256)) \
        .orderBy(F.desc("c"), "prev", "cur").limit(K_MERGES).collect()
    ranks = {bytes([b]): b for b in range(256)}
    for i, r in enumerate(top):
        ranks[bytes([r["prev"], r["cur"]])] = 256 + i
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{4,}"), F.lit(0))).alias("w"))
    starts = words.select(F.substring("w", 1, 4).alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(K_WORDS).collect()
    for w in (r["w"].encode() for r in starts):
        if w[:2] in ranks:
            ranks.setdefault(w[:3], len(ranks))
            ranks.setdefault(w, len(ranks))
    return ranks


@query("vocab_table", f"""
WITH ids AS (SELECT unnest({DOC_IDS_SQL}) AS id FROM documents WHERE text IS NOT NULL),
f AS (SELECT id, count(*) AS occurrences FROM ids GROUP BY id),
v AS (SELECT CAST(unnest(range({BYTE_VOCAB_SIZE})) AS INTEGER) AS id)
SELECT v.id, CASE WHEN v.id < 256 THEN 'byte' WHEN v.id = 256 THEN 'eot' WHEN v.id = 257 THEN 'im_start' ELSE 'im_end' END AS kind,
       CASE WHEN v.id < 256 THEN printf('%02X', v.id) WHEN v.id = 256 THEN hex('<|endoftext|>')
            WHEN v.id = 257 THEN hex('<|im_start|>') ELSE hex('<|im_end|>') END AS bytes_hex,
       coalesce(f.occurrences, 0) AS occurrences, {BYTE_VOCAB_SIZE} AS n_vocab, {padded_vocab(BYTE_VOCAB_SIZE)} AS padded_vocab
FROM v LEFT JOIN f USING (id)""")
def vocab_table(spark, sf):
    v = V.byte_vocab(spark)
    occ = V.id_counts(_docs(spark, sf), BYTE_VOCAB_SIZE)
    return v.join(occ, "id", "left").select(
        "id", "kind", F.hex("bytes").alias("bytes_hex"), F.coalesce("occurrences", F.lit(0)).alias("occurrences"),
        F.lit(BYTE_VOCAB_SIZE).alias("n_vocab"), F.lit(padded_vocab(BYTE_VOCAB_SIZE)).alias("padded_vocab"))


@query("decode_tokens", f"""
SELECT doc_id, md5(text || '{EOT_STR}') AS text_md5,
       md5(concat_ws(chr(10), 'user:      ' || source, 'assistant: ' || text || '{EOT_STR}')) AS answer_md5
FROM documents WHERE text IS NOT NULL""")
def decode_tokens(spark, sf):
    d = _docs(spark, sf)
    d = d.select("doc_id", "source", V.decoder(V.byte_vocab(spark))(doc_ids("text")).alias("decoded"))
    dec = F.col("decoded")
    return d.select("doc_id", F.md5(dec).alias("text_md5"),
                    F.md5(V.answer_layout(F.col("source"), dec)).alias("answer_md5"))


_GEN_SQL = f"""
WITH g0 AS (SELECT doc_id, {DOC_IDS_SQL} AS ids FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN list_concat(list_slice(ids, 1, len(ids) - 1), [300, 319])
        ELSE list_concat(list_slice(ids, 1, doc_id % 50), [{EOT}], list_slice(ids, doc_id % 50 + 1, len(ids)), [300, 319]) END AS gen
      FROM g0),
p AS (SELECT doc_id, gen, coalesce(list_position(gen, {EOT}), 0) AS first_eot FROM g),
c AS (SELECT doc_id, gen, first_eot,
        list_filter(CASE WHEN first_eot > 0 THEN list_slice(gen, 1, first_eot - 1) ELSE gen END, lambda t: t < {BYTE_VOCAB_SIZE}) AS clean,
        list_transform(gen, lambda t, i: CASE WHEN first_eot > 0 AND i > first_eot THEN {EOT} ELSE t END) AS pinned
      FROM p)
SELECT doc_id, len(gen) AS n_gen, first_eot, len(clean) AS n_clean, md5(array_to_string(clean, ',')) AS clean_md5,
       md5(array_to_string(pinned, ',')) AS pinned_md5 FROM c"""


@query("generation_cleanup", _GEN_SQL)
def generation_cleanup(spark, sf):
    """Generations stand-in: each document's ids with an EOT planted at
    ``doc_id % 50`` and two padding-row ids appended (every tenth has no EOT)."""
    d = _docs(spark, sf).select("doc_id", doc_ids("text").alias("ids"))
    p = (F.col("doc_id") % 50).cast("int")
    gen = F.when(F.col("doc_id") % 10 == 9,
                 F.concat(F.slice("ids", 1, F.size("ids") - 1), F.array(F.lit(300), F.lit(319)))) \
        .otherwise(F.concat(F.slice("ids", 1, p), F.array(F.lit(EOT)),
                            F.slice("ids", p + 1, F.greatest(F.size("ids") - p, F.lit(0))),
                            F.array(F.lit(300), F.lit(319))))
    g = d.select("doc_id", gen.alias("gen")).withColumn("first_eot", F.array_position("gen", EOT).cast("int"))
    clean = V.drop_padding(V.cut_at_eot(F.col("gen")), BYTE_VOCAB_SIZE)
    return g.select("doc_id", F.size("gen").alias("n_gen"), "first_eot",
                    F.size(clean).alias("n_clean"), ids_digest(clean).alias("clean_md5"),
                    ids_digest(V.pin_after_eot(F.col("gen"), F.col("first_eot"))).alias("pinned_md5"))


# DuckDB's regexes know no look-ahead: a white-space run of two or more before
# other text is one piece there, and the run without its last character is one
# piece here. If that last one is a space it joins the next piece (the same
# number of pieces); otherwise it is a piece of its own, counted by the second term.
@query("pretoken_counts", r"""
SELECT doc_id,
       CAST(len(regexp_extract_all(text, '\'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+'))
            + len(regexp_extract_all(text, '\s[\t\n\r\f]\S')) AS BIGINT) AS n_pieces,
       md5(text) AS text_md5
FROM documents WHERE text IS NOT NULL""".replace("\\'", "''"))
def pretoken_counts(spark, sf):
    """Pre-tokens of the split pattern per document, and the md5 of all of them
    joined, which must be the text's (T1)."""
    counted = BPE.pretoken_digests(_docs(spark, sf))
    return _docs(spark, sf).select("doc_id").join(counted, "doc_id", "left").select(
        "doc_id", F.coalesce("n_pieces", F.lit(0)).alias("n_pieces"), F.coalesce("text_md5", F.md5(F.lit(""))).alias("text_md5"))


@query("bpe_roundtrip", """
SELECT doc_id, md5(text || '<|endoftext|>') AS text_md5 FROM documents WHERE text IS NOT NULL""")
def bpe_roundtrip(spark, sf):
    """Encode every document with a BPE rank table, decode, and digest:
    decode(encode(text)) must reproduce the text (U1, T6)."""
    ranks = fixture_ranks(spark, sf)
    eot = max(ranks.values()) + 1
    enc = BPE.bpe_encode(_docs(spark, sf).select("doc_id", "text"), ranks, eot)
    dec = V.decoder(V.bpe_vocab(spark, ranks, "fixture-bpe"))
    return enc.select("doc_id", F.md5(dec("ids")).alias("text_md5"))
