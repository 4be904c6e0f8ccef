"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_tree, collocations, fuzzy_lines, hard_negatives, mixing, packing, phrase_dedup, quality_gam, quality_rules, simhash, suffix_dedup, toxicity, vector_search
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return add


@query("op1_quality_gam")
def op1_quality_gam(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality_gam.classify(docs, quality_gam.train(docs, read(spark, sf_dir, "labels")))


@query("op2_suffix_groups", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT rid, doc_id, len(h) // 2 AS n, k, substr(h, 1000 * k + 1, 1200) AS part
      FROM (SELECT rid, doc_id, h, unnest(range(CAST((len(h) + 999) // 1000 AS BIGINT))) AS k FROM d)),
b AS (SELECT rid, doc_id, n, 500 * k + i AS pos, part, i
      FROM (SELECT *, unnest(range(CAST(least(500, n - 500 * k) AS BIGINT))) AS i FROM q)),
s AS (SELECT rid, doc_id, pos, substr(part, 2 * i + 1, 2) AS byte,
             CASE WHEN pos + 100 <= n THEN substr(part, 2 * i + 1, 200) END AS string FROM b),
r AS (SELECT rid, pos, byte, string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, rid, pos) > 1 AS later FROM s),
c AS (SELECT rid, pos, byte, bool_or(later) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY pos), false) AS opens FROM c),
g AS (SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
             string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM e GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g ON d.rid = g.rid
""")
def op2_suffix_groups(spark, sf_dir):
    length = lambda s: s["end"] - s["start"]
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + length(s)).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_block_search", r"""
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op3_block_search(spark, sf_dir):
    return vector_search.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op4_simhash_components")
def op4_simhash_components(spark, sf_dir):
    each = simhash.clusters(read(spark, sf_dir, "documents"))
    return each.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


@query("op5_fuzzy_lines")
def op5_fuzzy_lines(spark, sf_dir):
    return fuzzy_lines.deduped(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_mix_sources", r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         coalesce('=' || source, '~') AS src,
         ('0x' || substr(md5('mix-42:' || coalesce('=' || CAST(doc_id AS VARCHAR), '~')), 1, 8))::BIGINT AS h
  FROM documents),
c AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE length(bin(size)) * 8 + ((size * 8) >> CAST(length(bin(size)) - 1 AS BIGINT)) % 8 END AS cls
  FROM d),
s0 AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM c GROUP BY src),
s1 AS (SELECT *, (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS w,
              CAST(sum(source_size) OVER () AS BIGINT) AS total, source_size * 3 AS cap FROM s0),
s2 AS (SELECT *, CAST(cap AS DOUBLE) / w AS r FROM s1),
s3 AS (SELECT *,
         CAST(total - coalesce(sum(cap) OVER e, 0) AS DOUBLE)
         / CAST(sum(w) OVER () - coalesce(sum(w) OVER e, 0) AS DOUBLE) AS lvl
       FROM s2 WINDOW e AS (ORDER BY r, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, max(CASE WHEN lvl < r THEN lvl END) OVER () AS rest FROM s3),
s5 AS (SELECT src, source_size,
         CASE WHEN rest IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), rest * w) END AS target,
         ('0x' || substr(md5('mix-42:=' || src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
       FROM s4),
p AS (SELECT c.doc_id, c.size, s5.source_size, s5.target, s5.u,
         CASE WHEN s5.source_size = 0 THEN 0.0::DOUBLE ELSE least(s5.target / s5.source_size, 3.0::DOUBLE) END AS rate,
         row_number() OVER (PARTITION BY c.src ORDER BY c.cls, c.h, c.doc_id, c.size) AS k
      FROM c JOIN s5 ON c.src = s5.src),
q AS (SELECT *, CAST(floor(rate * k + u) - floor(rate * (k - 1) + u) AS BIGINT) AS copies FROM p)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM q
""")
def op6_mix_sources(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


@query("op7_fair_toxicity")
def op7_fair_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@query("op8_phrase_automata", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
s AS (SELECT rid, pos, word, list(word) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS seq FROM w),
r AS (SELECT rid, pos, word, len(seq) = 35 AND count(*) OVER (PARTITION BY seq) > 1 AS again FROM s),
c AS (SELECT rid, pos, word, bool_or(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM r),
g AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.rid = g.rid
""")
def op8_phrase_automata(spark, sf_dir):
    return phrase_dedup.remove_repeated(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_rule_ledger", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT d.rid, d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper
  FROM d JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
b AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
            + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (2 * n_upper > word_chars)::INT
            + 32 * (word_chars < 2 * n_words)::INT + 64 * (word_chars > 25 * n_words)::INT AS BIGINT) AS failure_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, failure_bits,
       (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, 'full' AS policy
FROM b
""")
def op9_rule_ledger(spark, sf_dir):
    return quality_rules.judge(quality_rules.ledger(read(spark, sf_dir, "documents")))


@query("op10_best_fit_pack")
def op10_best_fit_pack(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op11_bpe_tree")
def op11_bpe_tree(spark, sf_dir):
    ids = bpe_tree.encode(read(spark, sf_dir, "documents"))
    return bpe_tree.decode(ids.withColumn("ids_sha256", F.sha2("ids", 256))).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_hard_negatives", r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT row_number() OVER () AS anchor, * FROM (SELECT DISTINCT vec_id, label, v FROM e WHERE vec_id % 50 = 0)),
s AS (
  SELECT a.anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5),
n AS (
  SELECT p.anchor, p.anchor_id, p.place, p.vec_id AS positive_id, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""")
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op13_collocations", r"""
WITH p AS (
  SELECT row_number() OVER () AS pid, lang, w FROM (
    SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[.,;:!?\x0A-\x0D]')) AS x
      FROM documents))
  WHERE len(w) > 0),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, g, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, w[i:i + k - 1] AS g
        FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
              FROM p, (VALUES (1), (2), (3), (4), (5)) AS o(k) WHERE len(w) >= k))
  GROUP BY lang, g HAVING count(*) >= 100),
held AS (
  SELECT DISTINCT a.lang, a.g FROM g a
  JOIN (SELECT lang, f, g[1:len(g) - 1] AS g FROM g UNION ALL SELECT lang, f, g[2:] FROM g) b
  ON a.lang = b.lang AND a.g = b.g AND a.f = b.f),
cut AS (
  SELECT c.lang, c.g, c.f AS a, l.f AS l, r.f AS r, n, k, 1000 * c.f * n // (l.f * r.f) AS score
  FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS k FROM g WHERE len(g) >= 2) c
  JOIN g l ON l.lang = c.lang AND l.g = c.g[1:k]
  JOIN g r ON r.lang = c.lang AND r.g = c.g[k + 1:]
  JOIN total ON total.lang = c.lang),
best AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM cut c
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = c.lang AND h.g = c.g)
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
""")
def op13_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))
