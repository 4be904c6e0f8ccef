"""Choice-evaluation queries (benchmark table + documents for the scorer)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tokens import ids_digest
from ..operators import choice as X
from .registry import ORACLES, query, table
from .sqlfrag import bytes_of, digest
from .text_queries import DOC_IDS_SQL

# Scoring uses the reference's block size, which nearly every example fits; the
# length-filter query uses a narrow one, so that it has something to drop.
BLOCK = 1024
NARROW_BLOCK = 192
BATCH = 16
LIMIT = 0


def _rendered(spark, sf):
    ch = X.choices_from_benchmark(table(spark, sf, "benchmark"))
    return X.render_choices(ch).checkpoint()


def _scored(spark, sf):
    r = _rendered(spark, sf)
    kept = X.length_filter(r, BLOCK, LIMIT).filter("kept").select("example_id")
    rk = r.join(kept, "example_id", "left_semi")
    pairs, uni = X.bigram_table(table(spark, sf, "documents"))
    scores = X.candidate_scores(X.token_losses(rk, pairs, uni))
    examples = rk.select("example_id", "label", "source").distinct()
    return scores, examples


_CH = f"""
it AS (SELECT item_id, string_split(coalesce(text, ''), ' ') AS w FROM benchmark),
it2 AS (SELECT item_id, array_to_string(list_slice(w, 1, len(w) // 2), ' ') AS ctx,
               array_to_string(list_slice(w, len(w) // 2 + 1, len(w)), ' ') AS ending,
               row_number() OVER (ORDER BY item_id) - 1 AS ord FROM it),
nn AS (SELECT count(*) AS n FROM it2),
pos AS (SELECT i.item_id, i.ord, CAST(i.item_id % 4 AS INTEGER) AS label, e.ending_idx
        FROM it2 i, (SELECT unnest(range(4)) AS ending_idx) e),
pos2 AS (SELECT p.*, CASE WHEN ending_idx = label THEN ord
           ELSE (ord + CASE WHEN ending_idx < label THEN ending_idx + 1 ELSE ending_idx END) % (SELECT n FROM nn) END AS src_ord
         FROM pos p),
rw AS (SELECT p.item_id AS example_id, p.ord, p.label, p.ending_idx,
              CASE WHEN p.item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source, i.ctx, s.ending
       FROM pos2 p JOIN it2 i ON i.item_id = p.item_id JOIN it2 s ON s.ord = p.src_ord),
r AS (SELECT *, strlen(ctx) AS n_ctx, strlen(ending) + 1 AS n_end,
             list_concat({bytes_of("ctx")}, {bytes_of("' ' || ending")}) AS ids FROM rw),
lf AS (SELECT example_id, ord, max(len(ids)) AS max_len, max(len(ids)) <= {BLOCK} AS kept FROM r GROUP BY example_id, ord)"""

_SCORE = f"""
dids AS (SELECT {DOC_IDS_SQL} AS ids FROM documents WHERE text IS NOT NULL),
codes AS (SELECT unnest(list_transform(range(1, len(ids)), lambda i: ids[i] * 259 + ids[i + 1])) AS code FROM dids),
pairs AS (SELECT CAST(code // 259 AS INTEGER) AS prev, CAST(code % 259 AS INTEGER) AS cur, count(*) AS c FROM codes GROUP BY code),
uni AS (SELECT prev, sum(c) AS cp FROM pairs GROUP BY prev),
rk AS (SELECT r.* FROM r JOIN lf USING (example_id) WHERE lf.kept),
tl0 AS (SELECT example_id, ending_idx, ids, unnest(range(greatest(n_ctx, 1), len(ids))) AS p FROM rk),
tl AS (SELECT example_id, ending_idx, p, ids[p] AS prev, ids[p + 1] AS cur FROM tl0),
ls AS (SELECT tl.*, -ln((coalesce(c, 0) + 1) / (coalesce(cp, 0) + 259)) AS loss
       FROM tl LEFT JOIN pairs USING (prev, cur) LEFT JOIN uni USING (prev)),
sc AS (SELECT example_id, ending_idx, sum(loss) AS sum_loss, count(*) AS n_tok, sum(loss) / count(*) AS per_token
       FROM ls GROUP BY example_id, ending_idx),
ex AS (SELECT DISTINCT example_id, label, source FROM rk),
pk AS (SELECT s.example_id, e.source, e.label,
         (SELECT ending_idx FROM sc s2 WHERE s2.example_id = s.example_id ORDER BY sum_loss, ending_idx LIMIT 1) AS pred,
         (SELECT ending_idx FROM sc s2 WHERE s2.example_id = s.example_id ORDER BY per_token, ending_idx LIMIT 1) AS pred_norm,
         sum(CASE WHEN s.ending_idx = e.label THEN per_token END) AS gold,
         sum(per_token) AS pt_sum, count(*) AS n_end
       FROM sc s JOIN ex e USING (example_id) GROUP BY s.example_id, e.source, e.label),
pk2 AS (SELECT example_id, source, label, pred, pred_norm, CAST(pred = label AS INTEGER) AS acc,
               CAST(pred_norm = label AS INTEGER) AS acc_norm, gold, pt_sum / n_end AS all_loss,
               (pt_sum - gold) / (n_end - 1) - gold AS margin FROM pk)"""


@query("choice_render", f"""
WITH {_CH}
SELECT example_id, ending_idx, label, source, n_ctx, n_end, len(ids) AS n_tokens, {digest("ids")} AS ids_md5 FROM r""")
def choice_render(spark, sf):
    r = _rendered(spark, sf)
    return r.select("example_id", "ending_idx", "label", "source", "n_ctx", "n_end",
                    F.size("ids").alias("n_tokens"), ids_digest("ids").alias("ids_md5"))


@query("choice_length_filter", f"WITH {_CH} SELECT example_id, max_len, max_len <= {NARROW_BLOCK} AS kept FROM lf")
def choice_length_filter(spark, sf):
    return X.length_filter(_rendered(spark, sf), NARROW_BLOCK, LIMIT).select("example_id", "max_len", "kept")


@query("choice_collate", f"""
WITH {_CH},
kk AS (SELECT example_id, (row_number() OVER (ORDER BY example_id) - 1) // {BATCH} AS batch FROM lf WHERE kept),
c AS (SELECT r.*, kk.batch, max(len(ids)) OVER (PARTITION BY kk.batch) AS width FROM r JOIN kk USING (example_id))
SELECT example_id, ending_idx, batch, width,
       {digest("list_concat(ids, list_resize([]::INTEGER[], width - len(ids), 0))")} AS ids_md5,
       {digest("list_concat(list_resize([]::INTEGER[], n_ctx, 0), list_resize([]::INTEGER[], n_end, 1), list_resize([]::INTEGER[], width - len(ids), 0))")} AS mask_md5
FROM c""")
def choice_collate(spark, sf):
    r = _rendered(spark, sf)
    c = X.collate(r, X.length_filter(r, BLOCK, LIMIT), BATCH)
    return c.select("example_id", "ending_idx", F.col("batch").cast("long"), "width",
                    ids_digest("ids").alias("ids_md5"), ids_digest("mask").alias("mask_md5"))


@query("choice_scores", f"""
WITH {_CH}, {_SCORE}
SELECT example_id, ending_idx, round(sum_loss, 6) AS sum_loss, n_tok, round(per_token, 6) AS per_token FROM sc""")
def choice_scores(spark, sf):
    s, _ = _scored(spark, sf)
    return s.select("example_id", "ending_idx", F.round("sum_loss", 6).alias("sum_loss"), "n_tok",
                    F.round("per_token", 6).alias("per_token"))


@query("choice_model_scores", ORACLES["choice_scores"])
def choice_model_scores(spark, sf):
    """The scores by a model that gets whole batches of padded ids."""
    r = _rendered(spark, sf)
    kept = X.length_filter(r, BLOCK, LIMIT).filter("kept").select("example_id")
    model = X.bigram_model(*X.bigram_table(table(spark, sf, "documents")))
    s = X.candidate_scores(X.model_losses(r.join(kept, "example_id", "left_semi"), model))
    return s.select("example_id", "ending_idx", F.round("sum_loss", 6).alias("sum_loss"), "n_tok",
                    F.round("per_token", 6).alias("per_token"))


@query("choice_picks", f"""
WITH {_CH}, {_SCORE}
SELECT example_id, source, label, pred, pred_norm, acc, acc_norm, round(gold, 6) AS gold,
       round(all_loss, 6) AS all_loss, round(margin, 6) AS margin FROM pk2""")
def choice_picks(spark, sf):
    s, ex = _scored(spark, sf)
    p = X.example_picks(s, ex)
    return p.select("example_id", "source", "label", "pred", "pred_norm", "acc", "acc_norm",
                    F.round("gold", 6).alias("gold"), F.round("all_loss", 6).alias("all_loss"),
                    F.round("margin", 6).alias("margin"))


@query("choice_report", f"""
WITH {_CH}, {_SCORE}
SELECT CASE WHEN grouping(source) = 1 THEN 'OVERALL' ELSE source END AS source, count(*) AS n,
       round(avg(acc), 6) AS acc, round(avg(acc_norm), 6) AS acc_norm, round(avg(gold), 6) AS loss,
       round(avg(all_loss), 6) AS "all", round(avg(margin), 6) AS margin
FROM pk2 GROUP BY ROLLUP (source)""")
def choice_report(spark, sf):
    s, ex = _scored(spark, sf)
    r = X.report(X.example_picks(s, ex))
    return r.select("source", "n", *[F.round(c, 6).alias(c) for c in ("acc", "acc_norm", "loss", "all", "margin")])
