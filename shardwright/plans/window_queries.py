"""Training-window queries over shards derived from documents / conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tokens import ids_digest
from ..operators import chat as C
from ..operators import choice as X
from ..operators import corpus as K
from ..operators import windows as W
from .. import jobs
from ..schemas import IGNORE_INDEX, SEED
from ..session import scratch_path
from . import chat_queries as CQ
from . import text_queries as TQ
from .registry import ORACLES, query, table
from .sqlfrag import bytes_of

# Test-scale parameters (survey 7.4): T = 256; 20 steps x 2 micro-batches x 8 rows.
T = 256
STEPS, ACCUM, BATCH = 20, 2, 8
N_DRAWS = STEPS * ACCUM * BATCH
TEXT_ITERS = 100
CHAT_EPOCHS = 3


def _u(*cols) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', '{SEED}', {', '.join(cols)})), 1, 13))::BIGINT "
            f"/ 4503599627370496.0)")


_DRAWS = f"dr AS (SELECT i // {ACCUM * BATCH} AS step, (i // {BATCH}) % {ACCUM} AS micro, i % {BATCH} AS row FROM range({N_DRAWS}) t(i))"


def _pick_sql(shards_cte: str) -> str:
    return f"""
shw AS (SELECT split, shard_id, tokens,
               coalesce(sum(tokens) OVER (PARTITION BY split ORDER BY shard_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
               sum(tokens) OVER (PARTITION BY split) AS total FROM {shards_cte} WHERE split = 'train'),
{_DRAWS},
du AS (SELECT *, floor({_u("step", "micro")} * (SELECT max(total) FROM shw)) AS tt, {_u("step", "micro", "row")} AS u2 FROM dr),
pk AS (SELECT du.step, du.micro, du.row, shw.shard_id, shw.tokens AS shard_tokens, du.u2
       FROM du JOIN shw ON du.tt >= shw.lo AND du.tt < shw.lo + shw.tokens)"""


_TEXT_WS = (f"WITH RECURSIVE {TQ._D}, {TQ._SPLITS}, {TQ._BATCH}, {_pick_sql('sh')},\n"
            f"ws AS (SELECT step, micro, row, shard_id, CAST(floor(u2 * (shard_tokens - {T} - 1)) AS BIGINT) AS start FROM pk)")

_CHAT_SH = f"""
csh AS (SELECT split, shard_id, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sh GROUP BY split, shard_id),
vs AS (SELECT sh.split, sh.shard_id, sh.shard_start,
              row_number() OVER (PARTITION BY sh.split, sh.shard_id ORDER BY sh.shard_start) - 1 AS idx
       FROM sh JOIN csh USING (split, shard_id) WHERE sh.shard_start <= csh.tokens - {T} - 1),
nv AS (SELECT split, shard_id, count(*) AS n_valid FROM vs GROUP BY split, shard_id)"""

_CHAT_WS = (f"WITH RECURSIVE {CQ._T}, {CQ._fit_sql(CQ.CHAT_SPEC.max_len)}, {CQ._chat_split_sql(CQ.CHAT_SPEC)}, "
            f"{_CHAT_SH}, {_pick_sql('csh')},\n"
            f"""ws AS (SELECT pk.step, pk.micro, pk.row, pk.shard_id, vs.shard_start AS start
       FROM pk JOIN nv ON nv.split = 'train' AND nv.shard_id = pk.shard_id
               JOIN vs ON vs.split = 'train' AND vs.shard_id = pk.shard_id AND vs.idx = CAST(floor(pk.u2 * nv.n_valid) AS BIGINT))""")

CHAT_IDS_SQL = f"""
ct AS (SELECT conv_id, flatten(list(list_concat([257], {bytes_of("role || chr(10)")}, {bytes_of("text")}, [258, 10]) ORDER BY turn)) AS toks,
              flatten(list(list_concat(list_resize([]::INTEGER[], strlen(role) + 2, 0),
                  list_resize([]::INTEGER[], strlen(text) + 1, CASE WHEN supervised THEN 1 ELSE 0 END), [0]) ORDER BY turn)) AS msk
       FROM k GROUP BY conv_id)"""

_CHAT_GATHER = f"""{CHAT_IDS_SQL},
dd AS (SELECT sh.shard_id, sh.conv_id, sh.shard_start AS p, sh.n_tokens AS n FROM sh WHERE sh.split = 'train'),
ov AS (SELECT w.*, dd.conv_id, dd.p, dd.n FROM ws w JOIN dd ON dd.shard_id = w.shard_id AND dd.p < w.start + {T + 1} AND dd.p + dd.n > w.start),
g AS (SELECT ov.*, list_slice(ct.toks, greatest(start - p, 0) + 1, least(start + {T + 1} - p, n)) AS piece,
             list_slice(ct.msk, greatest(start - p, 0) + 1, least(start + {T + 1} - p, n)) AS mpiece
      FROM ov JOIN ct USING (conv_id)),
cat AS (SELECT step, micro, row, shard_id, start, flatten(list(piece ORDER BY p)) AS win, flatten(list(mpiece ORDER BY p)) AS mwin
        FROM g GROUP BY step, micro, row, shard_id, start),
xy AS (SELECT step, micro, row, shard_id, start, list_slice(win, 1, {T}) AS x,
              list_transform(list_zip(list_slice(win, 2, {T + 1}), list_slice(mwin, 2, {T + 1})),
                             lambda z: CASE WHEN z[2] = 1 THEN z[1] ELSE {IGNORE_INDEX} END) AS y FROM cat)"""


def _text_job(spark, sf):
    docs = TQ._docs(spark, sf)
    streams, sb, shards, _ = K.tokenize_corpus(docs, TQ.SPEC)
    return docs, streams, sb, shards


def _chat_job(spark, sf):
    convs, shards, counters = C.tokenize_chat(CQ._turns(spark, sf), CQ.CHAT_SPEC)
    return convs.checkpoint(), shards.checkpoint(), counters


def _text_starts(spark, sf):
    docs, streams, sb, shards = _text_job(spark, sf)
    wts = W.shard_weights(shards)
    picked = W.pick_shards(W.draws(spark, STEPS, ACCUM, BATCH), wts, "train", SEED, TQ.S)
    return W.text_starts(picked, T, SEED), (docs, streams, sb, shards)


def _chat_starts(spark, sf):
    convs, shards, _ = _chat_job(spark, sf)
    wts = W.shard_weights(shards)
    picked = W.pick_shards(W.draws(spark, STEPS, ACCUM, BATCH), wts, "train", SEED, CQ.CHAT_SPEC.shard_tokens)
    valid, counts = W.valid_chat_starts(convs.select("split", "shard_id", "shard_start"), shards, T)
    return W.chat_starts(picked, valid, counts, SEED), convs


@query("shard_weights", f"""
WITH RECURSIVE {TQ._D}, {TQ._SPLITS}, {TQ._BATCH}
SELECT split, shard_id, tokens, round(tokens / sum(tokens) OVER (PARTITION BY split), 6) AS weight FROM sh""")
def shard_weights(spark, sf):
    _, _, _, shards = _text_job(spark, sf)
    return W.shard_weights(shards).select("split", "shard_id", "tokens", F.round("weight", 6).alias("weight"))


@query("budget", f"""
WITH RECURSIVE {TQ._D}, {TQ._SPLITS}, {TQ._BATCH},
tt AS (SELECT sum(tokens) AS tokens FROM sh WHERE split = 'train')
SELECT 'text' AS kind, CAST({ACCUM * BATCH * T} AS BIGINT) AS tokens_per_iter, CAST({TEXT_ITERS} AS BIGINT) AS max_iters,
       CAST({TEXT_ITERS * ACCUM * BATCH * T} AS BIGINT) AS total_tokens,
       round({TEXT_ITERS * ACCUM * BATCH * T} / tokens, 6) AS epochs FROM tt""")
def budget(spark, sf):
    _, _, _, shards = _text_job(spark, sf)
    tt = shards.filter("split = 'train'").agg(F.sum("tokens").alias("tokens"))
    return tt.select(F.lit("text").alias("kind"), *W.budget_row(F.col("tokens"), T, BATCH, ACCUM, max_iters=TEXT_ITERS))


@query("chat_budget", f"""
{_CHAT_WS.split(chr(10) + "ws AS")[0]}
SELECT 'chat' AS kind, CAST({ACCUM * BATCH * T} AS BIGINT) AS tokens_per_iter,
       CAST(greatest(1, floor({float(CHAT_EPOCHS)} * t / {ACCUM * BATCH * T})) AS BIGINT) AS max_iters,
       CAST(greatest(1, floor({float(CHAT_EPOCHS)} * t / {ACCUM * BATCH * T})) * {ACCUM * BATCH * T} AS BIGINT) AS total_tokens,
       round(greatest(1, floor({float(CHAT_EPOCHS)} * t / {ACCUM * BATCH * T})) * {ACCUM * BATCH * T} / t, 6) AS epochs
FROM (SELECT sum(tokens) AS t FROM csh WHERE split = 'train')""")
def chat_budget(spark, sf):
    _, shards, _ = _chat_job(spark, sf)
    tt = shards.filter("split = 'train'").agg(F.sum("tokens").alias("tokens"))
    return tt.select(F.lit("chat").alias("kind"), *W.budget_row(F.col("tokens"), T, BATCH, ACCUM, epochs=CHAT_EPOCHS))


@query("window_starts", f"{_TEXT_WS}\nSELECT step, micro, row, shard_id, start FROM ws")
def window_starts(spark, sf):
    s, _ = _text_starts(spark, sf)
    return s.select("step", "micro", "row", "shard_id", "start")


@query("window_gather", f"""{_TEXT_WS},
dd AS (SELECT st.split, sb.shard_id, st.doc_id, st.n_kept,
              st.tok_start - min(st.tok_start) OVER (PARTITION BY st.split, sb.shard_id) AS p
       FROM st JOIN sb USING (split, batch) WHERE st.split = 'train'),
ov AS (SELECT w.*, dd.doc_id, dd.p, dd.n_kept FROM ws w JOIN dd ON dd.shard_id = w.shard_id
       AND dd.p < w.start + {T + 1} AND dd.p + dd.n_kept > w.start),
g AS (SELECT ov.*, list_slice(list_slice({TQ.DOC_IDS_SQL}, 1, n_kept), greatest(start - p, 0) + 1,
                              least(start + {T + 1} - p, n_kept)) AS piece
      FROM ov JOIN documents USING (doc_id)),
cat AS (SELECT step, micro, row, shard_id, start, flatten(list(piece ORDER BY p)) AS win
        FROM g GROUP BY step, micro, row, shard_id, start)
SELECT step, micro, row, shard_id, start, md5(array_to_string(list_slice(win, 1, {T}), ',')) AS x_md5,
       md5(array_to_string(list_slice(win, 2, {T + 1}), ',')) AS y_md5 FROM cat""")
def window_gather(spark, sf):
    starts, (docs, streams, sb, shards) = _text_starts(spark, sf)
    # Only documents that a drawn window touches are encoded.
    place = streams.filter("split = 'train'").join(sb.select("split", "batch", "shard_id"), ["split", "batch"])
    base = place.groupBy("split", "shard_id").agg(F.min("tok_start").alias("__b"))
    place = place.join(base, ["split", "shard_id"]).withColumn("pos", F.col("tok_start") - F.col("__b"))
    needed = W.needed_chunks(starts, T)
    touched = W.chunks_of(place, "pos", "n_kept", T).join(needed, ["split", "shard_id", "chunk"], "left_semi").select("doc_id").distinct()
    rows = K.shard_tokens_rows(streams.filter("split = 'train'").join(touched, "doc_id", "left_semi"), sb, docs)
    rows = rows.join(place.select("doc_id", "pos"), "doc_id")
    chunks = W.chunk_stream(rows, "pos", "n_kept", ["tokens"], T, needed)
    win = W.text_windows(W.gather(starts, chunks, ["tokens"], T), T)
    return win.select("step", "micro", "row", "shard_id", "start",
                      ids_digest("x").alias("x_md5"), ids_digest("y").alias("y_md5"))


@query("window_file_reads", ORACLES["window_gather"])
def window_file_reads(spark, sf):
    """The windows of ``window_gather``, read from the ``.bin`` files that the text job writes."""
    out = scratch_path(spark, "window-files")
    jobs.tokenize_corpus(spark, TQ._docs(spark, sf), out, TQ.SPEC)
    win = jobs.sample_windows(spark, f"{out}/bin", T, STEPS, ACCUM, BATCH)
    return win.select("step", "micro", "row", "shard_id", "start", ids_digest("x").alias("x_md5"), ids_digest("y").alias("y_md5"))


@query("chat_window_starts", f"{_CHAT_WS}\nSELECT step, micro, row, shard_id, start FROM ws")
def chat_window_starts(spark, sf):
    s, _ = _chat_starts(spark, sf)
    return s.select("step", "micro", "row", "shard_id", "start")


def _chat_windows(spark, sf):
    starts, convs = _chat_starts(spark, sf)
    rows = convs.filter("split = 'train'").select("split", "shard_id", "shard_start", "n_tokens", "tokens", "mask")
    chunks = W.chunk_stream(rows, "shard_start", "n_tokens", ["tokens", "mask"], T, W.needed_chunks(starts, T))
    return W.chat_windows(W.gather(starts, chunks, ["tokens", "mask"], T), T)


@query("chat_window_targets", f"""{_CHAT_WS}, {_CHAT_GATHER}
SELECT step, micro, row, shard_id, start, md5(array_to_string(x, ',')) AS x_md5, md5(array_to_string(y, ',')) AS y_md5,
       len(list_filter(y, lambda v: v <> {IGNORE_INDEX})) AS n_targets FROM xy""")
def chat_window_targets(spark, sf):
    w = _chat_windows(spark, sf)
    return w.select("step", "micro", "row", "shard_id", "start", ids_digest("x").alias("x_md5"),
                    ids_digest("y").alias("y_md5"),
                    F.size(F.filter("y", lambda v: v != IGNORE_INDEX)).alias("n_targets"))


@query("chat_window_file_reads", ORACLES["chat_window_targets"])
def chat_window_file_reads(spark, sf):
    """The windows of ``chat_window_targets``, read from the files that the chat job writes."""
    out = scratch_path(spark, "chat-window-files")
    jobs.tokenize_chat(spark, CQ._turns(spark, sf), out, CQ.CHAT_SPEC)
    w = jobs.sample_windows(spark, f"{out}/shards", T, STEPS, ACCUM, BATCH)
    return w.select("step", "micro", "row", "shard_id", "start", ids_digest("x").alias("x_md5"), ids_digest("y").alias("y_md5"),
                    F.size(F.filter("y", lambda v: v != IGNORE_INDEX)).alias("n_targets"))


@query("masked_mean_loss", f"""{_CHAT_WS}, {_CHAT_GATHER},
dids AS (SELECT {TQ.DOC_IDS_SQL} AS ids FROM documents WHERE text IS NOT NULL),
codes AS (SELECT unnest(list_transform(range(1, len(ids)), lambda i: ids[i] * 259 + ids[i + 1])) AS code FROM dids),
pairs AS (SELECT CAST(code // 259 AS INTEGER) AS prev, CAST(code % 259 AS INTEGER) AS cur, count(*) AS c FROM codes GROUP BY code),
uni AS (SELECT prev, sum(c) AS cp FROM pairs GROUP BY prev),
pos AS (SELECT step, micro, row, x, y, unnest(range(1, {T + 1})) AS i FROM xy),
tg AS (SELECT step, micro, x[i] AS prev, y[i] AS cur FROM pos WHERE y[i] <> {IGNORE_INDEX}),
ls AS (SELECT step, micro, -ln((coalesce(c, 0) + 1) / (coalesce(cp, 0) + 259)) AS loss
       FROM tg LEFT JOIN pairs USING (prev, cur) LEFT JOIN uni USING (prev)),
mb AS (SELECT step, micro, sum(loss) AS s, count(*) AS n FROM ls GROUP BY step, micro)
SELECT step, round(avg(s / n), 6) AS micro_mean, round(sum(s) / sum(n), 6) AS token_mean FROM mb GROUP BY step""")
def masked_mean_loss(spark, sf):
    """Masked mean loss (A16): ignored targets leave numerator and
    denominator; per step the equal-weight mean of micro-batch means and the
    token-weighted mean (A17), scored with the stand-in bigram table."""
    w = _chat_windows(spark, sf)
    pairs, uni = X.bigram_table(table(spark, sf, "documents"))
    pos = w.select("step", "micro", F.posexplode(F.arrays_zip("x", "y")).alias("i", "z")) \
        .select("step", "micro", F.col("z.x").alias("prev"), F.col("z.y").alias("cur")) \
        .filter(F.col("cur") != IGNORE_INDEX)
    j = pos.join(F.broadcast(pairs), ["prev", "cur"], "left").join(F.broadcast(uni), "prev", "left")
    loss = -F.log((F.coalesce("c", F.lit(0)) + 1) / (F.coalesce("cp", F.lit(0)) + 259))
    mb = j.select("step", "micro", loss.alias("loss")).groupBy("step", "micro").agg(
        F.sum("loss").alias("s"), F.count(F.lit(1)).alias("n"))
    return mb.groupBy("step").agg(F.round(F.avg(F.col("s") / F.col("n")), 6).alias("micro_mean"),
                                  F.round(F.sum("s") / F.sum("n"), 6).alias("token_mean"))
