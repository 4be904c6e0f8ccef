"""Chat-path queries (conversations table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tokens import ids_digest
from ..operators import chat as C
from ..operators.prompts import chat_prompt_ids, keep_tail, plain_prompt_ids
from ..schemas import EOT, IM_END, IM_START, ChatSpec
from .registry import query, table
from .sqlfrag import bytes_of, digest, zeros

# Test-scale parameters (survey 7.4): max_len 2048, 20,000-token shards, the
# first 20 kept conversations carved off as val.
MAX_LEN = 2048
CHAT_SPEC = ChatSpec(name="fixture-chat", max_len=MAX_LEN, shard_tokens=20_000,
                     val_examples=20, max_examples=None)
LIMIT_EXAMPLES = 25
PROMPT_BLOCK = 256


def _turns(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


# Oracle building blocks ------------------------------------------------------
_T = """
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         CAST(strlen(coalesce(role, '')) + strlen(coalesce(text, '')) + 4 AS BIGINT) AS n_tokens,
         coalesce(role, '') = 'assistant' AS supervised,
         CAST(CASE WHEN role = 'assistant' THEN strlen(text) + 1 ELSE 0 END AS BIGINT) AS n_supervised
  FROM conversations)"""

_RENDER = f"""
r AS (
  SELECT *, list_concat([{IM_START}], {bytes_of("role || chr(10)")}, {bytes_of("text")}, [{IM_END}, 10]) AS ids,
         list_concat({zeros("strlen(role) + 2")}, {zeros("strlen(text) + 1", "CASE WHEN supervised THEN 1 ELSE 0 END")}, [0]) AS mask
  FROM t)"""


def _fit_sql(max_len: int) -> str:
    return f"""
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM t),
l AS (SELECT *, max(CASE WHEN supervised AND cum <= {max_len} THEN turn END)
        OVER (PARTITION BY conv_id) AS last_kept FROM c),
k AS (SELECT * FROM l WHERE turn <= last_kept),
o AS (
  SELECT g.conv_id, g.n_turns, coalesce(kk.kept_turns, 0) AS kept_turns,
         coalesce(kk.n_tokens, 0) AS n_tokens, coalesce(kk.n_supervised, 0) AS n_supervised,
         kk.kept_turns IS NOT NULL AS kept,
         kk.kept_turns IS NOT NULL AND kk.kept_turns < g.n_turns AS truncated
  FROM (SELECT conv_id, count(*) AS n_turns FROM t GROUP BY conv_id) g
  LEFT JOIN (SELECT conv_id, count(*) AS kept_turns, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
                    CAST(sum(n_supervised) AS BIGINT) AS n_supervised
             FROM k GROUP BY conv_id) kk USING (conv_id))"""


_COUNTERS = """
  count(*) AS seen, count_if(kept) AS kept, count_if(NOT kept) AS dropped,
  count_if(truncated) AS truncated, CAST(sum(n_tokens) AS BIGINT) AS tokens,
  CAST(sum(n_supervised) AS BIGINT) AS supervised_tokens,
  CASE WHEN count_if(kept) > 0 THEN round(sum(n_supervised) / sum(n_tokens), 6) END AS supervised_share,
  CASE WHEN count_if(kept) > 0 THEN round(sum(n_tokens) / count_if(kept), 6) END AS tokens_per_conv"""


@query("turn_render", f"""
WITH {_T}, {_RENDER}
SELECT conv_id, turn, n_tokens, n_supervised, {digest("ids")} AS ids_md5, {digest("mask")} AS mask_md5
FROM r""")
def turn_render(spark, sf):
    t = C.render_turn_ids(C.turn_lengths(_turns(spark, sf)))
    return t.select("conv_id", "turn", "n_tokens", "n_supervised",
                    ids_digest("ids").alias("ids_md5"), ids_digest("mask").alias("mask_md5"))


@query("conv_render", f"""
WITH {_T}, {_RENDER}
SELECT conv_id, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, CAST(sum(n_supervised) AS BIGINT) AS n_supervised,
       {digest("flatten(list(ids ORDER BY turn))")} AS ids_md5,
       {digest("flatten(list(mask ORDER BY turn))")} AS mask_md5
FROM r GROUP BY conv_id""")
def conv_render(spark, sf):
    t = C.render_turn_ids(C.turn_lengths(_turns(spark, sf)))
    r = C.render_conversations(t)
    return r.select("conv_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_supervised"),
                    ids_digest("tokens").alias("ids_md5"), ids_digest("mask").alias("mask_md5"))


@query("conv_fit", f"""
WITH {_T}, {_fit_sql(MAX_LEN)}, r AS (
  SELECT k.*, list_concat([{IM_START}], {bytes_of("role || chr(10)")}, {bytes_of("text")}, [{IM_END}, 10]) AS ids,
         list_concat({zeros("strlen(role) + 2")}, {zeros("strlen(text) + 1", "CASE WHEN supervised THEN 1 ELSE 0 END")}, [0]) AS mask
  FROM k)
SELECT conv_id, count(*) AS kept_turns, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       CAST(sum(n_supervised) AS BIGINT) AS n_supervised,
       {digest("flatten(list(ids ORDER BY turn))")} AS ids_md5,
       {digest("flatten(list(mask ORDER BY turn))")} AS mask_md5
FROM r GROUP BY conv_id""")
def conv_fit(spark, sf):
    kept = C.fit_turns(_turns(spark, sf), MAX_LEN)
    r = C.render_conversations(C.render_turn_ids(kept))
    n = kept.groupBy("conv_id").agg(F.count(F.lit(1)).alias("kept_turns"))
    return r.join(n, "conv_id").select(
        "conv_id", "kept_turns", F.size("tokens").cast("long").alias("n_tokens"),
        F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_supervised"),
        ids_digest("tokens").alias("ids_md5"), ids_digest("mask").alias("mask_md5"))


@query("conv_outcomes", f"""
WITH {_T}, {_fit_sql(1024)}, o1 AS (SELECT 1024 AS max_len, * FROM o),
     {_fit_sql(2048).replace("c AS (", "c2 AS (").replace("FROM c)", "FROM c2)").replace("l AS (", "l2 AS (").replace("FROM l WHERE", "FROM l2 WHERE").replace("k AS (", "k2 AS (").replace("FROM k GROUP", "FROM k2 GROUP").replace("o AS (", "o2 AS (")},
     oo AS (SELECT * FROM o1 UNION ALL SELECT 2048 AS max_len, * FROM o2)
SELECT max_len, {_COUNTERS} FROM oo GROUP BY max_len""")
def conv_outcomes(spark, sf):
    turns = _turns(spark, sf)
    parts = [C.outcome_counters(C.conversation_outcomes(turns, m)).select(F.lit(m).alias("max_len"), "*")
             for m in (1024, 2048)]
    return parts[0].unionByName(parts[1])


@query("conv_limit", f"""
WITH {_T}, {_fit_sql(1024)},
b AS (SELECT max(conv_id) AS bound FROM (SELECT conv_id FROM o WHERE kept ORDER BY conv_id LIMIT {LIMIT_EXAMPLES}))
SELECT {_COUNTERS} FROM o, b WHERE o.conv_id <= b.bound""")
def conv_limit(spark, sf):
    out = C.conversation_outcomes(_turns(spark, sf), 1024).checkpoint()
    return C.outcome_counters(C.limit_kept(out, LIMIT_EXAMPLES))


def _chat_split_sql(spec: ChatSpec) -> str:
    return f"""
ko AS (SELECT conv_id FROM o WHERE kept ORDER BY conv_id LIMIT {spec.val_examples}),
vb AS (SELECT max(conv_id) AS vb FROM ko),
s AS (SELECT o.*, CASE WHEN o.conv_id <= vb.vb THEN 'val' ELSE 'train' END AS split FROM o, vb),
kept AS (SELECT split, conv_id, n_tokens, n_supervised,
                row_number() OVER (PARTITION BY split ORDER BY conv_id) - 1 AS kord
         FROM s WHERE kept),
walk AS (
  SELECT split, kord, n_tokens AS acc, 0 AS shard_id, 0::BIGINT AS start_in_shard
  FROM kept WHERE kord = 0
  UNION ALL
  SELECT k.split, k.kord,
         CASE WHEN w.acc >= {spec.shard_tokens} THEN k.n_tokens ELSE w.acc + k.n_tokens END,
         CASE WHEN w.acc >= {spec.shard_tokens} THEN w.shard_id + 1 ELSE w.shard_id END,
         CASE WHEN w.acc >= {spec.shard_tokens} THEN 0 ELSE w.acc END
  FROM walk w JOIN kept k ON k.split = w.split AND k.kord = w.kord + 1),
sh AS (SELECT kept.*, walk.shard_id, walk.start_in_shard AS shard_start FROM kept JOIN walk USING (split, kord))"""


@query("chat_shards", f"""
WITH RECURSIVE {_T}, {_fit_sql(CHAT_SPEC.max_len)}, {_chat_split_sql(CHAT_SPEC)}
SELECT split, shard_id, printf('%s_%06d.bin', split, shard_id) AS file,
       CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS examples,
       CAST(sum(n_supervised) AS BIGINT) AS supervised_tokens,
       min(conv_id) AS first_conv, max(conv_id) AS last_conv,
       md5(string_agg(CAST(shard_start AS VARCHAR), ',' ORDER BY conv_id)) AS starts_md5
FROM sh GROUP BY split, shard_id""")
def chat_shards(spark, sf):
    out = C.conversation_outcomes(_turns(spark, sf), CHAT_SPEC.max_len).checkpoint()
    sharded = C.shard_conversations(C.split_conversations(out, CHAT_SPEC).checkpoint(),
                                    CHAT_SPEC.shard_tokens)
    starts = sharded.groupBy("split", "shard_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "shard_start"))),
                                       lambda x: x["shard_start"].cast("string")), ",")).alias("starts_md5"))
    return C.chat_shard_table(sharded).join(starts, ["split", "shard_id"]).select(
        "split", "shard_id", "file", "tokens", "examples", "supervised_tokens",
        "first_conv", "last_conv", "starts_md5")


@query("chat_manifest", f"""
WITH RECURSIVE {_T}, {_fit_sql(CHAT_SPEC.max_len)}, {_chat_split_sql(CHAT_SPEC)},
cnt AS (SELECT split, {_COUNTERS} FROM s GROUP BY split),
shn AS (SELECT split, count(DISTINCT shard_id) AS n_shards FROM sh GROUP BY split)
SELECT cnt.split, tokens, supervised_tokens, kept AS examples, n_shards, seen, dropped, truncated,
       supervised_share, tokens_per_conv
FROM cnt JOIN shn USING (split)""")
def chat_manifest(spark, sf):
    convs, shards, counters = C.tokenize_chat(_turns(spark, sf), CHAT_SPEC)
    shn = shards.groupBy("split").agg(F.count(F.lit(1)).alias("n_shards"))
    return counters.join(shn, "split").select(
        "split", "tokens", "supervised_tokens", F.col("kept").alias("examples"), "n_shards",
        "seen", "dropped", "truncated", "supervised_share", "tokens_per_conv")


def _prompt_table(spark, sf):
    """Prompts from the conversations: each user turn, with its
    conversation's first system turn as the system prompt."""
    turns = _turns(spark, sf)
    sys_t = turns.filter("role = 'system'").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("system"))
    return turns.filter("role = 'user'").join(sys_t, "conv_id", "left") \
        .select("conv_id", "turn", F.col("text").alias("prompt"), "system")


@query("prompt_ids", f"""
WITH sys AS (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
p AS (SELECT c.conv_id, c.turn, c.text AS prompt, s.system FROM conversations c LEFT JOIN sys s USING (conv_id)
      WHERE c.role = 'user'),
ids AS (
  SELECT conv_id, turn,
    list_concat(
      CASE WHEN coalesce(system, '') <> '' THEN
        list_concat([{IM_START}], {bytes_of("'system' || chr(10)")}, {bytes_of("system")}, [{IM_END}, 10])
      ELSE []::INTEGER[] END,
      [{IM_START}], {bytes_of("'user' || chr(10)")}, {bytes_of("prompt")}, [{IM_END}, 10],
      [{IM_START}], {bytes_of("'assistant' || chr(10)")}) AS chat,
    CASE WHEN coalesce(prompt, '') = '' THEN [{EOT}]
      ELSE flatten(list_transform(string_split(prompt, '<|endoftext|>'),
             lambda x, i: CASE WHEN i = 1 THEN {bytes_of("x")} ELSE list_concat([{EOT}], {bytes_of("x")}) END))
    END AS plain
  FROM p)
SELECT conv_id, turn,
  len(list_slice(chat, greatest(len(chat) - {PROMPT_BLOCK} + 1, 1), len(chat))) AS chat_n,
  {digest(f"list_slice(chat, greatest(len(chat) - {PROMPT_BLOCK} + 1, 1), len(chat))")} AS chat_md5,
  len(list_slice(plain, greatest(len(plain) - {PROMPT_BLOCK} + 1, 1), len(plain))) AS plain_n,
  {digest(f"list_slice(plain, greatest(len(plain) - {PROMPT_BLOCK} + 1, 1), len(plain))")} AS plain_md5
FROM ids""")
def prompt_ids(spark, sf):
    p = _prompt_table(spark, sf)
    chat = keep_tail(chat_prompt_ids(F.col("prompt"), F.col("system")), PROMPT_BLOCK)
    plain = keep_tail(plain_prompt_ids(F.col("prompt")), PROMPT_BLOCK)
    return p.select("conv_id", "turn", F.size(chat).alias("chat_n"), ids_digest(chat).alias("chat_md5"),
                    F.size(plain).alias("plain_n"), ids_digest(plain).alias("plain_md5"))
