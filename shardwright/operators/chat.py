"""Chat rendering, fitting, splitting and sharding, over bytes or BPE ids.

A turn renders as ``[IM_START] role "\\n" | content [IM_END] | "\\n"`` with mask
0 on the header, ``role in train_roles`` on content + IM_END, 0 on the
newline. Over bytes its length is known without encoding (role bytes + text
bytes + 4), so ids are built only for kept turns; for BPE, turns that can fit by
their bytes are encoded once before they are fitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import ids_digest, utf8_ids
from ..schemas import BYTES, ChatSpec, Vocab
from .order import ordinal, reset_segments


def turns_from_messages(df: DataFrame, id_col: str = "conv_id",
                        messages_col: str = "messages") -> DataFrame:
    """Nested ``messages ARRAY<STRUCT<role, content>>`` -> long form (S4). A
    conversation without messages keeps one row with a null ``turn``, so that it
    is still counted as seen."""
    return df.select(F.col(id_col).alias("conv_id"),
                     F.posexplode_outer(messages_col).alias("turn", "m")) \
        .select("conv_id", F.col("turn").cast("long"), F.col("m.role").alias("role"),
                F.col("m.content").alias("text"))


def _encoded(turns: DataFrame) -> bool:
    return "text_ids" in turns.columns


def turn_lengths(turns: DataFrame, train_roles=("assistant",), vocab: Vocab = BYTES) -> DataFrame:
    """Tokens of each turn: by its bytes, or by its ids if ``encode_turns`` made
    them (the columns are kept)."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    sup = role.isin(list(train_roles))
    if _encoded(turns):
        n_role, n_text, ids = F.size("role_ids"), F.size("text_ids"), ["role_ids", "text_ids"]
    else:
        n_role, n_text, ids = F.octet_length(role) + 1, F.octet_length(text), []
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        (n_role + n_text + 2 + len(vocab.newline)).cast("long").alias("n_tokens"),
        sup.alias("supervised"),
        F.when(sup, n_text + 1).otherwise(0).cast("long").alias("n_supervised"), *ids)


def render_turn_ids(turns: DataFrame, vocab: Vocab = BYTES) -> DataFrame:
    """Add ``ids`` and ``mask`` arrays to rows of :func:`turn_lengths`."""
    if _encoded(turns):
        role_ids, text_ids = F.col("role_ids"), F.col("text_ids")
        n_role, n_text = F.size("role_ids"), F.size("text_ids")
    else:
        role_ids, text_ids = utf8_ids(F.concat(F.col("role"), F.lit("\n"))), utf8_ids("text")
        n_role, n_text = F.octet_length("role") + 1, F.octet_length("text")
    ids = F.concat(F.array(F.lit(vocab.im_start)), role_ids, text_ids,
                   F.array(F.lit(vocab.im_end), *[F.lit(i) for i in vocab.newline]))
    sup = F.col("supervised").cast("int")
    mask = F.concat(F.array_repeat(F.lit(0), n_role + 1), F.array_repeat(sup, n_text + 1),
                    F.array_repeat(F.lit(0), len(vocab.newline)))
    return turns.withColumn("ids", ids).withColumn("mask", mask)


def fit_turns(turns: DataFrame, max_len: int, train_roles=("assistant",), vocab: Vocab = BYTES) -> DataFrame:
    """Turns kept by the fit rule (T10/W6): the longest prefix of whole turns
    with running length <= max_len, cut back to its last supervised turn.

    A turn takes at least 4 tokens (delimiters, header end, newline), so only the first max_len / 4 turns of a
    conversation (by rank, whatever their numbers) can fit; the rank filter
    limits each conversation before its shuffle (WindowGroupLimit), however
    long it is.
    """
    t = turn_lengths(turns.filter(F.col("turn").isNotNull()), train_roles, vocab)
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    cand = t.withColumn("__rank", rank).filter(F.col("__rank") <= max_len // 4).drop("__rank")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    cand = cand.withColumn("cum", F.sum("n_tokens").over(w))
    last = F.max(F.when(F.col("supervised") & (F.col("cum") <= max_len), F.col("turn"))) \
        .over(Window.partitionBy("conv_id"))
    return cand.withColumn("last_kept", last).filter(F.col("turn") <= F.col("last_kept")) \
        .drop("last_kept")


def reachable_turns(turns: DataFrame, max_len: int, longest: int, vocab: Vocab) -> DataFrame:
    """The turns that the fit can keep or must measure, told before any is encoded: an id
    stands for at most ``longest`` bytes, so a turn of b bytes has at least b / longest
    ids. From where these sums pass ``max_len`` on, none can be kept. However long a
    conversation is, at most max_len / 4 of its turns are left."""
    least = lambda n: F.ceil(n / F.lit(longest))
    n = 2 + len(vocab.newline) + least(F.octet_length(F.coalesce(F.col("role"), F.lit(""))) + 1) \
        + least(F.octet_length(F.coalesce(F.col("text"), F.lit(""))))
    w = Window.partitionBy("conv_id").orderBy("turn")
    near = turns.filter(F.col("turn").isNotNull()).withColumn("__rank", F.row_number().over(w)) \
        .filter(F.col("__rank") <= max_len // 4)
    return near.withColumn("__least", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .filter(F.col("__least") <= max_len).drop("__rank", "__least")


def turns_given(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of all conversations, those without turns included."""
    return turns.groupBy("conv_id").agg(F.count("turn").alias("n_turns"))


def conversation_outcomes(turns: DataFrame, max_len: int, train_roles=("assistant",), vocab: Vocab = BYTES) -> DataFrame:
    """One row per conversation: turns given and kept, tokens, supervised,
    ``kept`` / ``truncated`` flags (A3 inputs)."""
    return outcomes_of(turns_given(turns), fit_turns(turns, max_len, train_roles, vocab))


def outcomes_of(given: DataFrame, fitted: DataFrame) -> DataFrame:
    """:func:`conversation_outcomes` from the turns given and those that fit."""
    kept = fitted.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("kept_turns"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_supervised").alias("n_supervised"))
    out = given.join(kept, "conv_id", "left")
    return out.select(
        "conv_id", "n_turns",
        F.coalesce("kept_turns", F.lit(0)).cast("long").alias("kept_turns"),
        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce("n_supervised", F.lit(0)).cast("long").alias("n_supervised"),
        F.col("kept_turns").isNotNull().alias("kept"),
        (F.col("kept_turns").isNotNull() & (F.col("kept_turns") < F.col("n_turns"))).alias("truncated"))


def render_conversations(turns: DataFrame) -> DataFrame:
    """Concatenate rendered turns per conversation in turn order.
    Input rows carry ``ids``/``mask``; one group is one conversation's kept
    turns (bounded by max_len tokens after fitting)."""
    g = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "ids", "mask"))).alias("segs"))
    return g.select("conv_id",
                    F.flatten(F.transform("segs", lambda x: x["ids"])).alias("tokens"),
                    F.flatten(F.transform("segs", lambda x: x["mask"])).alias("mask"))


def outcome_counters(outcomes: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """seen / kept / dropped / truncated / tokens / supervised (A3, A4)."""
    group_cols = list(group_cols or [])
    agg = outcomes.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if("kept").alias("kept"),
        F.count_if(~F.col("kept")).alias("dropped"),
        F.count_if("truncated").alias("truncated"),
        F.sum("n_tokens").cast("long").alias("tokens"),
        F.sum("n_supervised").cast("long").alias("supervised_tokens"))
    return agg.select(
        *group_cols, "seen", "kept", "dropped", "truncated", "tokens", "supervised_tokens",
        F.when(F.col("kept") > 0, F.round(F.col("supervised_tokens") / F.col("tokens"), 6))
        .alias("supervised_share"),
        F.when(F.col("kept") > 0, F.round(F.col("tokens") / F.col("kept"), 6))
        .alias("tokens_per_conv"))


def limit_kept(outcomes: DataFrame, max_examples: int | None) -> DataFrame:
    """Stop after ``max_examples`` kept conversations (O3): keep rows up to and
    including the conversation of the N-th kept one; None = no limit."""
    if max_examples is None:
        return outcomes
    nth = ordinal(outcomes.filter("kept").select("conv_id"), "conv_id", out="__ko") \
        .filter(F.col("__ko") == max_examples - 1).agg(F.max("conv_id")).scalar()
    return outcomes.filter(nth.isNull() | (F.col("conv_id") <= nth))


def split_conversations(outcomes: DataFrame, spec: ChatSpec,
                        val_outcomes: DataFrame | None = None) -> DataFrame:
    """Add ``split``. With a separate val table, each table is limited on its
    own; otherwise val is the front of the table up to the ``val_examples``-th
    kept conversation and train is everything after it."""
    if val_outcomes is not None:
        val = limit_kept(val_outcomes, spec.val_examples).withColumn("split", F.lit("val"))
        train = limit_kept(outcomes, spec.max_examples).withColumn("split", F.lit("train"))
        return val.unionByName(train)
    if spec.val_examples is None:
        return limit_kept(outcomes, spec.max_examples).withColumn("split", F.lit("train"))
    val = limit_kept(outcomes, spec.val_examples)
    bound = val.agg(F.max("conv_id")).scalar()
    rest = outcomes.filter(F.col("conv_id") > bound)
    train = limit_kept(rest, spec.max_examples)
    return val.withColumn("split", F.lit("val")).unionByName(train.withColumn("split", F.lit("train")))


def shard_conversations(split_outcomes: DataFrame, shard_tokens: int) -> DataFrame:
    """Kept conversations in (split, conv_id) order, packed into shards that roll
    after the conversation that takes them to >= shard_tokens (W5, H3), with
    each conversation's offset inside its shard (W9)."""
    kept = split_outcomes.filter("kept").select("split", "conv_id", "n_tokens", "n_supervised")
    kept = ordinal(kept, "conv_id", out="kord", part_cols=["split"])
    seg = reset_segments(kept, "kord", "n_tokens", shard_tokens, part_cols=["split"], out="shard_id")
    base = seg.groupBy("split", "shard_id").agg(
        F.min(F.col("__end") - F.col("n_tokens")).alias("__sb"))
    seg = seg.join(base, ["split", "shard_id"])
    # Conversation-level and narrow; every later step reads it: checkpoint.
    return seg.select("split", "conv_id", "kord", "shard_id", "n_tokens", "n_supervised",
                      (F.col("__end") - F.col("n_tokens") - F.col("__sb")).alias("shard_start")).checkpoint()


def shard_file(split_col: str = "split", shard_col: str = "shard_id") -> F.Column:
    """``{split}_{shard:06d}.bin``."""
    return F.format_string("%s_%06d.bin", F.col(split_col), F.col(shard_col))


def chat_shard_table(sharded: DataFrame) -> DataFrame:
    """Per (split, shard): file, tokens, examples, supervised (S7 summary)."""
    return sharded.groupBy("split", "shard_id").agg(
        F.sum("n_tokens").cast("long").alias("tokens"),
        F.count(F.lit(1)).alias("examples"),
        F.sum("n_supervised").cast("long").alias("supervised_tokens"),
        F.min("conv_id").alias("first_conv"),
        F.max("conv_id").alias("last_conv"),
    ).withColumn("file", shard_file())


def tokenize_chat(turns: DataFrame, spec: ChatSpec, val_turns: DataFrame | None = None, vocab: Vocab = BYTES, encode=None):
    """The chat job: returns (conversation rows with tokens/mask/shard, shard
    table, outcome counters per split). For BPE, ``encode`` is called with the
    turns that can fit. Turns are fitted once and written; outcomes and rows come
    from what was written."""
    def fitted(turns):
        if turns is None:
            return None, None
        fit = fit_turns(encode(turns) if encode else turns, spec.max_len, spec.train_roles, vocab).checkpoint()
        return fit, outcomes_of(turns_given(turns), fit).checkpoint()

    def rendered(fit, sharded):
        return sharded.join(render_conversations(render_turn_ids(
            fit.join(sharded.select("conv_id"), "conv_id", "left_semi"), vocab)), "conv_id")

    (fit, out), (vfit, vout) = fitted(turns), fitted(val_turns)
    split = split_conversations(out, spec, vout).checkpoint()
    counters = outcome_counters(split, ["split"])
    sharded = shard_conversations(split, spec.shard_tokens)
    if vfit is None:
        convs = rendered(fit, sharded)
    else:  # two tables number their conversations independently, so each split meets its own
        convs = rendered(fit, sharded.filter("split = 'train'")).unionByName(rendered(vfit, sharded.filter("split = 'val'")))
    return convs, chat_shard_table(sharded), counters


__all__ = [
    "turns_from_messages", "turn_lengths", "render_turn_ids", "fit_turns", "reachable_turns",
    "turns_given", "outcomes_of", "conversation_outcomes", "render_conversations", "outcome_counters", "limit_kept",
    "split_conversations", "shard_conversations", "chat_shard_table", "tokenize_chat",
    "shard_file", "ids_digest",
]
