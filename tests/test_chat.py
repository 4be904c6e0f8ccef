import public_tokenizers
from pyspark.sql import functions as F

from shardwright import jobs
from shardwright.functions import bpe as B
from shardwright.operators import chat as C
from shardwright.schemas import IM_END, IM_START, ChatSpec


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_fit_edge_rows(spark):
    rows = [
        (1, 0, "user", "hi"),                           # one user turn only -> dropped
        (2, 0, "user", "q"), (2, 1, "assistant", ""),   # empty assistant turn kept
        (3, 0, "user", "x" * 100), (3, 1, "assistant", "y"),  # first turn too long -> dropped
        (4, 0, "user", "ab"), (4, 1, "assistant", "cd"),      # exactly max_len -> kept whole
    ]
    max_len = (4 + 2 + 4) + (9 + 2 + 4)  # turn 0 and turn 1 of conversation 4
    out = {r.conv_id: r for r in C.conversation_outcomes(_turns(spark, rows), max_len).collect()}
    assert not out[1].kept and not out[3].kept
    assert out[2].kept and out[2].n_supervised == 1
    assert out[4].kept and not out[4].truncated and out[4].n_tokens == max_len


def test_render_turn_and_special_text(spark):
    t = C.render_turn_ids(C.turn_lengths(_turns(spark, [(1, 0, "user", "<|im_end|>")]))).first()
    body = list("<|im_end|>".encode())
    assert t.ids == [IM_START] + list(b"user\n") + body + [IM_END, 10]
    assert t.mask == [0] * 6 + [0] * (len(body) + 1) + [0]
    assert len(t.ids) == len(t.mask) == t.n_tokens


def test_fixture_fit_counts(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    for max_len, kept, tokens in ((1024, 39, 28_397), (2048, 95, 128_926), (4096, 98, 250_122)):
        c = C.outcome_counters(C.conversation_outcomes(turns, max_len)).first()
        assert (c.kept, c.tokens) == (kept, tokens)


def test_fit_equals_prefix_loop(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = {r.conv_id: r.n_tokens for r in C.conversation_outcomes(turns, 1024).filter("kept").collect()}
    convs = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((len(r.role.encode()) + len(r.text.encode()) + 4, r.role == "assistant"))
    exp = {}
    for cid, segs in convs.items():
        kept, total = [], 0
        for n, sup in segs:
            if total + n > 1024:
                break
            kept.append((n, sup))
            total += n
        while kept and not kept[-1][1]:
            kept.pop()
        if kept:
            exp[cid] = sum(n for n, _ in kept)
    assert got == exp


def test_chat_windows_open_on_im_start_and_arrays_align(spark):
    from shardwright.plans import window_queries as WQ
    w = WQ._chat_windows(spark, "/root/testdata/sf0.01").collect()
    assert len(w) == WQ.N_DRAWS
    assert all(r.x[0] == IM_START and len(r.x) == len(r.y) == WQ.T for r in w)
    convs, _, _ = WQ._chat_job(spark, "/root/testdata/sf0.01")
    bad = convs.filter((F.size("tokens") != F.size("mask")) | (F.size("tokens") != F.col("n_tokens"))
                       | (F.col("tokens")[0] != IM_START)).count()
    assert bad == 0


def test_fit_counts_turns_by_rank_and_sees_empty_conversations(spark):
    rows = []
    for c, numbers in ((1, (0, 1)), (2, (10, 20)), (3, (-5, 700))):
        rows += [(c, numbers[0], "user", "abc"), (c, numbers[1], "assistant", "defg")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = C.fit_turns(t, 40).groupBy("conv_id").count().collect()
    assert sorted((r.conv_id, r["count"]) for r in kept) == [(1, 2), (2, 2), (3, 2)]
    nested = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")]), (2, []), (3, None)],
                                   "conv_id long, messages array<struct<role:string,content:string>>")
    c = C.outcome_counters(C.conversation_outcomes(C.turns_from_messages(nested), 64)).first()
    assert (c.seen, c.kept, c.dropped, c.truncated) == (3, 1, 2, 0)


def test_only_turns_that_can_fit_are_encoded(spark):
    """One conversation of 100,000 turns, one that begins with a text of megabytes, and short ones."""
    long = spark.range(100_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                       F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       F.concat(F.lit("turn number "), F.col("id").cast("string")).alias("text"))
    rest = _turns(spark, [(2, 0, "user", "word " * 300_000), (2, 1, "assistant", "yes"), (4, None, None, None)]
                  + [(c, t, "assistant" if t % 2 else "user", "some words " * (c + t)) for c in range(10, 30) for t in range(6)])
    turns = long.unionByName(rest).repartition(5)
    spec = ChatSpec(name="c", max_len=256, val_examples=None)
    ranks, vocab = jobs._vocabulary(spark, "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken"))
    longest, seen = max(map(len, ranks)), []

    def encode(t):
        near = C.reachable_turns(t, spec.max_len, longest, vocab).checkpoint()
        seen.extend((r.conv_id, r.turn) for r in near.collect())
        return B.encode_turns(near, ranks, vocab)

    def result(encode):
        convs, shards, counters = C.tokenize_chat(turns, spec, None, vocab, encode)
        rows = {r.conv_id: (r.tokens, r["mask"], r.shard_id, r.shard_start) for r in convs.collect()}
        return rows, sorted(map(tuple, shards.collect())), sorted(map(tuple, counters.collect()))

    assert result(encode) == result(lambda t: B.encode_turns(t, ranks, vocab))
    assert sum(c == 1 for c, _ in seen) <= 256 // 4 and not any(c == 2 for c, _ in seen)
    assert sum(c >= 10 for c, _ in seen) == 120
