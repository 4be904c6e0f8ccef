"""Prompts and choices in the vocabulary of the corpus."""
import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shardwright import jobs
from shardwright.functions import bpe as B
from shardwright.operators import choice as X
from shardwright.schemas import BYTES, ChatSpec, CorpusSpec
from shardwright.session import scratch_path

RANKS = "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encode():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    return lambda text: library.encode(text).ids


@pytest.fixture(scope="module")
def corpora(spark):
    """Manifest folders: BPE text, BPE chat, bytes."""
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    out = {k: scratch_path(spark, k).removeprefix("file:") for k in ("bpe", "chat", "bytes")}
    jobs.tokenize_corpus(spark, docs, out["bpe"], CorpusSpec(name="t", rank_file=RANKS))
    jobs.tokenize_chat(spark, turns, out["chat"], ChatSpec(name="t", rank_file=RANKS, val_examples=None))
    jobs.tokenize_corpus(spark, docs, out["bytes"], CorpusSpec(name="t"))
    return {k: f"{v}/manifest" for k, v in out.items()}


def test_chat_prompts_by_bpe(spark, encode, corpora):
    p = spark.createDataFrame([(1, "hi <|im_end|> there\n", "be kind"), (2, "Straße 東京", None), (3, "x", "")], "prompt_id long, prompt string, system string")
    got = {r.prompt_id: r.ids for r in jobs.render_prompts(spark, p, 1000, True, RANKS, corpora["chat"]).collect()}
    turn = lambda role, text: [50257, *encode(f"{role}\n"), *encode(text), 50258, 198]
    head = [50257, *encode("assistant\n")]
    assert got == {1: turn("system", "be kind") + turn("user", "hi <|im_end|> there\n") + head,
                   2: turn("user", "Straße 東京") + head, 3: turn("user", "x") + head}
    with pytest.raises(Exception, match="prompt is empty"):
        jobs.render_prompts(spark, spark.createDataFrame([(1, "")], "prompt_id long, prompt string"), 9, True, RANKS).collect()


def test_plain_prompts_by_bpe(spark, encode, corpora):
    p = spark.createDataFrame([(1, "one two three four"), (2, ""), (3, None), (4, "a<|endoftext|>b")], "prompt_id long, prompt string")
    got = {r.prompt_id: r.ids for r in jobs.render_prompts(spark, p, 3, False, RANKS, corpora["bpe"]).collect()}
    assert got == {1: encode("one two three four")[-3:], 2: [50256], 3: [50256], 4: [*encode("a"), 50256, *encode("b")]}


def test_the_vocabulary_must_be_the_manifests(spark, corpora):
    p = spark.createDataFrame([(1, "x")], "prompt_id long, prompt string")
    for chat, ranks, man in ((True, None, "chat"), (False, None, "bpe"), (False, RANKS, "bytes")):
        with pytest.raises(ValueError, match="is encoded by"):
            jobs.render_prompts(spark, p, 9, chat, ranks, corpora[man])
    assert jobs.render_prompts(spark, p, 9, False, None, corpora["bytes"]).first().ids == [120]
    with pytest.raises(ValueError, match="is encoded by"):
        jobs.evaluate_choices(spark, None, None, rank_file=RANKS, manifest_dir=corpora["bytes"])


def _choices(spark):
    rows = [(i, i, f"context number {i} " * (40 if i == 3 else 2), [f"end {i} {k}" for k in range(4)], i % 4, f"src{i % 2}~{i}") for i in range(8)]
    return spark.createDataFrame(rows, "example_id long, ord long, ctx string, endings array<string>, label int, source_id string")


def test_choices_by_bpe(spark, encode):
    ch = _choices(spark)
    ranks, vocab = jobs._vocabulary(spark, RANKS)
    got = X.render_choices(ch, B.id_columns(spark, ranks, vocab)[0]).collect()
    assert len(got) == 32
    texts = {r.example_id: r for r in ch.collect()}
    for r in got:
        ctx, end = encode(texts[r.example_id].ctx), encode(" " + texts[r.example_id].endings[r.ending_idx])
        assert (r.n_ctx, r.n_end, r.ids) == (len(ctx), len(end), ctx + end)
    plan = X.render_choices(ch)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.rindex("ArrowEvalPython")  # contexts are encoded below the explode


def test_examples_are_measured_in_ids_of_the_vocabulary(spark, encode):
    ch = _choices(spark)
    pairs, uni = X.bigram_table(spark.createDataFrame([("some text",)], "text string"))
    losses = X.token_losses(X.render_choices(ch), pairs, uni)
    longest = max(len(encode(c.ctx)) + len(encode(" " + e)) for c in ch.collect() for e in c.endings if c.example_id != 3)
    by_ids = {r.source: (r.n, r.skipped) for r in jobs.evaluate_choices(spark, ch, losses, block=longest, rank_file=RANKS).collect()}
    assert by_ids == {"src0": (4, 0), "src1": (3, 1), "OVERALL": (7, 1)}
    by_bytes = {r.source: (r.n, r.skipped) for r in jobs.evaluate_choices(spark, ch, losses, block=50).collect()}
    assert by_bytes == {"src0": (4, 0), "src1": (3, 1), "OVERALL": (7, 1)}


def test_commands_for_prompts_and_generations(spark, encode, corpora):
    d = scratch_path(spark, "prompts").removeprefix("file:")
    os.makedirs(f"{d}/in")
    for name, text in (("a", "first prompt\nof two lines"), ("b", "second")):
        with open(f"{d}/in/{name}.txt", "w") as f:
            f.write(text)
    jobs._main(["render-prompts", "--prompts", f"{d}/in", "--out", f"{d}/ids", "--rank-file", RANKS, "--manifest", corpora["bpe"]])
    got = {r.prompt_id.rsplit("/", 1)[1]: r.ids for r in spark.read.parquet(f"{d}/ids").collect()}
    assert got == {"a.txt": encode("first prompt\nof two lines"), "b.txt": encode("second")}
    ids = encode("said") + encode(" this")
    spark.createDataFrame([(1, "said", len(encode("said")), [*ids, 50256, 7])], "sample_id long, prompt string, n_prompt int, ids array<int>") \
        .write.parquet(f"{d}/gen")
    jobs._main(["decode-generations", "--generations", f"{d}/gen", "--manifest", corpora["bpe"], "--out", f"{d}/text", "--rank-file", RANKS])
    assert [(r.text, r.answer) for r in spark.read.parquet(f"{d}/text").collect()] == [(" this", "said this")]


def test_byte_columns_are_the_default(spark):
    ordinary, document = B.id_columns(spark, None, BYTES)
    r = spark.createDataFrame([("a<|endoftext|>",)], "t string").select(ordinary("t").alias("o"), document("t").alias("d")).first()
    assert r.o == list(b"a<|endoftext|>") and r.d == [97, 256, 256]
