"""Texts that hold very long white-space runs, against ``tokenizers``."""
import pytest

from shardwright.functions import bpe
from shardwright.llm import packing

from .helpers import rows
from .test_packing import check_pack


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


N = 2_000_000
LONG = ["a" + " " * N + "b", "a" + "\n" * N + "b", " \t　" * (N // 3), "x\x1c" + "\n" * N]


def test_pack_two_million_spaces_and_newlines(spark, tokenizer):
    docs = list(enumerate(LONG))
    check_pack(docs, rows(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"))), tokenizer, 2048)


def test_bpe_of_two_million_spaces_and_newlines(spark, tokenizer):
    import public_tokenizers
    ranks = bpe.ranks_dict(bpe.load_rank_file(spark, "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")))
    vocab = bpe.bpe_vocabulary(ranks, "bpe")
    want = {i: tokenizer.encode(t).ids for i, t in enumerate(LONG)}
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    assert {r.doc_id: r.ids for r in bpe.bpe_encode(docs, ranks, vocab.eot, append_eot=False).collect()} == want
    assert {r.doc_id: r.n_tokens for r in bpe.encode_documents(docs, ranks, vocab).collect()} == {i: len(w) + 1 for i, w in want.items()}
    turns = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(LONG)], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.text_ids for r in bpe.encode_turns(turns, ranks, vocab).collect()} == want


def test_runs_are_cut_as_the_pattern_cuts_them(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "LONG_RUN", 128)
    enc = packing.encoder(packing.default_tokenizer())
    run = " " * 300
    for text in (run, run + "a", "a" + run, "a," + run + "'s  b" + "\n" * 200 + "7", run + "\x1c" + run, "\r\n" * 90 + " x", "a\xa0" * 200):
        assert bpe.encode_text(enc, text, False) == tokenizer.encode(text, add_special_tokens=False).ids
