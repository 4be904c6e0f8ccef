import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shardwright.llm import bpe_tree
from shardwright.llm.queries import QUERIES

from .helpers import documents, edge_docs, edge_rows, empty_docs, rows

PARTS = ["a", "b", "the", "ing", "'", "'r", "e", "s", "ll", "1", "23", " ", "  ", "\n", "\t", "!", "?!", "é", "東", "🙂", "\xa0", "\u2003",
         "ß", "'ll", "\x1c", "\x85", "e\u0301", "<|endoftext|>"]


@pytest.fixture(scope="module")
def tree():
    return bpe_tree.encoder(bpe_tree.default_ranks())


@pytest.fixture(scope="module")
def library(tree):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tree.ranks, special_tokens={})


def test_equals_the_library_at_every_block_size(tree, library):
    r = random.Random(11)
    for block in (1, 2, 3, 5, 8, 64):
        small = bpe_tree.TreeEncoder(tree.ranks, public_tokenizers.PATTERN, block)
        for _ in range(700):
            t = "".join(r.choice(PARTS) for _ in range(r.randint(0, 60)))
            ids = small.encode(t)
            assert ids.tolist() == library.encode_ordinary(t), (block, t)
            assert bpe_tree.Decoder(tree.ranks).decode(ids) == t.encode()


def test_character_classes_are_those_of_the_library(tree, library):
    """Every code point is a letter, a number, a space or other for both matchers, by the corrected pattern."""
    surplus, missing = zip(*(bpe_tree.unlike(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")))
    odd = set().union(*surplus, *missing)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for c in sorted(odd) + every[::997]:
        t = f"a{c}b1{c}2 {c}!{c} {c}{c}"
        assert tree.encode(t).tolist() == library.encode_ordinary(t), (hex(ord(c)), c in odd)
    assert all(tree.odd.fullmatch(c) for c in odd) and not tree.odd.search("".join(c for c in every[:-1] if c not in odd))


def test_long_pretokens_are_joined_from_halves(tree, library):
    r = random.Random(5)
    texts = ["x" * 5001, "ab" * 30000, "東" * 20001, " " * 100001 + "x", "\n" * 70001, "a" * 300001,
             "".join(r.choice("abcdefgh") for _ in range(20000)), "word " * 20000]
    for t in texts:
        assert tree.encode(t).tolist() == library.encode_ordinary(t)
    for t in (" " * 2_000_000 + "b", "\n" * 2_000_000):  # the library's matcher fails on these
        ids = tree.encode(t)
        assert bpe_tree.Decoder(tree.ranks).decode(ids) == t.encode()


def test_ranks_that_do_not_merge_to_their_own_tokens():
    """"abc" is in the table, but its merges give a + bc: as a whole pre-token it is one id, inside another never."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abcd": 257, b"xy": 258, b"yx": 259, b"xyx": 260}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    for block in (1, 3, 4096):
        tree = bpe_tree.TreeEncoder(ranks, public_tokenizers.PATTERN, block)
        for _ in range(500):
            t = "".join(r.choice(["a", "b", "c", "d", "x", "y", " ", "abcd"]) for _ in range(r.randint(0, 14)))
            assert tree.encode(t).tolist() == enc.encode_ordinary(t), (block, t)


def test_a_join_reencodes_a_window_only(tree):
    a, b = tree.merged("international" * 200), tree.merged("isation" * 200)
    seen, merge = [], tree._merge
    tree.windows.clear()
    tree._merge = tree.windows.compute = lambda w: seen.append(len(w)) or merge(w)
    joined = tree.join(a, b)
    tree._merge = tree.windows.compute = merge
    assert bpe_tree.Decoder(tree.ranks).decode(np.array(joined)) == b"international" * 200 + b"isation" * 200
    assert sum(seen) < 400


def _expected(library, data):
    out = []
    for i, t in data:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        out.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edge_rows_and_empty_table(spark, tmp_path, library):
    edge_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op11_bpe_tree"](spark, str(tmp_path)).collect()), key=repr)
    assert got == _expected(library, [(r[0], r[1]) for r in edge_rows()])
    empty = bpe_tree.decode(bpe_tree.encode(empty_docs(spark)))
    assert empty.columns == ["doc_id", "n_tokens", "decoded"] and rows(empty) == []


def test_query_equals_the_library(spark, library):
    got = sorted((tuple(r) for r in QUERIES["op11_bpe_tree"](spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == _expected(library, [(r["doc_id"], r["text"]) for r in documents(spark).collect()])


def test_another_rank_file(spark, tmp_path):
    path = tmp_path / "own.tiktoken"
    table = [bytes([b]) for b in range(256)] + [b"ab", b"abab"]
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(table)))
    docs = spark.createDataFrame([(1, "ababab"), (2, "")], "doc_id long, text string")
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in bpe_tree.encode(docs, str(path)).collect()}
    assert ids == {1: [257, 256], 2: []}
