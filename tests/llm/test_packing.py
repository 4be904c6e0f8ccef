import random
import zlib

import numpy as np
import pytest

from shardwright.llm import packing

from .helpers import documents, edge_docs, edge_rows, empty_docs, rows


@pytest.fixture(scope="module")
def reference_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time: the number of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(b, i) for i, b in enumerate(bins) if b >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_histogram_packing_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 16, 50, 100])
    lengths = [r.randint(1, capacity) for _ in range(r.choice([0, 1, 30, 400]))]
    plan = packing.best_fit({n: lengths.count(n) for n in set(lengths)}, capacity)
    used, spans = {}, {}
    for length, a, b, first, per, offset in plan:
        for i in range(b - a):
            bin_, at = first + i // per, offset + i % per * length
            spans.setdefault(bin_, []).append((at, at + length))
            used[bin_] = used.get(bin_, 0) + length
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(x[1] == y[0] for x, y in zip(s, s[1:])) and s[-1][1] <= capacity
    assert sorted(capacity - n for n in used.values()) == one_by_one(lengths, capacity)


def check_pack(docs, out, tokenizer, capacity):
    want = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        start, end, piece = 0, len(ids) % capacity or capacity, 0
        while start < len(ids):
            want.append((doc_id, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start, end, piece = end, end + capacity, piece + 1
    got = [tuple(r[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    spans = {}
    for r in out:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(x[1] == y[0] for x, y in zip(s, s[1:])) and s[-1][1] <= capacity
    assert len(spans) == len(one_by_one([w[3] for w in want], capacity))


def test_pack_documents(spark, reference_tokenizer):
    docs = documents(spark)
    check_pack([(r["doc_id"], r["text"]) for r in docs.collect()], rows(packing.pack(docs)), reference_tokenizer, 2048)


def test_pack_edges(spark, reference_tokenizer):
    check_pack([(r[0], r[1]) for r in edge_rows()], rows(packing.pack(edge_docs(spark), 64)), reference_tokenizer, 64)
    assert rows(packing.pack(empty_docs(spark))) == []


def test_ids_of_odd_texts(reference_tokenizer):
    encode = packing.encoder(packing.default_tokenizer()).encode_ordinary
    for text in ["", " ", "\n\n  x", "a" * 3000, "<|endoftext|> x", "don't  we'll\t\t7 7,7", "東京🙂é  ", "\x00\x1c", "x<|endoftext|>"]:
        assert encode(text) == reference_tokenizer.encode(text, add_special_tokens=False).ids
