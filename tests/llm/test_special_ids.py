"""Ids of texts that hold the end-of-text literal, against an unmodified ``tokenizers`` file."""
import random

from shardwright.llm import packing

from .helpers import rows
from .test_long_runs import tokenizer  # noqa: F401
from .test_packing import check_pack

EOT = "<|endoftext|>"


def test_pack_texts_with_the_literal(spark, tokenizer):  # noqa: F811
    assert tokenizer.encode("a" + EOT + "b", add_special_tokens=False).ids == [64, 50256, 65]
    r = random.Random(3)
    parts = [EOT, EOT + EOT, "a", " ", "\n\n", "  b", "don't", "<|endoftext", "|>", "東京", "\x1c", ".", " " * 70_000]
    texts = ["a" + EOT + "b", EOT, " " + EOT + " ", " " * 70_000 + EOT + "\n" * 70_000 + "x", *("".join(r.choices(parts, k=9)) for _ in range(60))]
    docs = list(enumerate(texts))
    check_pack(docs, rows(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), 64)), tokenizer, 64)
