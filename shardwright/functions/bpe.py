"""Byte-pair encoding over a rank table, one Arrow batch of rows at a time.

Rows are encoded where they are read, so no shuffle and no group is needed; the
rank table is bounded by the vocabulary and broadcast once. ``tiktoken`` merges:
a pre-token in the table is one id, otherwise its bytes are merged by lowest
rank, leftmost first. A literal end-of-text string in a document is one id; in
chat messages every special string stays ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EOT_STR, Vocab, id_dtype
from .tokens import by_runs, doc_ids, runs, utf8_ids

# --- fixed values: the published GPT-2 pre-token split pattern --------------
GPT2_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# ---------------------------------------------------------------------------

#: What \s is in the split patterns (Unicode White_Space).
_SPACE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: tiktoken's matcher keeps a state for each character of a white-space run and fails at about a million.
LONG_RUN = 1 << 16

# Java needs UNICODE_CHARACTER_CLASS for \s to match Unicode spaces as Python
# `regex` does.
JAVA_SPLIT = "(?U)" + GPT2_SPLIT


def _encoding(ranks: dict, eot_id: int):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=GPT2_SPLIT, mergeable_ranks=ranks, special_tokens={EOT_STR: eot_id})


def _around_runs(enc, text: str) -> list[int]:
    """``enc.encode_ordinary`` with the long white-space runs cut out first. Such a run is one pre-token: all of it at the
    end of the text, else all but its last character."""
    ids, at = [], 0
    for run in _SPACE_RUN.finditer(text):
        if run.end() - run.start() >= LONG_RUN:
            end = run.end() - (run.end() < len(text))
            ids += enc.encode_ordinary(text[at:run.start()])
            ids += enc._encode_single_piece(text[run.start():end])
            at = end
    return ids + enc.encode_ordinary(text[at:])


def encode_text(enc, text: str, special: bool = True) -> list[int]:
    """Ids of a text; with ``special``, the encoding's special strings are one id each."""
    # A long run holds all of some window.
    if not any(text[i:i + 64].isspace() for i in range(0, len(text), LONG_RUN // 2)):
        return enc.encode(text, allowed_special="all", disallowed_special=()) if special else enc.encode_ordinary(text)
    names = "|".join(re.escape(x) for x in enc.special_tokens_set) if special else ""
    parts = re.split(f"({names})", text) if names else [text]
    return [i for k, part in enumerate(parts) for i in ([enc.encode_single_token(part)] if k % 2 else _around_runs(enc, part))]


def pieces_of(text: Column) -> Column:
    """The pre-tokens of a text, in order. The text is cut at the end-of-text
    literal first, so no pattern branch can take a part of it."""
    pieces = lambda part: F.regexp_extract_all(part, F.lit(JAVA_SPLIT), F.lit(0))
    parts = F.split(text, EOT_STR.replace("|", "\\|"), -1)
    return F.flatten(F.transform(parts, lambda p, i: F.when(i > 0, F.concat(F.array(F.lit(EOT_STR)), pieces(p)))
                                 .otherwise(pieces(p))))


def pretokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, pos, piece) for every pre-token of every document."""
    return docs.select("doc_id", F.posexplode(pieces_of(F.col(text_col))).alias("pos", "piece"))


def pretoken_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_pieces, text_md5) of every id: the number of its pre-tokens and the md5 of all of them joined, by
    place. Texts are dealt out by id and split where they are; their pre-tokens are never rows. Of an id with
    several texts, pre-tokens count together, those of one place in order."""
    texts = (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text").repartition("doc_id")
             .groupBy("doc_id").agg(F.collect_list("text").alias("texts")))
    split = texts.select("doc_id", F.transform("texts", pieces_of).alias("p"))
    placed = F.flatten(F.transform("p", lambda x: F.transform(x, lambda piece, i: F.struct(i.alias("pos"), piece.alias("piece")))))
    joined = F.when(F.size("p") == 1, F.array_join(F.col("p")[0], "")).otherwise(
        F.array_join(F.transform(F.array_sort(placed), lambda x: x["piece"]), ""))
    return split.select("doc_id", F.size(F.flatten("p")).cast("long").alias("n_pieces"), F.md5(joined).alias("text_md5"))


def bpe_encode(docs: DataFrame, ranks: dict, eot_id: int, append_eot: bool = True) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids); a null text is empty."""
    bc = docs.sparkSession.sparkContext.broadcast(ranks)
    end = [eot_id] if append_eot else []

    def run(batches):
        enc = _encoding(bc.value, eot_id)
        for b in by_runs(batches, 1):
            ids = [encode_text(enc, t.as_py() or "") + end for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, type=pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def encode_documents(docs: DataFrame, ranks: dict, vocab: Vocab) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens, tokens): ids with the final EOT as
    little-endian bytes of the vocabulary's id width; null texts are dropped."""
    bc = docs.sparkSession.sparkContext.broadcast(ranks)
    dtype, eot = "<u2" if id_dtype(vocab.text_size) == "uint16" else "<u4", vocab.eot

    def run(batches):
        enc = _encoding(bc.value, eot)
        for b in by_runs(batches, 1):
            ids = [np.array([*encode_text(enc, t.as_py()), eot], dtype) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "n_tokens", "tokens"])

    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, tokens binary")


def encode_turns(turns: DataFrame, ranks: dict, vocab: Vocab) -> DataFrame:
    """Adds ``role_ids`` (role and newline) and ``text_ids`` to chat turns; no
    special string is recognised in either (T4)."""
    bc = turns.sparkSession.sparkContext.broadcast(ranks)
    eot = vocab.eot

    def run(batches):
        enc = _encoding(bc.value, eot)
        ids = lambda col, tail: pa.array([encode_text(enc, (t.as_py() or "") + tail, False) for t in col], pa.list_(pa.int32()))
        for b in by_runs(batches, 3):
            yield pa.RecordBatch.from_arrays([*b.columns, ids(b.column(2), "\n"), ids(b.column(3), "")],
                                             names=["conv_id", "turn", "role", "text", "role_ids", "text_ids"])

    rows = turns.select("conv_id", F.col("turn").cast("long"), "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, turn long, role string, text string, role_ids array<int>, text_ids array<int>")


def id_columns(spark, ranks: dict | None, vocab: Vocab):
    """Column functions text -> ids of a vocabulary: (ordinary, document). In the first every special string is ordinary
    text; the second takes a literal end of text as its id and appends one. Without ranks: bytes."""
    if ranks is None:
        return utf8_ids, doc_ids
    table, eot, held = spark.sparkContext.broadcast(ranks), vocab.eot, []

    def column(special: bool):
        end = [eot] if special else []

        @F.arrow_udf("array<int>")
        def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            if not held:
                held.append(_encoding(table.value, eot))
            for text in texts:
                for a, n in runs(text):
                    yield pa.array([None if t is None else encode_text(held[0], t, special) + end for t in text.slice(a, n).to_pylist()],
                                   pa.list_(pa.int32()))

        return ids

    return column(False), column(True)


def load_rank_file(spark, path: str) -> DataFrame:
    """A rank file of ``base64(bytes) rank`` lines (the common BPE rank-file
    format) as a table ``(bytes BINARY, rank INT)``."""
    lines = spark.read.text(path)
    parts = F.split(F.trim("value"), " ")
    return lines.filter(F.length(F.trim("value")) > 0).select(
        F.unbase64(parts[0]).alias("bytes"), parts[1].cast("int").alias("rank"))


def ranks_dict(rank_table: DataFrame, max_rows: int = 1 << 20) -> dict:
    """Driver copy of a rank table; refuses tables past ``max_rows`` (the
    vocabulary is the bound that makes broadcasting it safe)."""
    n = rank_table.count()
    if n > max_rows:
        raise ValueError(f"rank table has {n} rows, more than the {max_rows} allowed for broadcast")
    return {bytes(r["bytes"]): int(r["rank"]) for r in rank_table.collect()}


def bpe_vocabulary(ranks: dict, name: str, rank_file: str | None = None) -> Vocab:
    """The vocabulary of a rank table: end-of-text at the first free id, the
    chat delimiters after it; the newline is looked up."""
    eot = max(ranks.values()) + 1
    return Vocab(name, eot, eot + 1, eot + 2, eot + 1, eot + 3, (ranks[b"\n"],), rank_file)
