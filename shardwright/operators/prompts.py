"""Prompts for generation and what comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import doc_ids, utf8_ids
from ..schemas import BYTES, Vocab
from .vocab import answer_layout, check_vocab, cut_at_eot, decoder, drop_padding


def _nonempty(prompt) -> Column:
    """The prompt; an empty one fails, since a user turn without text asks nothing."""
    given = F.coalesce(prompt, F.lit("")) != ""
    return F.when(F.assert_true(given, F.lit("a chat prompt is empty")).isNull(), prompt)


def chat_prompt_ids(prompt, system, vocab: Vocab = BYTES, ids_of=utf8_ids) -> Column:
    """Ids of an optional system turn + user turn + assistant header (T11); ``ids_of``
    encodes text in which special strings are ordinary."""
    def turn(role, text):
        return F.concat(F.array(F.lit(vocab.im_start)), ids_of(F.lit(role + "\n")), ids_of(text),
                        F.array(F.lit(vocab.im_end), *[F.lit(i) for i in vocab.newline]))
    body = F.concat(turn("user", _nonempty(prompt)), F.array(F.lit(vocab.im_start)), ids_of(F.lit("assistant\n")))
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(turn("system", system), body)).otherwise(body)


def plain_prompt_ids(prompt, vocab: Vocab = BYTES, document_ids=doc_ids) -> Column:
    """Plain prompt: literal end-of-text allowed; empty prompt -> [EOT].
    ``document_ids`` encodes a document, end of text included."""
    ids = document_ids(prompt)
    return F.when(F.coalesce(prompt, F.lit("")) == "", F.array(F.lit(vocab.eot))) \
        .otherwise(F.slice(ids, 1, F.size(ids) - 1))


def keep_tail(ids, T: int) -> Column:
    """Last T ids."""
    return F.slice(ids, F.greatest(F.size(ids) - T + 1, F.lit(1)), T)


def decode_generations(generations: DataFrame, manifest: DataFrame, vocabulary: DataFrame, chat: bool) -> DataFrame:
    """(sample_id, prompt, n_prompt, ids[, system]) -> (sample_id, text, answer): ids after
    the prompt, cut at the manifest's end id, padded ids dropped, decoded with
    the vocabulary that the manifest names (P20)."""
    m = manifest.select("encoding", "eot_token", "vocab_size").first()
    name = vocabulary.select(F.first("vocab_id")).first()[0]
    ids = F.slice("ids", F.col("n_prompt") + 1, F.greatest(F.size("ids") - F.col("n_prompt"), F.lit(0)))
    ids = drop_padding(cut_at_eot(ids, m["eot_token"]), m["vocab_size"])
    ok = check_vocab(F.lit(m["encoding"]), F.lit(name))
    out = generations.select("*", F.when(ok.isNull(), ids).alias("__ids")).withColumn("text", decoder(vocabulary)("__ids"))
    system = F.col("system") if "system" in generations.columns else None
    answer = answer_layout(F.col("prompt"), F.col("text"), system) if chat else F.concat("prompt", "text")
    return out.select("sample_id", "text", answer.alias("answer"))
