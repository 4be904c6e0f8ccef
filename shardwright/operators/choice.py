"""Multiple-choice evaluation: render, length filter, collate, score, roll up.

A choice example is ``(ctx, endings[4], label, source_id)``. Each ending is
scored by the loss over its own tokens (targets shifted by one); ``acc`` picks
the lowest summed loss, ``acc_norm`` the lowest per-token loss, lowest index
on ties. The scorer is an input table ``token_losses`` or a caller's model
(``model_losses``); the stand-in scorer here is an add-one byte-bigram model
counted from the documents table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import utf8_ids
from ..schemas import BYTE_VOCAB_SIZE, CHOICE, TOKEN_LOSSES
from .order import ordinal


def read_choices(spark, path: str) -> DataFrame:
    """JSON-lines choice examples with a fixed schema (S5); ``ord`` and
    ``example_id`` are the line order (files by path, lines by place), label cast
    to int (P7)."""
    df = spark.read.schema(CHOICE).json(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("line"))  # the id rises with the line inside a block
    df = ordinal(df.withColumn("__place", place), "__place", out="ord").drop("__place")
    return df.withColumn("example_id", F.col("ord")).withColumn("label", F.col("label").cast("int"))


def choices_from_benchmark(bench: DataFrame) -> DataFrame:
    """Fixture stand-in for the choice file: ctx = first half of the words,
    true ending = second half at ``label = item_id % 4``, distractors = second
    halves of items (ord + 1..3) mod n, ``source_id = even|odd ~ item_id``."""
    words = F.split(F.coalesce("text", F.lit("")), " ")
    k = F.floor(F.size("w") / 2).cast("int")
    items = bench.select("item_id", words.alias("w")).select(
        "item_id", F.array_join(F.slice("w", 1, k), " ").alias("ctx"),
        F.array_join(F.slice("w", k + 1, F.size("w") - k), " ").alias("ending"))
    items = ordinal(items, "item_id", out="ord")
    n = items.agg(F.count(F.lit(1))).scalar()
    base = items.select("item_id", "ord", "ctx", "ending", (F.col("item_id") % 4).cast("int").alias("label"))
    pos = base.select("item_id", "ord", "label", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ending_idx"))
    j = F.when(F.col("ending_idx") < F.col("label"), F.col("ending_idx") + 1).otherwise(F.col("ending_idx"))
    pos = pos.withColumn("src_ord", F.when(F.col("ending_idx") == F.col("label"), F.col("ord"))
                         .otherwise((F.col("ord") + j) % n))
    ends = pos.join(items.select(F.col("ord").alias("src_ord"), F.col("ending").alias("end_text")), "src_ord")
    endings = ends.groupBy("item_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ending_idx", "end_text"))),
                    lambda x: x["end_text"]).alias("endings"))
    src = F.concat(F.when(F.col("item_id") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")),
                   F.lit("~"), F.col("item_id").cast("string"))
    return base.join(endings, "item_id").select(
        F.col("item_id").alias("example_id"), "ord", "ctx", "endings", "label", src.alias("source_id"))


def render_choices(choices: DataFrame, ids_of=utf8_ids) -> DataFrame:
    """One row per (example, ending): ids = ctx ids + ids of " " + ending, mask
    0 on the context and 1 on the ending (T13); source = text before "~" (P6).
    ``ids_of`` encodes text; a context is encoded once for all its endings."""
    rows = choices.select("example_id", "ord", "label", ids_of(F.col("ctx")).alias("ctx_ids"),
                          F.substring_index("source_id", "~", 1).alias("source"), "endings")
    rows = rows.select("example_id", "ord", "label", "source", "ctx_ids", F.posexplode("endings").alias("ending_idx", "ending"))
    rows = rows.withColumn("end_ids", ids_of(F.concat(F.lit(" "), F.col("ending"))))
    return rows.select(
        "example_id", "ord", "label", "source", "ending_idx", F.size("ctx_ids").alias("n_ctx"), F.size("end_ids").alias("n_end"),
        F.concat("ctx_ids", "end_ids").alias("ids"))


def length_filter(rendered: DataFrame, block: int, limit: int = 0) -> DataFrame:
    """Per example: longest row and whether it fits ``block`` (P4); ``limit``
    keeps the first N examples in order, 0 = all (P5)."""
    r = rendered if not limit else rendered.filter(F.col("ord") < limit)
    return r.groupBy("example_id", "ord").agg(F.max(F.size("ids")).alias("max_len")) \
        .withColumn("kept", F.col("max_len") <= block)


def collate(rendered: DataFrame, kept: DataFrame, batch_examples: int) -> DataFrame:
    """Right-pad ids and mask with 0 to the widest row of each batch of
    ``batch_examples`` kept examples (T14)."""
    k = ordinal(kept.filter("kept").select("example_id"), "example_id", out="kord")
    r = rendered.join(k, "example_id").withColumn("batch", F.floor(F.col("kord") / batch_examples))
    w = F.max(F.size("ids")).over(Window.partitionBy("batch"))
    r = r.withColumn("width", w)
    mask = F.concat(F.array_repeat(F.lit(0), F.col("n_ctx")), F.array_repeat(F.lit(1), F.col("n_end")))
    pad = F.array_repeat(F.lit(0), F.col("width") - F.size("ids"))
    return r.select("example_id", "ending_idx", "batch", "width",
                    F.concat("ids", pad).alias("ids"), F.concat(mask, pad).alias("mask"))


def bigram_table(docs: DataFrame, vocab_size: int = BYTE_VOCAB_SIZE):
    """Stand-in scorer: add-one byte-bigram NLL counted over every document's
    ids. Each run of rows is pre-aggregated with ``bincount`` (at most
    vocab_size^2 rows leave a task), then partial sums merge by pair code; the
    result is bounded by vocab_size^2 rows, hence broadcastable."""
    import numpy as np
    import pyarrow as pa

    from ..functions.tokens import _doc_list, by_runs

    V2 = vocab_size * vocab_size

    def count(batches):
        acc = np.zeros(V2, dtype=np.int64)
        for b in by_runs(batches, 0):
            lists = _doc_list(b.column(0))
            offs = lists.offsets.to_numpy()
            vals = lists.values.to_numpy().astype(np.int64)
            if len(vals) < 2:
                continue
            codes = vals[:-1] * vocab_size + vals[1:]
            # Drop pairs that straddle two documents: position i pairs with
            # i + 1, so the last id of every document starts no pair.
            keep = np.ones(len(codes), dtype=bool)
            keep[offs[1:-1] - 1] = False
            acc += np.bincount(codes[keep], minlength=V2)
        nz = np.nonzero(acc)[0]
        if len(nz):
            yield pa.RecordBatch.from_arrays([pa.array(nz.astype(np.int64)), pa.array(acc[nz])], names=["code", "c"])

    codes = docs.filter(F.col("text").isNotNull()).select("text").mapInArrow(count, "code long, c long")
    pairs = codes.groupBy("code").agg(F.sum("c").alias("c"))
    pairs = pairs.select((F.col("code") / vocab_size).cast("int").alias("prev"),
                         (F.col("code") % vocab_size).cast("int").alias("cur"), "c")
    uni = pairs.groupBy("prev").agg(F.sum("c").alias("cp"))
    return pairs, uni


def token_losses(rendered: DataFrame, pairs: DataFrame, uni: DataFrame,
                 vocab_size: int = BYTE_VOCAB_SIZE) -> DataFrame:
    """``(example_id, ending_idx, pos, loss, mask)`` for the ending's target
    positions (the only ones with mask 1)."""
    pos = rendered.select("example_id", "ending_idx", "ids",
                          F.explode(F.sequence(F.greatest(F.col("n_ctx"), F.lit(1)),
                                               F.size("ids") - 1)).alias("pos"))
    pos = pos.select("example_id", "ending_idx", "pos", F.col("ids")[F.col("pos") - 1].alias("prev"),
                     F.col("ids")[F.col("pos")].alias("cur"))
    j = pos.join(F.broadcast(pairs), ["prev", "cur"], "left").join(F.broadcast(uni), "prev", "left")
    loss = -F.log((F.coalesce("c", F.lit(0)) + 1) / (F.coalesce("cp", F.lit(0)) + vocab_size))
    return j.select("example_id", "ending_idx", F.col("pos").cast("int"), loss.alias("loss"),
                    F.lit(1).alias("mask"))


#: Narrowest batch of a model; wider ones are powers of two.
MIN_WIDTH = 16


def model_losses(rendered: DataFrame, make_predict, batch_rows: int = 64) -> DataFrame:
    """``token_losses`` by a caller's model (U2, A7). ``make_predict()`` is called once per
    Python worker and returns a function from ids (rows, width), padded on the right with
    0, to the loss of each id given those before it, of the same shape.

    Rows of like length go through the model together: widths are powers of two, so
    padding stays below half whatever the longest example is, and there are as many
    kinds of batches as the longest row has binary digits.
    """
    size = F.size("ids")
    rows = rendered.filter(size > 0).select("example_id", "ending_idx", "n_ctx", "ids", F.greatest(
        F.lit(MIN_WIDTH), F.call_function("shiftleft", F.lit(1), F.length(F.bin(size - 1)))).alias("width"))
    widths = sorted(r["width"] for r in rows.select("width").distinct().collect())  # one per power of two
    parts = []
    for width in widths:
        predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_rows,
                                    input_tensor_shapes=[[width]])
        padded = F.concat("ids", F.array_repeat(F.lit(0), F.lit(width) - size)).cast("array<int>")
        parts.append(rows.filter(F.col("width") == width).withColumn("losses", predict(padded)))
    if not parts:
        return rendered.sparkSession.createDataFrame([], TOKEN_LOSSES)
    first = F.greatest(F.col("n_ctx"), F.lit(1))
    scored = reduce(DataFrame.unionByName, parts).select(
        "example_id", "ending_idx", first.alias("first"), F.posexplode(F.slice("losses", first + 1, F.greatest(size - first, F.lit(0)))))
    return scored.select("example_id", "ending_idx", (F.col("first") + F.col("pos")).cast("int").alias("pos"),
                         F.col("col").alias("loss"), F.lit(1).alias("mask"))


def bigram_model(pairs: DataFrame, uni: DataFrame, vocab_size: int = BYTE_VOCAB_SIZE):
    """The byte-bigram counts of ``bigram_table`` as a model for ``model_losses`` (at
    most vocab_size^2 rows go through the driver)."""
    import numpy as np

    counts = np.zeros((vocab_size, vocab_size))
    for r in pairs.collect():
        counts[r["prev"], r["cur"]] = r["c"]
    before = np.zeros((vocab_size, 1))
    for r in uni.collect():
        before[r["prev"], 0] = r["cp"]
    loss = -np.log((counts + 1) / (before + vocab_size))

    def make_predict():
        def predict(ids):
            ids = ids.astype(np.int64)
            out = np.zeros(ids.shape)
            out[:, 1:] = loss[ids[:, :-1], ids[:, 1:]]
            return out
        return predict

    return make_predict


def candidate_scores(losses: DataFrame) -> DataFrame:
    """Summed and per-token loss per candidate."""
    return losses.groupBy("example_id", "ending_idx").agg(
        F.sum(F.col("loss") * F.col("mask")).alias("sum_loss"),
        F.sum("mask").cast("long").alias("n_tok")
    ).withColumn("per_token", F.col("sum_loss") / F.col("n_tok"))


def example_picks(scores: DataFrame, examples: DataFrame) -> DataFrame:
    """acc / acc_norm picks (lowest index on ties), gold loss, mean of all
    endings, margin = mean(wrong) - gold (A8, A9, J7)."""
    s = scores.join(examples.select("example_id", "label", "source"), "example_id")
    g = s.groupBy("example_id", "label", "source").agg(
        F.min_by("ending_idx", F.struct("sum_loss", "ending_idx")).alias("pred"),
        F.min_by("ending_idx", F.struct("per_token", "ending_idx")).alias("pred_norm"),
        F.sum(F.when(F.col("ending_idx") == F.col("label"), F.col("per_token"))).alias("gold"),
        F.sum("per_token").alias("pt_sum"), F.count(F.lit(1)).alias("n_end"))
    return g.select("example_id", "source", "label", "pred", "pred_norm",
                    (F.col("pred") == F.col("label")).cast("int").alias("acc"),
                    (F.col("pred_norm") == F.col("label")).cast("int").alias("acc_norm"),
                    "gold", (F.col("pt_sum") / F.col("n_end")).alias("all_loss"),
                    ((F.col("pt_sum") - F.col("gold")) / (F.col("n_end") - 1) - F.col("gold")).alias("margin"))


def report(picks: DataFrame) -> DataFrame:
    """Per-source rows in source order, then OVERALL over examples (A10, O2)."""
    r = picks.rollup("source").agg(
        F.count(F.lit(1)).alias("n"), F.avg("acc").alias("acc"), F.avg("acc_norm").alias("acc_norm"),
        F.avg("gold").alias("loss"), F.avg("all_loss").alias("all"), F.avg("margin").alias("margin"),
        F.grouping("source").alias("g")).orderBy("g", "source")
    return r.select(F.when(F.col("g") == 1, F.lit("OVERALL")).otherwise(F.col("source")).alias("source"),
                    "n", "acc", "acc_norm", "loss", "all", "margin")
