"""Structured Streaming jobs: incremental tokenisation with carried shard
state (K1-K3) and a running evaluation report (K4).

Exactly-once by construction: every output of micro-batch N (token rows and
the carried state) is written to partition ``batch_id=N``
with dynamic partition overwrite, so a replayed batch rewrites the same
partition instead of appending twice. Restart = rerun with the same
checkpoint location.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import doc_ids_packed
from ..operators.corpus import doc_token_count
from ..operators.order import ordinal, prefix_sum
from ..schemas import DOCUMENTS, REFERENCE_SHARD_TOKENS

STATE = "tokens long, docs long, shard_id long, open_tokens long, batch_id long"


def _prior_state(spark: SparkSession, state_dir: str, batch_id: int) -> dict:
    """Tokens and documents so far, the open shard and its tokens, after the last
    committed batch before ``batch_id``. Only a missing folder means that there is
    no state yet; an unreadable one fails."""
    none = {"tokens": 0, "docs": 0, "shard_id": 0, "open_tokens": 0}
    try:
        st = spark.read.schema(STATE).parquet(state_dir)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none
    row = st.filter(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).limit(1).collect()
    return {k: int(row[0][k]) for k in none} if row else none


def tokenize_stream(spark: SparkSession, source_dir: str, out_dir: str, state_dir: str,
                    checkpoint: str, files_per_trigger: int = 1, shard_tokens: int = REFERENCE_SHARD_TOKENS):
    """Tokenise documents arriving as parquet files in ``source_dir``: rows
    (doc_id, n_tokens, tok_start, doc_ord, shard_id, tokens BINARY, batch_id). Each
    micro-batch continues the offsets and the open shard of the one before it
    (K3); a shard closes at the first micro-batch end where it holds
    ``shard_tokens``."""
    stream = (spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))

    def write_batch(df: DataFrame, batch_id: int):
        was = _prior_state(spark, state_dir, batch_id)
        rolled = was["open_tokens"] >= shard_tokens
        shard, held = was["shard_id"] + rolled, 0 if rolled else was["open_tokens"]
        docs = df.filter(F.col("text").isNotNull())
        # Within a micro-batch, documents are in doc_id order.
        meta = ordinal(docs.select("doc_id", doc_token_count().alias("n_tokens")), "doc_id", out="ord")
        meta = prefix_sum(meta, "ord", "n_tokens", out="tok_start") \
            .withColumn("tok_start", F.col("tok_start") + F.lit(was["tokens"])) \
            .withColumn("doc_ord", F.col("ord") + F.lit(was["docs"])).drop("ord")
        rows = docs.select("doc_id", doc_ids_packed("text").alias("tokens")).join(meta, "doc_id") \
            .withColumn("shard_id", F.lit(shard)).withColumn("batch_id", F.lit(batch_id))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_dir))
        agg = meta.agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("d")).first()
        t, d = int(agg["t"] or 0), int(agg["d"] or 0)
        state = spark.createDataFrame([(was["tokens"] + t, was["docs"] + d, shard, held + t, batch_id)], STATE)
        (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(state_dir))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_dir)


def stage_in_order(docs: DataFrame, stage_dir: str, n_files: int) -> None:
    """Write documents as ``n_files`` parquet files, one write per key range in
    ascending doc_id order, so file arrival order is corpus order."""
    ranks = ordinal(docs.select("doc_id"), "doc_id", out="ord")
    size = max(1, -(-ranks.count() // n_files))
    firsts = [r["doc_id"] for r in ranks.filter(F.col("ord") % size == 0).orderBy("ord").collect()]  # n_files rows
    for a, b in zip(firsts, [*firsts[1:], None]):
        part = docs.filter(F.col("doc_id") >= a)
        if b is not None:
            part = part.filter(F.col("doc_id") < b)
        part.coalesce(1).write.mode("append").parquet(stage_dir)


def running_report(spark: SparkSession, picks_dir: str, schema, checkpoint: str, out_dir: str):
    """Per-source running totals of scored examples, refreshed after every
    micro-batch (K4); OVERALL is derived from the same sums. Each refresh is a
    folder of its own, ``out_dir/batch=N``, so a reader never meets half of one;
    the last is the report."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(picks_dir)
    agg = stream.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("acc").alias("acc_sum"), F.sum("acc_norm").alias("acc_norm_sum"),
        F.sum("gold").alias("loss_sum"), F.sum("all_loss").alias("all_sum"), F.sum("margin").alias("margin_sum"))

    def write_batch(df: DataFrame, batch_id: int):
        df.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    q = (agg.writeStream.outputMode("complete").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    sums = spark.read.parquet(out_dir)
    sums = sums.filter(F.col("batch") == sums.agg(F.max("batch")).scalar()).drop("batch")
    overall = sums.agg(*[F.sum(c).alias(c) for c in
                         ("n", "acc_sum", "acc_norm_sum", "loss_sum", "all_sum", "margin_sum")]) \
        .select(F.lit("OVERALL").alias("source"), "*")
    allrows = sums.unionByName(overall)
    return allrows.select("source", F.col("n").cast("long").alias("n"),
                          *[(F.col(f"{c}_sum") / F.col("n")).alias(c) for c in ("acc", "acc_norm", "loss", "all", "margin")])
