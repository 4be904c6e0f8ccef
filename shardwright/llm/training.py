"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

HELD_OUT_OF = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document never teaches: crc32 of its id as text is divisible by 5 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, column: str, limit: int) -> DataFrame:
    """(y, text) of at most ``limit`` labelled documents that may teach, those with the least id hash.

    The ids of the sample (``limit`` of them at most) are broadcast, so the texts
    aren't shuffled but for the sample's own, where equal texts count once. Of
    several labels of one id the largest holds; null ids and labels don't count.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")
    return (rows.withColumn("th", F.xxhash64("text")).groupBy("th", "text").agg(F.max("y").alias("y"))
            .select("y", "text"))
