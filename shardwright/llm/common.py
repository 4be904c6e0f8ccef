"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: ASCII white space, \x20 and \x09-\x0D: what separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> None:
    """The shared checkpoint folder is set and Python workers can import this package."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text as a string, null as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def text_key(doc_id: Column, text: Column) -> Column:
    """64 bits that tell apart documents of one id (or of none) by text."""
    return F.xxhash64(doc_id.isNull(), F.char_length(text), text)


def hash32(col: Column, salt: str = "") -> Column:
    """32 bits of the md5 of a value's text (null has its own), as a long in [0, 2^32)."""
    s = F.concat(F.lit(salt), F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("~")))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder (columns can be pruned when it is read)."""
    spark = df.sparkSession
    ready(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: list[str], order_hash: str, ties: list[str], rank: str,
           rows_per_bucket: int = 65536) -> DataFrame:
    """Adds ``rank``: the 0-based place of each row in its group, by ``order_hash`` and ``ties``.

    ``order_hash`` is a long in [0, 2^32) and ``group`` columns hold no nulls. A
    group is cut into hash ranges of about ``rows_per_bucket`` rows each, so no
    task sorts more than that however large a group is; the ranges' counts give
    the offsets.
    """
    n, sub, off, rn = "__n_sub", "__sub", "__sub_from", "__rn"
    counts = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_bucket)).cast("long").alias(n))
    cut = df.join(counts, group).withColumn(sub, F.shiftright(F.col(order_hash) * F.col(n), 32)).drop(n)
    subs = cut.groupBy(*group, sub).agg(F.count(F.lit(1)).alias(off))
    before = Window.partitionBy(*group).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.withColumn(off, F.coalesce(F.sum(off).over(before), F.lit(0)).cast("long"))
    inside = Window.partitionBy(*group, sub).orderBy(order_hash, *ties)
    return (cut.withColumn(rn, F.row_number().over(inside).cast("long"))
            .join(subs, [*group, sub])
            .withColumn(rank, F.col(off) + F.col(rn) - 1)
            .drop(sub, off, rn))
