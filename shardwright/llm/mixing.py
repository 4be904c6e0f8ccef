"""Mixing sources to target weights by systematic sampling.

Sources in code-point order (null last) weigh 1, 2, 3, repeating; they share
the words of the whole table by weight, no source above ``MAX_COPIES`` times its
own. A document's expected copies are target / source size. Documents of a
source stand in an order by size class and hash; a document is emitted once for
every integer that the prefix sum of expected copies, plus one random offset
per source, passes at it. As the order groups like sizes, a source's words come
near its target.

DataFrame functions only. Ranks come from hash ranges of bounded size
(:func:`common.ranked`), so a source with a third of all rows is spread out.

Defined cases: a null text has size 0; documents of a source without words are
taken 0 times; repeated rows are separate documents; an empty table gives an
empty result; the offset comes from a fixed seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hash32, materialise, ranked, text_of

MAX_COPIES = 3
SEED = "mix-42:"
_KEYS = ["__src", "__class"]


def source_key(source: Column) -> Column:
    """A string without nulls that sorts as the source does, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def size_class(size: str) -> Column:
    """Sizes in classes an eighth of an octave wide: bit length and the three bits below the first; 0 has its own."""
    return F.expr(f"""if({size} = 0, 0L, length(bin({size})) * 8L
                      + shiftright({size} * 8, length(bin({size})) - 1) % 8)""")


def keyed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with __size, __src, __class and __h (its place in the class)."""
    return (docs.withColumn("__size", F.regexp_count(text_of(), F.lit(WORD)).cast("long"))
            .withColumn("__src", source_key(F.col("source")))
            .withColumn("__class", size_class("__size"))
            .withColumn("__h", hash32(F.col("doc_id"), seed)))


def shares(keys: DataFrame, seed: str = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source and class: the source's size, target, rate and offset, and the rank where the class begins.

    The windows without or with one key run over one row per source, or per
    source and class.
    """
    classes = keys.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__words"))
    sources = classes.groupBy("__src").agg(F.sum("__words").alias("__source_size"))
    everything = Window.partitionBy(F.lit(1))
    sources = (sources
               .withColumn("__w", ((F.row_number().over(everything.orderBy("__src")) - 1) % 3 + 1).cast("long"))
               .withColumn("__total", F.sum("__source_size").over(everything))
               .withColumn("__cap", F.col("__source_size") * max_copies)
               .withColumn("__r", F.col("__cap") / F.col("__w")))
    earlier = everything.orderBy("__r", "__src").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("__total") - F.coalesce(F.sum("__cap").over(earlier), F.lit(0)))
             / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(earlier), F.lit(0))))
    sources = sources.withColumn("__level", level)
    rest = F.max(F.when(F.col("__level") < F.col("__r"), F.col("__level"))).over(everything)
    sources = (sources.withColumn("__rest", rest)
               .withColumn("__target", F.when(F.col("__rest").isNull(), F.col("__cap").cast("double"))
                           .otherwise(F.least(F.col("__cap").cast("double"), F.col("__rest") * F.col("__w"))))
               .withColumn("__rate", F.when(F.col("__source_size") == 0, F.lit(0.0))
                           .otherwise(F.least(F.col("__target") / F.col("__source_size"), F.lit(float(max_copies)))))
               .withColumn("__u", hash32(F.col("__src"), seed) / F.lit(float(1 << 32))))
    before = Window.partitionBy("__src").orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("__from", F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("long")).drop("__n", "__words")
    return classes.join(sources.select("__src", "__source_size", "__target", "__rate", "__u"), "__src")


def copies(keys: DataFrame, table: DataFrame) -> DataFrame:
    """``keys`` with the source's columns and ``__copies``, the integers passed at each document."""
    at = ranked(keys, _KEYS, "__h", ["doc_id", "__size"], "__rank").join(table, _KEYS)
    place = F.col("__from") + F.col("__rank")
    passed = lambda k: F.floor(F.col("__rate") * k.cast("double") + F.col("__u"))
    return at.withColumn("__copies", (passed(place + 1) - passed(place)).cast("long"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    keys = materialise(keyed(docs.select("doc_id", "source", "text")).select("doc_id", "__size", "__h", *_KEYS))
    table = materialise(shares(keys))
    return copies(keys, table).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"),
        F.col("__copies").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    keys = keyed(docs)
    narrow = materialise(keys.select("__size", *_KEYS))
    table = materialise(shares(narrow))
    return (copies(keys, table)
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))))
            .select(*docs.columns))
