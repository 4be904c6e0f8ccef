"""Documents without an id whose texts agree in a 32-bit hash stay apart."""
import pytest
from pyspark.sql import functions as F

from shardwright.llm import fuzzy_lines, phrase_dedup, suffix_dedup

PASSAGE = " ".join(f"alpha{i}" for i in range(40))
FILLER = " ".join(f"omega{i}" for i in range(40))


@pytest.fixture(scope="module")
def docs(spark):
    """A document with an id that holds PASSAGE, and two without: one holds it too, the other has the same 32-bit hash."""
    head = F.when(F.col("id") % 2 == 0, PASSAGE).otherwise(FILLER)
    many = spark.range(400_000).select("id", F.hash(F.lit(True), F.concat(head, F.lit("\n"), F.md5(F.col("id").cast("string")))).alias("h"))
    even = many.where("id % 2 = 0").select(F.col("id").alias("a"), "h")
    pair = even.join(many.where("id % 2 = 1").select(F.col("id").alias("b"), "h"), "h").orderBy("a", "b").first()
    texts = spark.range(400_000).where(F.col("id").isin(pair["a"], pair["b"])).select(
        F.concat(head, F.lit("\n"), F.md5(F.col("id").cast("string"))).alias("text"), "id").orderBy(F.col("id") % 2).collect()
    same, clean = (r["text"] for r in texts)
    return spark.createDataFrame([(1, PASSAGE), (None, same), (None, clean)], "doc_id long, text string"), clean


def test_suffix_groups(docs):
    kept = [r["kept"].decode() for r in suffix_dedup.remove_repeats(docs[0]).collect()]
    assert len(kept) == 3 and docs[1] in kept and PASSAGE in kept


def test_phrases(docs):
    assert " ".join(docs[1].split()) in [r["kept"] for r in phrase_dedup.remove_repeated(docs[0]).collect()]


def test_lines(docs):
    rows = {r["kept"]: r["n_removed"] for r in fuzzy_lines.deduped(docs[0]).collect()}
    assert rows[docs[1]] == 0 and rows[PASSAGE] == 0 and sum(rows.values()) == 1
