"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeated rows, clashing names."""
import random

from pyspark.sql import functions as F

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key int, size double, rank int, h int, fp int, t int"


def edge_rows():
    r = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "Straße", "naïve", "東京", "🙂"]
    prose = lambda n: " ".join(r.choice(words) + r.choice(["", "", ",", "s"]) for _ in range(n))
    a, b = prose(120), prose(300)
    texts = [(1, a), (2, a), (3, b), (4, b + " tail"), (5, "head\n" + b), (6, ""), (7, None), (8, " \t\n"), (9, "one"),
             (9, "one"), (10, prose(5)), (None, a), (None, a), (None, None), (11, prose(6000)), (12, "x" * 5000), (13, "ab " * 400),
             (14, "\x1c\x1d \xa0 nbsp em"), (15, "Line one here.\nLine two here.\nLine one here."), (16, "aaaa" * 300),
             (2, b), (17, prose(40) + "\n" + a + "\n" + prose(40)), (18, "\x00nul\x00 byte"), (19, "a b c d"), (20, "A B C D")]
    return [(i, t, None, [None, "s1", "s2", "é"][k % 4], None, "x", 1, 0.5, 2, 3, 4, 5) for k, (i, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def key(x):
    return sorted(map(repr, x))


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").orderBy(F.col("doc_id"))
