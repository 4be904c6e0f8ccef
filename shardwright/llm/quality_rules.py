"""Quality rules: a ledger of rule bits and measurements, policies and ablations over it.

Every rule is evaluated once per document. The ledger keeps its measurements
and one long of failure bits; a policy is a named, versioned mask over those
bits, so changing a policy or measuring what a rule costs never reads a text
again. DataFrame functions only; no shuffle to build a ledger.

Defined cases: a null or empty text has no words and fails ``few_words``; rows
are judged one by one, so repeated rows and null ids stay as they are; an empty
table gives an empty ledger; other input columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, text_of, words_of

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

#: name -> condition over the measurements that fails a document; the place in this table is the rule's bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "upper_case": "2 * n_upper > word_chars",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of which rules reject a document."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
FULL = Policy("full", tuple(RULES))


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Windows are compared by XXH64 over the three words. Sorting (hash, place)
    puts equal windows side by side; the sorted places of repeated windows then
    cover min(3, distance to the next) words each.
    """
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def places(g):
        pairs = F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def twice(s):
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))

        return F.sort_array(F.transform(let(F.sort_array(pairs), twice), lambda x: x["i"]))

    def covered(p):
        gaps = F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def count(g):
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(let(places(g), covered))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(windows(words), count))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failure_bits`` of every document."""
    base = docs.select("doc_id", text_of().alias("t"))
    base = base.withColumn("w", words_of(F.col("t")))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    base = base.withColumn("l", lines)
    measured = base.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        _without(F.col("t"), SPACES).cast("long").alias("word_chars"),
        (F.char_length("t") - _without(F.col("t"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        let(F.col("w"), _repeat_words).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.char_length("t") - _without(F.col("t"), UPPER)).cast("long").alias("n_upper"),
    )
    bits = F.lit(0).cast("long")
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failure_bits", bits)


#: The columns that stand before a verdict.
LEADING = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rejects(policy: Policy) -> Column:
    return F.col("failure_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def judge(book: DataFrame, policy: Policy = FULL) -> DataFrame:
    """The ledger's id and base measurements, ``base_failed`` and the policy's verdict ``kept``, then its further columns;
    nothing is evaluated again."""
    rest = [c for c in book.columns if c not in LEADING]
    return book.select(*LEADING, rejects(BASE).alias("base_failed"), (~(rejects(BASE) | rejects(policy))).alias("kept"), *rest,
                       F.lit(policy.version).alias("policy"))


def ablation(book: DataFrame, policy: Policy = FULL) -> DataFrame:
    """Per rule of the policy: documents it fails, those that it alone fails, and those kept without it.

    Documents are first counted by their masked failure bits (2^rules groups at
    most, combined before the shuffle); the rest are bit operations on that table.
    """
    mask = F.lit(policy.mask).cast("long")
    groups = (book.groupBy(F.col("failure_bits").bitwiseAND(mask).alias("bits"))
              .agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules])
    each = groups.select("bits", "n", F.inline(rules))
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    return (each.groupBy("rule")
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
                 F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without")))
