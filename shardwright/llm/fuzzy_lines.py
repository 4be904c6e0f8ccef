"""Fuzzy line dedup: of every connected group of near-equal lines the first occurrence stays.

Lines are normalised (lower case, runs of other than letters and digits become
one space) and get a SimHash of their words (XXH64, seed 42). Lines are linked
when their hashes differ in at most ``MAX_BITS`` bits and their normalised texts
have an edit similarity of at least ``SIMILARITY`` (1 - Levenshtein distance /
longer length). Groups are the connected components of these links; lines equal
after normalisation are one node. Blank lines are left alone.

Hashes meet by pigeonhole: of ``blocks`` blocks at least ``blocks - MAX_BITS``
agree, so every such choice of blocks is a key. No key's pairs are all made:
first every hash is held against one hub per key (its most frequent line) and
every line against one line of its own hash; what that joins is one component,
and only pairs across components are left to compare. The number of blocks
follows the number of hashes and changes the work only, not the links.

DataFrame functions only. Texts of the lines to verify are fetched once, and
minima and counts are combined before their shuffles.

Defined cases: a null text has no lines; the first occurrence is the one with
the smallest doc_id (null last), then document hash, then place; rows equal in
id and text are one document for that order, so repeated rows all keep what the
first keeps; an empty table gives an empty result; a document may be left with
an empty text.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, let, materialise, text_key, text_of, written
from .graph import components

MAX_BITS = 3
SIMILARITY = 0.8
BUCKET = 0
ROW = ["id", "th"]
_LANES = 0x0000000100000001
#: Words that are added up at a time, as many as three adder outputs can count.
_AT_ONCE = 7
#: Characters of the pieces whose distances are added up before two whole middles are compared.
_PIECE = 128


def plain(line: Column) -> Column:
    """Letters and digits in lower case, one space between. (Runs that are one space already are not matched: they are
    most of all runs, and each match costs more than the characters it replaces.)"""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}](?:[^\p{L}\p{N}]+|(?<! ))", " "))


def normalised(lines: DataFrame) -> DataFrame:
    """``lines`` that aren't blank with norm for line: its plain form or, if it has no letter or digit, the trimmed line.

    (The plain form is a column of its own, so that it is made once.)
    """
    rest = [c for c in lines.columns if c != "line"]
    lines = lines.where(F.trim("line", F.lit(SPACES)) != "").withColumn("__plain", plain(F.col("line")))
    return lines.select(*rest, F.when(F.col("__plain") != "", F.col("__plain")).otherwise(
        F.trim(F.lower("line"), F.lit(SPACES))).alias("norm"))


def identified(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``docs`` with id (a null one last) and th, which tell documents apart."""
    return (docs.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
            .withColumn("th", text_key(F.col("doc_id"), text_of("text" if text is None else text))))


def lines_of() -> Column:
    return F.split(text_of(), "\n", -1)


def rest_of() -> Column:
    """The text without the lines at the places in ``gone``, where there are any."""
    def rest(lines):
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))  # by hash, in order
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    return F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(lines_of(), rest))


def _added(rows: DataFrame, a: str, b: str, c: str, ones: str, twos: str) -> DataFrame:
    """The numbers of bits that are set at each place of three longs, as two longs (a full adder)."""
    rows = rows.withColumn("__odd", F.col(a).bitwiseXOR(F.col(b)))
    return rows.withColumn(ones, F.col("__odd").bitwiseXOR(F.col(c))).withColumn(
        twos, F.col(a).bitwiseAND(F.col(b)).bitwiseOR(F.col("__odd").bitwiseAND(F.col(c)))).drop("__odd")


def hashed_lines(docs: DataFrame) -> DataFrame:
    """id, th, pos, nh (XXH64 of the normalised line), len and fp (its SimHash) of every line that isn't blank.

    A line's different words (by their hashes) are exploded in sevens. Full adders count the bits
    of seven word hashes in three longs (ones, twos and fours), and these are
    summed bit by bit: sum i holds bits i and i + 32 in two 32-bit lanes.
    """
    lines = normalised(docs.select(*ROW, F.posexplode(lines_of()).alias("pos", "line")))
    lines = lines.select(*ROW, "pos", F.xxhash64("norm").alias("nh"), F.char_length("norm").alias("len"),
                         F.array_distinct(F.transform(F.split("norm", " "), lambda w: F.xxhash64(w))).alias("words")).withColumn("n", F.size("words"))
    sevens = lines.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_AT_ONCE))).alias("i"))
    word_hash = [F.when(F.col("i") + k < F.col("n"), F.get("words", F.col("i") + k)).otherwise(F.lit(0).cast("long"))
                 for k in range(_AT_ONCE)]
    at_once = F.least(F.col("n") - F.col("i"), F.lit(_AT_ONCE)).alias("n")
    sevens = sevens.select(*ROW, "pos", "nh", "len", at_once, *[h.alias(f"h{k}") for k, h in enumerate(word_hash)])
    for step in (("h0", "h1", "h2", "a", "ta"), ("h3", "h4", "h5", "b", "tb"), ("a", "b", "h6", "ones", "tc"),
                 ("ta", "tb", "tc", "twos", "fours")):
        sevens = _added(sevens, *step)
    lane = lambda c, i: F.shiftrightunsigned(c, i).bitwiseAND(F.lit(_LANES))
    lanes = [F.sum(lane("ones", i) + F.shiftleft(lane("twos", i) + F.shiftleft(lane("fours", i), 1), 1)).alias(f"s{i}")
             for i in range(32)]
    # (n is counted like the bits: rows equal in id and text are one group.)
    counted = sevens.groupBy(*ROW, "pos", "nh", "len").agg(F.sum("n").alias("n"), *lanes)
    # Bit 30 of a lane of 2 * count + 2^30 - 1 - n is set where the count is over half of n.
    counted = counted.withColumn("over", (F.lit((1 << 30) - 1) - F.col("n")) * F.lit(_LANES))
    fp = F.lit(0).cast("long")
    for i in range(32):
        set_lanes = F.shiftrightunsigned(F.shiftleft(f"s{i}", 1) + F.col("over"), 30).bitwiseAND(F.lit(_LANES))
        fp = fp.bitwiseOR(F.shiftleft(set_lanes, i))
    return counted.select(*ROW, "pos", "nh", "len", fp.alias("fp"))


def key_masks(n: int, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> list[int]:
    """Masks of every choice of blocks - max_bits of the fewest blocks with which random hashes share a key with
    ``bucket`` whole others at most on average. (At one other on average most hashes are in a key of three or more, and
    all of these are compared again.)"""
    blocks = max_bits + 1
    while blocks < 16 and n >> (64 * (blocks - max_bits) // blocks) > bucket:
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """``rows`` once per mask, with the key of its fp."""
    signed = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in masks])
    return (rows.withColumn("m", F.explode(signed))
            .withColumn("key", F.xxhash64("m", F.col("fp").bitwiseAND(F.col("m")))).drop("m"))


def apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _shared(a: Column, b: Column, end) -> Column:
    """Characters that two strings share at one end (``end``: F.left or F.right), found by doubling steps."""
    def search(shortest):
        steps = F.transform(F.sequence(F.length(F.bin(shortest)) - 1, F.lit(0)), lambda i: F.pow(F.lit(2), i).cast("int"))
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (step <= shortest - n) & (end(a, n + step) == end(b, n + step)), n + step).otherwise(n))

    return let(F.least(F.char_length(a), F.char_length(b)), search)


def alike(a: Column, b: Column, similarity: float = SIMILARITY) -> Column:
    """Whether the edit similarity of two normalised lines is enough. What they share at both ends doesn't change their
    distance, so only the middles are compared, and only up to the distance that is allowed. Middles are cut into equally
    many pieces first: the distances of these add up to the whole distance or more, in time linear in the length, and
    mostly to little enough. Otherwise the whole middles decide."""
    allowed = F.floor((1 - similarity) * F.greatest(F.char_length(a), F.char_length(b)) + 1e-9).cast("int")

    def middles(m):
        length = {x: F.char_length(m[x]).cast("long") for x in "ab"}
        longest = F.greatest(*length.values())
        n = F.ceil(longest / F.lit(_PIECE))
        start = lambda x, i: F.floor(i * length[x] / n)
        piece = lambda x, i: F.substring(m[x], (start(x, i) + 1).cast("int"), (start(x, i + 1) - start(x, i)).cast("int"))
        pieces = F.aggregate(F.sequence(F.lit(0).cast("long"), n - 1), F.lit(0), lambda d, i: d + F.levenshtein(piece("a", i), piece("b", i)))
        return (F.when(longest <= allowed, F.lit(True)).when(pieces <= allowed, F.lit(True))
                .otherwise(F.call_function("levenshtein", m["a"], m["b"], allowed) >= 0))

    def tails(t):
        cut = lambda n: F.struct(*[F.left(t[x], F.char_length(t[x]) - n).alias(x) for x in "ab"])
        return let(let(_shared(t["a"], t["b"], F.right), cut), middles)

    heads = lambda n: F.struct(F.right(a, F.char_length(a) - n).alias("a"), F.right(b, F.char_length(b) - n).alias("b"))
    return let(let(_shared(a, b, F.left), heads), tails)


def fuzzy_classes(lines: DataFrame, docs: DataFrame, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root): the classes of the normalised lines (by nh) that are linked to others."""
    nodes = materialise(lines.groupBy("nh").agg(F.max("fp").alias("fp"), F.max("len").alias("len"), F.count(F.lit(1)).alias("n")))
    hashes = materialise(nodes.groupBy("fp").agg(F.max_by("nh", "n").alias("hub"), F.max("n").alias("n"),
                                                 F.count(F.lit(1)).alias("c")))
    masks = key_masks(hashes.count(), max_bits)

    # Keys that hashes share, and hashes against one hub per key. (Of different hashes near one another a key holds a
    # bounded number, the patterns of max_bits bits, so a window over a key is small.)
    keys = keyed(hashes.select("fp", "n"), masks).repartition("key")
    of_key = Window.partitionBy("key")
    by_hub = (F.col("fp") != F.col("hub_fp")) & (apart("fp", "hub_fp") <= max_bits)
    shared = materialise(keys.withColumn("c", F.count(F.lit(1)).over(of_key)).withColumn("hub_fp", F.max_by("fp", "n").over(of_key))
                         .where((F.col("c") > 2) | by_hub).select("key", "fp", "hub_fp", "c"))
    stars = materialise(shared.where(by_hub).select("fp", "hub_fp").distinct())

    # Every hash that has a near one: those of the stars, and, of keys of more than two (a key of two has no pair but its
    # star), those near a hash that no star has.
    starred = stars.select("fp").union(stars.select("hub_fp")).distinct()
    crowded = shared.where("c > 2").select("key", "fp")
    lone = crowded.join(starred, "fp", "left_anti").select("key", F.col("fp").alias("lone"))
    near = lone.join(crowded, "key").where((F.col("lone") != F.col("fp")) & (apart("lone", "fp") <= max_bits))
    wanted = materialise(starred.union(near.select(F.explode(F.array("lone", "fp")).alias("fp")))
                         .union(hashes.where("c > 1").select("fp")).distinct())

    # Their lines' texts, fetched once from a document that holds them.
    members = materialise(nodes.join(wanted, "fp", "left_semi").select("nh", "fp", "len"))
    places = (lines.join(members.select("nh"), "nh", "left_semi").groupBy("nh").agg(F.min(F.struct(*ROW, "pos")).alias("p"))
              .select("nh", "p.*").groupBy(*ROW).agg(F.collect_list(F.struct("pos", "nh")).alias("places")))
    found = let(lines_of(), lambda x: F.transform("places", lambda p: F.struct(p["nh"].alias("nh"), F.get(x, p["pos"]).alias("line"))))
    texts = normalised(docs.select(*ROW, "text").join(places.hint("shuffle_hash"), ROW).select(F.inline(found)))
    texts = written(texts.dropDuplicates(["nh"]).join(members, "nh"), "line-texts")

    # Lines against the hub of their hash, and against the hubs of the hashes theirs was held against.
    hub = hashes.select(F.col("fp").alias("hub_fp"), "hub")
    own = members.select("nh", F.col("fp").alias("hub_fp"))
    held = members.select("nh", "fp").join(stars, "fp").select("nh", "hub_fp")
    tried = own.union(held).join(hub, "hub_fp").where("nh <> hub").select(F.col("nh").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialise(_verified(tried, texts, similarity))
    classes = components(links)

    # What is left: pairs of near lines in different classes.
    rooted = (members.join(classes, F.col("nh") == F.col("node"), "left")
              .select("nh", "fp", "len", F.coalesce("root", "nh").alias("root")))
    keys = keyed(rooted, masks)
    mixed = keys.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    rest = _across(keys.join(mixed, "key", "left_semi"), max_bits, similarity).select("a", "b").distinct()
    more = materialise(_verified(rest, texts, similarity))
    return classes if more.isEmpty() else components(links.union(more))


def _across(keys: DataFrame, max_bits: int, similarity: float) -> DataFrame:
    """Pairs a < b of lines of one key with near hashes, different roots and lengths that allow the similarity."""
    side = lambda n: keys.select("key", F.col("nh").alias(n), F.col("fp").alias("f" + n), F.col("root").alias("r" + n),
                                 F.col("len").alias("l" + n))
    # A distance is at least the difference of the lengths.
    long_enough = F.least("la", "lb") + F.floor((1 - similarity) * F.greatest("la", "lb") + 1e-9) >= F.greatest("la", "lb")
    return side("a").join(side("b"), "key").where(
        (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & (apart("fa", "fb") <= max_bits) & long_enough)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts are alike."""
    a = texts.select(F.col("nh").alias("a"), F.col("norm").alias("ta"))
    b = texts.select(F.col("nh").alias("b"), F.col("norm").alias("tb"))
    return pairs.join(a, "a").join(b, "b").where(alike(F.col("ta"), F.col("tb"), similarity)).select("a", "b")


def repeats(docs: DataFrame, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """(id, th, gone): the places of lines that aren't the first of their class; ``docs`` come from :func:`identified`."""
    lines = written(hashed_lines(docs.select(*ROW, "text")), "lines")
    classes = fuzzy_classes(lines, docs, max_bits, similarity)
    named = (lines.select(*ROW, "pos", "nh").join(classes, F.col("nh") == F.col("node"), "left")
             .select(*ROW, "pos", F.coalesce("root", "nh").alias("root")))
    first = (named.groupBy("root").agg(F.min(F.struct(*ROW, "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("root", "first"))
    return (named.join(first, "root").where(F.struct(*ROW, "pos") != F.col("first"))
            .groupBy(*ROW).agg(F.collect_list("pos").alias("gone")))


def deduped(docs: DataFrame, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_lines, n_removed and ``kept``, the lines that stay."""
    rows = identified(docs.select("doc_id", "text"))
    out = rows.join(repeats(rows, max_bits, similarity).hint("shuffle_hash"), ROW, "left")
    return out.select("doc_id", F.size(lines_of()).cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(rest_of(), F.lit("")).alias("kept"))


def without_repeats(docs: DataFrame, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the repeated lines taken out of their texts (n_chars, if there is one, follows)."""
    inside = identified(docs.select(F.struct(*docs.columns).alias("__row"), "doc_id"), F.col("__row.text"))
    gone = repeats(identified(docs.select("doc_id", "text")), max_bits, similarity)
    out = inside.join(gone.hint("shuffle_hash"), ROW, "left").select("*", F.col("__row.text").alias("text"))
    out = out.withColumn("__kept", rest_of())
    value = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        value["n_chars"] = F.when(F.col("gone").isNull(), F.col("__row.n_chars")).otherwise(F.char_length("__kept").cast(kind))
    return out.select(*[value.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])
