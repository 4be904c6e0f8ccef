import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardwright.llm import common, mixing, quality_rules, vector_search

from .helpers import documents, edge_docs, edge_rows, empty_docs, key, rows

SPACE = " \t\n\x0b\x0c\r"


def plain_measures(text):
    text = text or ""
    spaced = "".join(" " if c in SPACE else c for c in text)
    words = [w for w in spaced.split(" ") if w]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(tri)
    covered = {j for i, t in enumerate(tri) if n[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_upper": sum("A" <= c <= "Z" for c in text)}


@pytest.mark.parametrize("table", ["fixture", "edges", "empty"])
def test_ledger(spark, table):
    df = {"fixture": documents, "edges": edge_docs, "empty": empty_docs}[table](spark)
    plain = []
    for r in df.collect():
        m = plain_measures(r["text"])
        bits = sum(quality_rules.BIT[n] for n, fails in quality_rules.RULES.items() if eval(fails, {}, m))
        plain.append({"doc_id": r["doc_id"], **m, "failure_bits": bits, "base_failed": bool(bits & 3), "kept": bits == 0, "policy": "full"})
    got = rows(quality_rules.judge(quality_rules.ledger(df)))
    assert key(sorted(r.items()) for r in got) == key(sorted(r.items()) for r in plain)


def test_policies_and_ablation_read_the_ledger_only(spark):
    book = quality_rules.ledger(documents(spark)).persist()
    policy = quality_rules.Policy("two", ("symbols", "few_words"))
    bits = [r["failure_bits"] for r in book.collect()]
    judged = rows(quality_rules.judge(book, policy))
    assert [r["kept"] for r in judged] == [not (b & policy.mask or b & quality_rules.BASE.mask) for b in bits]
    for p in (policy, quality_rules.FULL):
        want = {}
        for r in p.rules:
            bit, masked = quality_rules.BIT[r], [b & p.mask for b in bits]
            want[r] = (sum(bool(b & bit) for b in masked), sum(b == bit for b in masked), sum(not b & ~bit for b in masked))
        got = {r["rule"]: (r["n_failed"], r["n_only_this"], r["n_kept_without"]) for r in rows(quality_rules.ablation(book, p))}
        assert got == want
    assert rows(quality_rules.ablation(quality_rules.ledger(empty_docs(spark)))) == []


def test_ranked_with_small_buckets(spark):
    data = [(g, (i * 7919) % 101 * (1 << 25), i) for g, n in (("a", 300), ("b", 1), ("c", 40)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, h long, i long")
    got = {(r["g"], r["i"]): r["rank"] for r in rows(common.ranked(df, ["g"], "h", ["i"], "rank", rows_per_bucket=8))}
    want = {}
    for g in "abc":
        for k, (_, h, i) in enumerate(sorted((x for x in data if x[0] == g), key=lambda x: (x[1], x[2]))):
            want[g, i] = k
    assert got == want


def test_mix_edges_and_reruns(spark):
    df = edge_docs(spark)
    out = rows(mixing.mix(df))
    assert key(r.items() for r in out) == key(r.items() for r in rows(mixing.mix(df)))
    sizes = Counter((r[0], plain_measures(r[1])["n_words"]) for r in edge_rows())
    assert Counter((r["doc_id"], r["size"]) for r in out) == sizes
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in out)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in out)
    assert rows(mixing.mix(empty_docs(spark))) == []
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in rows(mixing.mix(none))] == [(0, 0.0)] * 2


def test_size_classes_rise_with_the_size(spark):
    c = [r["c"] for r in spark.range(5000).select(F.col("id").alias("__size")).select("__size", mixing.size_class("__size").alias("c")).orderBy("__size").collect()]
    assert c == sorted(c) and c[0] == 0 and c[1] > 0 and len(set(c[1:17])) == 16


def brute(vectors, is_query, k=5):
    good = [(i, [float(x) for x in v]) for i, v in vectors if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for qi, q in good:
        if not is_query(qi):
            continue
        cos = lambda v: math.fsum(a * b for a, b in zip(q, v)) / (math.dist(q, [0] * len(q)) * math.dist(v, [0] * len(v)))
        near = sorted(((-round(cos(v), 12), i) for i, v in good if i != qi and len(v) == len(q)))[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_search_matches_brute_force(spark, block):
    r = np.random.default_rng(2)
    v = [(i, r.normal(size=12).astype(np.float32).tolist()) for i in range(150)]
    v += [(200 + i, v[3][1]) for i in range(12)]  # equal vectors: ties go to the smaller id
    v += [(300, None), (301, []), (302, [0.0] * 12), (303, [1.0] * 11 + [None]), (304, [float("nan")] + [1.0] * 11),
          (305, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (310, [3.0])]
    df = spark.createDataFrame([(i, x, "x", 1) for i, x in v], "vec_id long, embedding array<float>, dim string, rank int")
    got = vector_search.nearest(df, F.col("vec_id") % 10 == 0, 5, block)
    want = brute(v, lambda i: i % 10 == 0)
    assert [(a, b, c, round(s, 9)) for a, b, c, s in sorted(map(tuple, got.collect()))] == [(a, b, c, round(s, 9)) for a, b, c, s in want]


@pytest.mark.parametrize("tile", [3, 16, 1024])
def test_tiles_and_bounds_lose_no_neighbour(tile, monkeypatch):
    monkeypatch.setattr(vector_search, "TILE", tile)
    r = np.random.default_rng(tile)
    base = r.normal(size=(20, 16))
    v = (base[r.integers(0, 20, 300)] + r.normal(scale=1e-3, size=(300, 16))) * r.uniform(0.01, 100, (300, 1))  # crowded directions
    table = pa.table({"vec_id": pa.array(range(300)), "embedding": pa.array(v.tolist())})
    got = vector_search.search_block(table.slice(0, 40), table, 5).to_pydict()
    want = brute(list(enumerate(v.tolist())), lambda i: i < 40)
    mine = sorted(zip(got["query_id"], (-x for x in got["score"]), got["vec_id"]))
    assert [(q, i) for q, _, i in mine] == [(q, i) for q, _, i, _ in want]


def test_search_of_extreme_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1e-200, 1e-200]), (1, [1e200, 1e200]), (2, [1e200, -1e200])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], round(r["score"], 12)) for r in vector_search.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 1.0), (2, 0.0)]
    assert rows(vector_search.nearest(df.where("vec_id > 9"), F.col("vec_id") == 0)) == []


def test_entry_registers_all_queries():
    import __spark_entry__ as e
    names = e.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert {"op2_suffix_groups", "op3_block_search", "op6_mix_sources", "op8_phrase_automata", "op9_rule_ledger", "op12_hard_negatives", "op13_collocations"} <= set(e.oracle_sql())


def test_verdict_follows_the_base_measurements(spark):
    assert quality_rules.judge(quality_rules.ledger(edge_docs(spark))).columns == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_upper", "failure_bits", "policy"]
