import numpy as np
import pytest
import xxhash

from shardwright.llm import graph, simhash

from .helpers import documents, edge_docs, edge_rows, empty_docs, key, rows


def plain_fingerprint(text, shingle=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(docs, max_bits=4):
    fps = [plain_fingerprint(t or "") for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(docs, fps))]


def got(df):
    return [(r["doc_id"], r["f"], r["component_id"]) for r in
            df.select("doc_id", simhash.hex_of().alias("f"), "component_id").collect()]


@pytest.mark.parametrize("docs", ["fixture", "edges"])
def test_components_match_all_pairs(spark, docs):
    df = documents(spark) if docs == "fixture" else edge_docs(spark)
    plain = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert key(got(simhash.clusters(df))) == key(plain_components(plain))


def test_empty(spark):
    assert rows(simhash.clusters(empty_docs(spark))) == []
    assert rows(simhash.one_of_each(empty_docs(spark))) == []


def test_one_of_each(spark):
    df = edge_docs(spark)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    groups = {}
    plain = [(r[0], r[1]) for r in edge_rows()]
    fps = {f for _, f, _ in plain_components(plain)}
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    components = {(c, f if c is None else "") for _, f, c in plain_components(plain)}
    assert len(left) == len(components) and fps
    assert all(d in [c for c, _ in components] for d, _ in left), groups


def all_pairs(fp, key_, max_bits):
    root = np.arange(len(fp))
    i, j = np.nonzero((np.bitwise_count(fp[:, None] ^ fp) <= max_bits) & (key_[:, None] == key_))
    return simhash.merge(root, i, j)


@pytest.mark.parametrize("seed", range(8))
def test_gray_index_finds_every_component(seed):
    r = np.random.default_rng(seed)
    centres = r.integers(0, 2 ** 64, 30, dtype=np.uint64)
    fp = r.choice(centres, 1500)
    for _ in range(r.integers(1, 6)):
        fp = fp ^ (np.uint64(1) << r.integers(0, 64, len(fp), dtype=np.uint64)) * r.integers(0, 2, len(fp), dtype=np.uint64)
    k = np.sort(r.integers(0, 4, len(fp)))
    pairs = np.unique(np.stack((k.astype(np.uint64), fp), 1), axis=0)
    k, fp = pairs[:, 0], pairs[:, 1]
    order = np.lexsort((simhash.gray_rank(fp), k))
    k, fp = k[order], fp[order]
    assert (simhash.GrayIndex(k, fp).links(4) == all_pairs(fp, k, 4)).all()


def test_gray_rank_is_the_place_in_gray_order():
    codes = np.array([i ^ i >> 1 for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


def test_large_keys_are_cut_into_cells(spark):
    r = np.random.default_rng(3)
    fps = np.unique(r.choice(np.array([5, 9 << 30, 77 << 50], np.int64), 300) ^ (1 << r.integers(0, 60, 300)))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    whole, cut = (graph.components(simhash.links(df, 4, cell)) for cell in (10 ** 6, 7))
    assert key(rows(whole)) == key(rows(cut)) and whole.count()


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(3, 3), (9, 2), (2, 9), (7, 9), (-5, 160)]
    out = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: -5 for i in [-5, *range(100, 161)]}, 2: 2, 9: 2, 7: 2}
