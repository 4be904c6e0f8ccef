"""Exact nearest neighbours by a block matrix join over int8 tiles.

Queries and candidates are cut into blocks of bounded size and every pair of
blocks meets in one task. A tile is an int8 product: each unit vector is
``scale * int8 + residual``, and with the residuals' lengths the Cauchy-Schwarz
inequality bounds how far the product is from the cosine. Pairs whose upper
bound reaches the k-th best lower bound survive; their cosine is recomputed in
double precision from the original vectors, and heaps merge the tiles.

Within a block, only the rows of a vector's k + 1 smallest ids can be among a
query's k nearest (one of them may be the query's own), and k rows of each.

Defined cases: vectors that are null, empty, zero or hold a null or a
non-finite component take no part, nor do null ids; only vectors of the same
dimension are compared; rows with the query's id are its own; ties go to the
smaller id; repeated rows of one id and vector may both be results; repeated
rows of a query's id, with equal or other vectors, are queries whose pairs are
ranked together (as in the query's SQL, so a neighbour counts once for each); an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 5
BLOCK = 8192
TILE = 1024
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) and dim of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
            .withColumn("dim", F.size("embedding")))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of scale * code, lengths of the residuals."""
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None])
    back = code * scale[:, None]
    return code.astype(np.int8), scale, np.sqrt((back ** 2).sum(1)), np.sqrt(((unit - back) ** 2).sum(1))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, original vectors and their lengths; a power of two takes out the magnitude, which is exact."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("embedding").combine_chunks()
    x = flat.flatten().to_numpy().reshape(len(ids), -1) if len(ids) else np.empty((0, 1))
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) if len(ids) else x
    return ids, x, np.sqrt((x * x).sum(axis=1))


def _distinct(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows to compare: of each vector those with the k + 1 smallest ids, k rows of an id at most."""
    seen: dict[bytes, dict[int, int]] = {}
    rows = []
    for i in np.argsort(ids, kind="stable"):
        known = seen.setdefault(x[i].tobytes(), {})
        v = int(ids[i])
        if known.get(v, 0) < k and (v in known or len(known) <= k):
            known[v] = known.get(v, 0) + 1
            rows.append(i)
    return np.array(rows, dtype=np.int64)


def search_block(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k nearest candidates of this block for each query of this block."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if queries.num_rows and candidates.num_rows:
        q_id, q, q_len = _matrix(queries)
        c_id, c, c_len = _matrix(candidates)
        rows = _distinct(c_id, c, k)
        c_id, c, c_len = c_id[rows], c[rows], c_len[rows]
        wide = np.float32 if q.shape[1] <= 1000 else np.float64  # sums of int8 products stay exact
        q_code, q_scale, _, q_res = quantise(q / q_len[:, None])
        c_code, c_scale, c_back, c_res = quantise(c / c_len[:, None])
        heaps: list[list[tuple[float, int]]] = [[] for _ in q_id]
        for a in range(0, len(q_id), TILE):
            qa = slice(a, a + TILE)
            q_tile = q_code[qa].astype(wide)
            least = np.full(len(q_tile), -np.inf)
            for b in range(0, len(c_id), TILE):
                cb = slice(b, b + TILE)
                about = (q_tile @ c_code[cb].astype(wide).T).astype(np.float64) * q_scale[qa, None] * c_scale[cb]
                slack = q_res[qa, None] * c_back[cb] + c_res[cb] + 1e-9
                own = q_id[qa, None] == c_id[cb]
                about[own] = -np.inf
                if about.shape[1] >= k:
                    low = np.partition(about - slack, about.shape[1] - k, axis=1)[:, -k]
                    least = np.maximum(least, low)
                i, j = np.nonzero(about + slack >= least[:, None] - 1e-9)
                i, j = i[(keep := ~own[i, j])], j[keep]
                exact = (q[a + i] * c[b + j]).sum(axis=1) / (q_len[a + i] * c_len[b + j])
                for x, s, v in zip((a + i).tolist(), exact.tolist(), c_id[b + j].tolist()):
                    heap = heaps[x]
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -v))
                    elif (s, -v) > heap[0]:
                        heapq.heapreplace(heap, (s, -v))
                least = np.maximum(least, [h[0][0] if len(h) == k else -np.inf for h in heaps[a:a + len(q_tile)]])
        for x, heap in zip(q_id.tolist(), heaps):
            for s, v in heap:
                out["query_id"].append(x)
                out["vec_id"].append(-v)
                out["score"].append(s)
    return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                     "score": pa.array(out["score"], pa.float64())})


def nearest(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest rows by cosine of each row that ``is_query`` marks: query_id, rank, vec_id, score."""
    every = materialise(usable(vectors))
    n, n_q = every.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    n_rows, n_cols = -(-n // block) or 1, -(-n_q // block) or 1
    place = lambda m, salt: F.pmod(F.xxhash64("vec_id", "embedding", F.lit(salt)), F.lit(m)).cast("int")
    everywhere = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = every.withColumn("row", place(n_rows, 1)).withColumn("col", everywhere(n_cols))
    queries = every.where(is_query).withColumn("col", place(n_cols, 2)).withColumn("row", everywhere(n_rows))
    cell = ["dim", "row", "col"]
    found = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(
        lambda a, b: search_block(a, b, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
