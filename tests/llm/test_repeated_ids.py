"""Repeated rows of a query's id, against the query's SQL."""
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardwright.llm import vector_search
from shardwright.llm.queries import ORACLES


@pytest.mark.parametrize("block", [7, 8192])
def test_repeated_query_and_candidate_rows(spark, block):
    r = np.random.default_rng(4)
    v = [(i, r.normal(size=8).tolist()) for i in range(1, 120)]
    same, other = v[49][1], r.normal(size=8).tolist()
    v += [(50, same)] * 8 + [(51, same), (52, same)]  # many own rows beside two neighbours with the same vector
    v += [(100, other), (100, other), (100, [x + 0.5 for x in other])]  # conflicting rows of a query's id
    v += [(60, other)] * 7 + [(61, other)]  # one candidate many times
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([i for i, _ in v]), "embedding": pa.array([x for _, x in v])}))
    want = con.execute(ORACLES["op3_block_search"]).fetchall()
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = vector_search.nearest(df, F.col("vec_id") % 50 == 0, 5, block).collect()
    short = lambda x: sorted((a, b, c, round(s, 9)) for a, b, c, s in map(tuple, x))
    assert short(got) == short(want)
    assert {c for a, _, c, _ in short(got) if a == 50} == {51}
