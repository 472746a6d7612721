import math
import random

import duckdb
import numpy as np

from fleetlens.llm import queries
from fleetlens.llm import vector_search as V

from .helpers import SF, rows

KIND = "vec_id bigint, embedding array<float>, dim int, score int"


def brute(vectors, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in e]) for i, e in vectors
          if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, e in ok:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(e, f)), i) for i, f in ok if i != q and len(f) == len(e))[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert sorted(rows(queries.op6_vector_top_k(spark, SF))) == sorted(con.execute(V.ORACLE).fetchall())


def test_ties_odd_vectors_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "LEAST_ROWS", 16)
    monkeypatch.setattr(V, "QUERY_ROWS", 2)
    r = random.Random(2)
    vectors = [(i, [r.choice([-1.0, 0.0, 0.5, 2.25]) for _ in range(3)]) for i in range(200)]
    vectors += [(1000, None), (1050, [1.0, None, 2.0]), (1100, [1.0, float("nan"), 1.0]), (1150, [float("inf")] * 3), (1200, []),
                (None, [9.0, 9.0, 9.0]), (1250, [1.0, 2.0]), (1300, [3e38, -3e38])]
    df = spark.createDataFrame([(*v, 1, 1) for v in vectors], KIND)
    got = sorted(rows(V.top_k(df, V.every(df))))
    want = brute(vectors)
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    assert got == [(q, n, i, clip(s)) for q, n, i, s in want]


def test_bounds_hold():
    r = np.random.default_rng(0)
    v, q = r.integers(-300, 300, (400, 7)).astype(float), r.integers(-300, 300, (20, 7)).astype(float)
    low, high = V.ApproximationFile(v).bounds(q)
    exact = q @ v.T
    assert (low <= exact).all() and (exact <= high).all()


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0], 1, 1), (1, [2.0], 1, 1), (1, [2.0], 1, 1)], KIND)
    assert sorted(rows(V.top_k(df, V.every(df)))) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
    none = df.limit(0)
    assert rows(V.top_k(none, V.every(none))) == []
