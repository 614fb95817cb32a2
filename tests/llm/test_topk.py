"""Operator 9 against brute force and SQL."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from stationlake.llm import queries, topk

SF = "/root/testdata/sf0.001"


def brute(rows, k=topk.K, every=topk.EVERY):
    ok = [(v, [math.floor(64 * x) for x in e]) for v, e in rows
          if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (q, a) in enumerate(ok):
        if q is not None and q % every == 0:
            s = sorted(((-sum(x * y for x, y in zip(a, b)), v is None, v or 0) for j, (v, b) in enumerate(ok) if j != i))
            out += [(q, r + 1, None if null else v, -x) for r, (x, null, v) in enumerate(s[:k])]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_all_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = result(queries.op9_topk(spark, SF))
    assert got == brute([(r.vec_id, list(r.embedding)) for r in rows])
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert got == sorted(con.sql(topk.oracle()).fetchall(), key=repr)


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = ([(i, [float(i % 3), -1.5]) for i in range(45)] + [(0, [1.0, 1.0]), (20, [0.0, -1.5]), (None, [2.0, 0.0]),
            (60, None), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, []), (-20, [0.5, 0.25, 3.0]),
            (7, [1.0, 1.0])])
    df = spark.createDataFrame([(v, e, 1) for v, e in rows], "vec_id long, embedding array<float>, score int")
    for block, query_block, group in ((4, 2, 2), (4096, 1024, 8)):
        assert result(topk.top_k(df, block=block, query_block=query_block, group=group)) == brute(rows)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 7")).count() == 0
    assert topk.top_k(df.where("vec_id = 40")).count() == 0  # alone: no candidate


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 64)) * 40
    x = np.floor(centre[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 64)) * 4).astype(np.int64)
    q = x[:30]
    exact = q @ x.T
    for length in (16, 4, 7):
        bound = topk.statistics(q.astype(float), length) @ topk.statistics(x.astype(float), length).T
        assert (bound + 1e-6 >= exact).all()
    best, made = topk.Best(30, 5), 0
    for at in range(0, 2000, 200):
        own = np.where(np.arange(30) // 200 == at // 200, np.arange(30), -1) if at == 0 else np.full(30, -1)
        made += topk.search(best, q, x[at:at + 200], np.arange(at, at + 200), np.zeros(200, bool), own)
    assert made < 0.5 * 30 * 2000  # far pairs are never multiplied
    for i in range(30):
        order = sorted((-exact[i, j], j) for j in range(2000) if j != i)[:5]
        assert [(-s, j) for s, j in order] == list(zip(best.score[i].tolist(), best.vec[i].tolist()))


@pytest.mark.parametrize("size", [2 ** 30, 2 ** 40])
def test_large_numbers(size):
    q, x = np.array([[size, -3]]), np.array([[size, 1], [-size, 2]])
    got = topk.products(q, x, np.array([0, 0]), np.array([0, 1])).tolist()
    assert got == [min(2 ** 63 - 1, size * size - 3), max(-2 ** 63, -size * size - 6)]
