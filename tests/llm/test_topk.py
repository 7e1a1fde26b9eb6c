"""Exact top-k against all inner products."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from potluck.llm import topk


def brute(rows, asks, k, scale=256.0):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(scale * x) for x in v]))
    out = {}
    for q, v in whole:
        if asks(q):
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def run(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash")).repartition(3)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 5 == 0, k=k, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v, key=lambda r: r[0]) for q, v in got.items()}


@pytest.mark.parametrize("dim", [2, 16])
def test_against_brute_force(spark, dim):
    rng = random.Random(dim)
    rows = [(i, [float(np.float32(rng.gauss(0, 1) * (5 if i % 3 else 1))) for _ in range(dim)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # a group of equal vectors: ties to the smaller id
    assert run(spark, rows, shard_rows=64, query_block=16) == brute(rows, lambda q: q % 5 == 0, 5)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (6, [0.5, -0.25]), (None, [9.0, 9.0]),
            (10, [1.0, 2.0, 3.0]), (11, [1.0, 1.0, 1.0]), (15, []), (16, [])]
    got = run(spark, rows, shard_rows=2)
    assert got == brute(rows, lambda q: q % 5 == 0, 5)
    assert got[15] == [(1, 16, 0)]
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0])]) == {}


def test_repeated_ids_and_large_components(spark):
    """Several vectors of one query id answer together; exact beyond 2 ** 53; null beyond a long."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [5.0, 0.0]), (2, [0.0, 7.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [-9.0, -9.0])]
    want = {0: [(1, 2, 7 * 65536), (2, 1, 5 * 65536), (3, 3, 65536), (4, 3, 65536), (5, 3, 65536)]}
    assert run(spark, rows) == run(spark, rows, shard_rows=2) == want
    big = [(i, [3e7 + i * 64, -3e7 if i % 2 else 3e7, float(i)]) for i in range(12)] + [(20, [1e5, 2e5, 3e5]), (21, [1.0, 2.0, 3.0])]
    got, exact = run(spark, big, shard_rows=4), brute(big, lambda q: q % 5 == 0, 5)
    assert {q: [(r, i) for r, i, _ in v] for q, v in got.items()} == {q: [(r, i) for r, i, _ in v] for q, v in exact.items()}
    for q, v in exact.items():
        assert [s for _, _, s in got[q]] == [s if abs(s) < 1 << 63 else None for _, _, s in v]
    assert any(s is None for v in got.values() for _, _, s in v) and any(s is not None for v in got.values() for _, _, s in v)


def test_tree_prunes_and_boxes_hold():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 3)) * 256)
    tree = topk.KDTree(np.arange(4000), x, leaf=32)
    q = np.floor(rng.normal(size=(20, 3)) * 256)
    for node, rows in enumerate(tree.rows):
        if len(rows):
            assert (tree.bounds(q, [node])[:, 0] >= (q @ x[rows].T).max(axis=1) - 1e-6).all()
    best, who = tree.search(np.full(20, -1), q, 5, np.full(20, -np.inf))
    assert (best == -np.sort(-(q @ x.T), axis=1)[:, :5]).all()
