"""Dictionary codes and Walsh-Hadamard clusters against plain Python."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from potluck.llm import dictionary_codes, walsh

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def ints(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def fits(x):
    return x if x < 1 << 63 else None


def order(i):
    return (i is None, i if i is not None else 0)


def brute_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, ints(v, scale), l) for i, v, l in rows if usable(v)]
    out = []
    for dim in sorted({len(v) for _, v, _ in kept}):
        mine = [r for r in kept if len(r[1]) == dim]
        spans = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
        first = sorted(mine, key=lambda r: (order(r[0]), r[1]))[:entries]
        book = [[r[1][lo:hi] for r in first] for lo, hi in spans]
        for step in range(rounds + 1):
            codes = [[min(range(len(book[p])), key=lambda e: (far(v[lo:hi], book[p][e]), e)) for p, (lo, hi) in enumerate(spans)] for _, v, _ in mine]
            if step == rounds:
                break
            for p, (lo, hi) in enumerate(spans):
                for e in range(len(book[p])):
                    has = [v[lo:hi] for (_, v, _), c in zip(mine, codes) if c[p] == e]
                    if has:
                        book[p][e] = [sum(x) // len(has) for x in zip(*has)]
        digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
        for (i, v, l), c in zip(mine, codes):
            error = sum(far(v[lo:hi], book[p][c[p]]) for p, (lo, hi) in enumerate(spans))
            out.append((i, "".join(f"{x:02x}" for x in c), fits(error), l, digest))
    sums = {}
    for _, _, e, l, _ in out:
        sums[l] = sums.get(l, 0) + (e or 0)
    return sorted(((i, c, e, fits(sums[l]), d) for i, c, e, l, d in out), key=repr)


def spark_codes(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("clash")).withColumn("dim", F.lit(1)).repartition(3)
    return sorted((tuple(r) for r in dictionary_codes.codes(df, **options).collect()), key=repr)


def brute_clusters(rows, k=8, length=64, rounds=10, scale=1024):
    kept = [(i, ints(v, scale)) for i, v, _ in rows if usable(v) and len(v) == length]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), order(r[0]), r[1])
    points = [v for _, v in sorted(kept, key=key)[:k]]
    for step in range(rounds + 1):
        who = [min(range(len(points)), key=lambda c: (far(v, points[c]), c)) for _, v in kept]
        if step == rounds:
            break
        for c in range(len(points)):
            mine = [v for (_, v), w in zip(kept, who) if w == c]
            if mine:
                points[c] = [sum(x) // len(mine) for x in zip(*mine)]
    d = [far(v, points[w]) for (_, v), w in zip(kept, who)]
    total = lambda ys: fits(sum(y for y in ys if fits(y) is not None))
    return sorted(((i, w, fits(x), total(y for y, z in zip(d, who) if z == w), total(d),
                    hashlib.sha256(",".join(map(str, points[w])).encode()).hexdigest()) for (i, _), w, x in zip(kept, who, d)), key=repr)


def spark_clusters(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("clash")).repartition(3)
    return sorted((tuple(r) for r in walsh.assign(df, **options).collect()), key=repr)


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [float(np.float32(x + rng.gauss(0, 0.3) * spread)) for x in centres[i % 5]], i % 4 if i % 7 else None) for i in range(n)]


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("dim", [64, 35])
def test_codes_against_brute_force(spark, dim):
    rows = vectors(150, dim, dim)
    rows += [(1000 + i, rows[3][1], 1) for i in range(40)] + [rows[5], rows[5]]  # equal vectors, repeated rows
    assert spark_codes(spark, rows) == brute_codes(rows)


def test_codes_edge_cases(spark):
    rows = vectors(10, 32, 1) + [(0, [0.5] * 32, 2), (None, [0.25] * 32, None), (50, None, 1), (51, [None] + [1.0] * 31, 1), (52, [NAN] * 32, 1),
                                 (53, [INF] * 32, 1), (54, [1.0, 2.0], None), (55, [3.0, 4.0], 9), (56, [], 9)]
    assert spark_codes(spark, rows) == brute_codes(rows)
    assert spark_codes(spark, rows, rounds=0, entries=4) == brute_codes(rows, rounds=0, entries=4)
    assert spark_codes(spark, []) == []
    with pytest.raises(ValueError):
        spark_codes(spark, rows, entries=257)


def test_codes_of_very_large_components(spark):
    rows = vectors(30, 16, 2, spread=3e6) + [(99, [3e7 * (1 if k % 2 else -1) for k in range(16)], 0), (98, [1e16] * 16, 0)]
    want = brute_codes(rows, entries=8)
    assert any(e is None for _, _, e, _, _ in want)
    assert spark_codes(spark, rows, entries=8) == want


def test_hot_labels_are_summed_whole(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 9 > 0, F.col("id").cast("int")).alias("label"), F.col("id").alias("error"))
    got = dictionary_codes.sum_by_label(df, "error", "total")
    want = df.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("s"))
    assert got.count() == 5000
    assert got.join(want, got["label"].eqNullSafe(want["l"])).where("total <> s or total is null").count() == 0


def test_tables_give_all_squared_differences():
    x = np.random.default_rng(0).integers(-300, 300, size=(200, 8))
    block = dictionary_codes.Block.of(x)
    assert all((block.values[j][block.codes[j]] == x[:, j]).all() for j in range(8))
    book = [[list(map(int, x[k, 0:4])) for k in range(9)]]
    want = ((x[:, None, 0:4] - x[None, :9, 0:4]) ** 2).sum(axis=2)
    assert (block.distances(book, 0, (0, 4), 200) == want).all()


def test_clusters_against_brute_force(spark):
    rows = vectors(160, 64, 3)
    rows += [(1000 + i, rows[3][1], 1) for i in range(30)] + [rows[5], rows[5]]
    assert spark_clusters(spark, rows) == brute_clusters(rows)


def test_clusters_edge_cases(spark):
    rows = vectors(6, 64, 4) + [(None, [0.5] * 64, 0), (50, None, 1), (51, [None] + [1.0] * 63, 1), (52, [NAN] * 64, 1), (53, [INF] * 64, 1), (54, [1.0] * 63, 1),
                                (55, [1.0] * 65, 1), (56, [], 1)]
    assert spark_clusters(spark, rows) == brute_clusters(rows)  # fewer rows than centroids
    assert spark_clusters(spark, []) == []
    small = vectors(40, 4, 5)
    assert spark_clusters(spark, small, length=4, k=3, rounds=2) == brute_clusters(small, length=4, k=3, rounds=2)
    with pytest.raises(ValueError):
        spark_clusters(spark, small, length=6)


def test_clusters_of_very_large_components(spark):
    rows = vectors(30, 8, 6, spread=1e6) + [(99, [3e7 * (1 if k % 2 else -1) for k in range(8)], 0), (98, [1e13] * 8, 0)]
    assert spark_clusters(spark, rows, length=8, k=3, rounds=3) == brute_clusters(rows, length=8, k=3, rounds=3)


def test_transform_is_exact_and_search_eliminates():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, size=(500, 64))
    spectrum = walsh.transform(x)
    assert (spectrum[:, 0] == x.sum(axis=1)).all()  # the coarsest coefficient
    assert walsh.restore(spectrum[7].tolist()) == x[7].tolist()
    assert [int((np.diff(walsh._hadamard(64)[r]) != 0).sum()) for r in walsh.sequency_order(64)] == list(range(64))
    centres = np.concatenate([x[:3] * 3, x[:1] * 3, x[3:8] * 3])  # two equal centroids
    seen = []
    who, far_ = walsh.nearest(spectrum, walsh.transform(centres), seen)
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (who == d.argmin(axis=1)).all() and (far_ == 64 * d.min(axis=1)).all()
    near = walsh.transform(np.repeat(centres, 50, axis=0) + rng.integers(-9, 9, size=(450, 64)))
    seen = []
    walsh.nearest(near, walsh.transform(centres), seen)
    assert seen[0] == 450 * 9 and seen[-1] < 450 * 3  # most centroids are gone before the finest coefficients
