"""Lloyd steps in whole numbers against a brute-force version, and the model store."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import pytest

from potluck.operators import model_store as MS
from potluck.operators import text_clusters as TC
from tests.test_clustering import TEXTS

STOP = ["with", "and"]


def brute(docs: dict[int, str | None], k: int, features: int, steps: int):
    counts = {i: Counter(w for w in re.findall(r"\w{2,}", (t or "").lower()) if w not in STOP) for i, t in docs.items()}
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    vocab = sorted(total, key=lambda w: (-total[w], w))[:features]
    idf = {w: math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in vocab}
    x = {}
    for i, c in counts.items():
        raw = [c[w] * idf[w] for w in vocab]
        n = math.sqrt(sum(r * r for r in raw))
        x[i] = [math.floor(r / n * TC.SCALE + 0.5) if n else 0 for r in raw]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    some = sorted(i for i in x if any(x[i]))
    centers = [x[some[0]]]
    while len(centers) < k:
        far = max(some, key=lambda i: (min(dist(x[i], c) for c in centers), -i))
        if min(dist(x[far], c) for c in centers) == 0:
            break
        centers.append(x[far])
    near = lambda i: min(range(len(centers)), key=lambda c: (dist(x[i], centers[c]), c))
    for _ in range(steps):
        own = {i: near(i) for i in x}
        for c in range(len(centers)):
            rows = [x[i] for i in x if own[i] == c]
            if rows:
                centers[c] = [sum(col) // len(rows) for col in zip(*rows)]
    tops = [", ".join(sorted((w for w, v in zip(vocab, c) if v > 0), key=lambda w: (-c[vocab.index(w)], w))[:3]) for c in centers]
    return {i: near(i) for i in x}, {i: min(dist(x[i], c) for c in centers) / TC.SCALE ** 2 for i in x}, tops


@pytest.fixture(scope="module")
def texts():
    docs = {i: TEXTS[i % len(TEXTS)] + f" extra{i % 7} word{i % 11}" for i in range(60)}
    return {**docs, 60: None, 61: "", 62: "a", 63: TEXTS[0]}


def table(spark, docs):
    return spark.createDataFrame(list(docs.items()), "id long, text string")


@pytest.mark.parametrize("k, features", [(4, 25), (1, 8000)])
def test_clusters_equal_brute_force(spark, texts, k, features):
    own, gap, tops = brute(texts, k, features, 6)
    df = table(spark, texts)
    t = TC._lloyd(df, "id", "text", k, features, 6, STOP)
    model = TC.TextClusters(t["vocab"], t["centers"], tuple(STOP))
    got = {r["id"]: (r["cluster"], r["distance"]) for r in TC.assign_text_clusters(df, model).collect()}
    assert {i: c for i, (c, _) in got.items()} == own
    assert [got[i][1] for i in texts] == pytest.approx([gap[i] for i in texts])
    terms = {r["cluster"]: r["top_terms"] for r in TC.center_terms(model, 3).collect()}
    assert [terms[c] for c in range(k)] == tops


def test_partitions_and_copies(spark, texts):
    """The same clusters from any partitions; rows of one id are one text; fewer
    distinct texts than k give fewer clusters."""
    got = []
    for n in (1, 7):
        df = table(spark, texts).repartition(n)
        t = TC._lloyd(df, "id", "text", 4, 50, 10, STOP)
        got.append([tuple(r["c"]) for r in t["centers"].orderBy("cluster").collect()])
    assert got[0] == got[1]
    same = table(spark, {1: "apple pie", 2: "apple pie", 3: "tomato"})
    model = TC.fit_text_clusters(same.withColumnRenamed("id", "t"), "t", k=5)
    assert model.centers.count() == 2
    twice = spark.createDataFrame([(1, "apple"), (1, "pie")], "t long, text string")
    assert [r["cluster"] for r in TC.assign_text_clusters(twice, model, "t").collect()] == [0]


def test_no_terms(spark):
    with pytest.raises(ValueError):
        TC.fit_text_clusters(spark.createDataFrame([], "id long, text string"))


def test_store_fits_once(spark):
    runs = []
    name = f"m{uuid.uuid4().hex}"  # the folder may outlive a test run
    df = spark.createDataFrame([(i, f"t{i}") for i in range(9)], "id long, text string")

    def fit():
        runs.append(1)
        return {"a": spark.createDataFrame([(len(runs),)], "n int"), "b": df.limit(0)}

    first = MS.fitted(df, name, {"k": 1}, fit)
    again = MS.fitted(df.repartition(5), name, {"k": 1}, fit)  # the same rows in another order
    assert len(runs) == 1 and first["a"].collect() == again["a"].collect() and again["b"].count() == 0
    MS.fitted(df, name, {"k": 2}, fit)
    MS.fitted(df.where("id < 8"), name, {"k": 1}, fit)
    assert len(runs) == 3


def test_a_broken_fit_is_not_read(spark):
    name = f"m{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "x")], "id long, text string")

    def broken():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        MS.fitted(df, name, {}, broken)
    assert MS.fitted(df, name, {}, lambda: {"a": df})["a"].count() == 1
