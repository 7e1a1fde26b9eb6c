"""Invariants of the ML operators (exact cell equality with other libraries
is not expected: initialisation and stop words differ)."""

from __future__ import annotations

import numpy as np
import pytest

from potluck.operators import clustering as CL

TEXTS = ["apple pie with apple and sugar", "apple tart and sugar crust", "tomato pasta with basil",
         "pasta with tomato sauce and garlic", "green salad with lemon", "lemon salad and avocado toast",
         "chocolate cake with sugar", "tomato soup with basil and garlic"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")


def test_tfidf_rows_are_unit_length(docs):
    _, feats = CL.fit_tfidf(docs, "text", max_features=50)
    norms = [float(np.linalg.norm(r["features"].toArray())) for r in feats.select("features").collect()]
    assert norms == pytest.approx([1.0] * len(TEXTS))


def test_kmeans_shapes(spark, docs):
    tfidf, km = CL.kmeans_text(docs, "text", k=3, max_features=50, seed=1)
    out = CL.assign_clusters(docs, tfidf, km).collect()
    assert len(out) == len(TEXTS) and all(0 <= r["cluster"] < 3 for r in out)
    terms = CL.top_terms_per_cluster(tfidf, km, spark, n=2).collect()
    assert len(terms) == 3 and all(len(r["top_terms"].split(", ")) == 2 for r in terms)


def test_projection_norms_are_singular_values(docs):
    _, feats = CL.fit_tfidf(docs, "text", max_features=50)
    x = np.array([r["features"].toArray() for r in feats.orderBy("id").select("features").collect()])
    s = np.linalg.svd(x, compute_uv=False)
    p = CL.project_2d(docs, id_col="id", max_features=50).orderBy("id").collect()
    xs = np.array([[r["x"], r["y"]] for r in p])
    assert np.linalg.norm(xs, axis=0) == pytest.approx(s[:2], rel=1e-6)


def test_clusters_do_not_depend_on_the_input_partitions(spark):
    docs = spark.createDataFrame([(i, TEXTS[i % len(TEXTS)] + f" extra{i % 7} word{i % 11}") for i in range(200)], "id long, text string")
    got = []
    for n in (4, 16, 32):
        tfidf, km = CL.kmeans_text(docs.repartition(n), "text", k=4, max_features=60, seed=3, id_col="id")
        got.append(sorted((r["id"], r["cluster"]) for r in CL.assign_clusters(docs, tfidf, km).collect()))
    assert got[0] == got[1] == got[2]
    row = CL.not_nearest(docs, tfidf, km).first()
    assert (row["n_docs"], row["n_not_nearest"]) == (200, 0)


def test_vocabulary_and_residuals(docs):
    v = {r["term"]: (r["total"], r["idf"]) for r in CL.vocabulary(docs).collect()}
    assert v["apple"][0] == 3 and v["apple"][1] == pytest.approx(np.log(9 / 3) + 1) and "with" not in v
    assert max(r["residual"] for r in CL.singular_residuals(docs).collect()) < 1e-6
