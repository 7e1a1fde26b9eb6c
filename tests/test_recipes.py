"""Catalogue operators on the 4-row recipes fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import aggregates as E
from potluck.operators import cleaning as B
from potluck.operators import filters as C
from potluck.operators import quality as Q
from potluck.operators import stats as S
from potluck.operators import text as TX


def test_duplicates(recipes):
    got = {r["kind"]: r["n_duplicates"] for r in Q.duplicates_recipes(recipes).collect()}
    assert got == {"id": 1, "id_name": 1, "full": 0}


def test_by_year(recipes):
    assert {r["year"]: r["n"] for r in E.by_year(recipes).collect()} == {2020: 3, 2021: 1}


def test_histograms_sum_to_rows(recipes):
    assert sum(r["count"] for r in S.histogram(recipes, "minutes", 40).collect()) == 4
    h = S.histogram(recipes, "n_steps", 25).collect()
    assert len(h) == 25 and sum(r["count"] for r in h) == 4
    assert h[-1]["count"] == 1 and h[-1]["right"] == 8.0  # max falls in the closed last bin


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    h = S.histogram(df, "v", 4).collect()
    assert h[0]["left"] == 4.5 and h[-1]["right"] == 5.5 and sum(r["count"] for r in h) == 2


def test_season_counts(recipes):
    got = {r["season"]: r["n"] for r in E.count_by_dimension(recipes, "season").collect()}
    assert got == {"winter": 1, "summer": 1, "all": 2}


def test_top_ingredients(recipes):
    rows = [(r["ingredient"], r["count"]) for r in E.top_ingredients(recipes, 4).collect()]
    assert rows == [("pasta", 2), ("tomato", 2), ("apple", 1), ("avocado", 1)]


def test_unique_tags(recipes):
    vals = [r["value"] for r in S.distinct_values(recipes, "tags").orderBy("index").collect()]
    assert vals == sorted({"dessert", "baked", "italian", "quick", "garlicky", "breakfast"})


def test_signatures_top_n(recipes):
    sig = TX.signature_tfidf(recipes, "country", "ingredients", top_n=2)
    per = sig.groupBy("country").count().collect()
    assert all(r["count"] <= 2 for r in per)
    # "tomato" and "pasta" occur in one of two countries only: both kept for IT
    it = {r["term"] for r in sig.where(F.col("country") == "IT").collect()}
    assert it == {"pasta", "tomato"}


def test_signature_values_by_formula(recipes):
    # two groups; terms in both groups (df=2 > 0.5*2) are dropped
    sig = {(r["country"], r["term"]): (r["tfidf"], r["tf"]) for r in
           TX.signature_tfidf(recipes, "country", "ingredients", top_n=10).collect()}
    # IT: tomato 2, pasta 2, basil 1, garlic 1 -> idf equal for all (df=1)
    tf_it = sig[("IT", "tomato")][1]
    assert abs(tf_it - 2 / 6) < 1e-12
    l2 = (4 + 4 + 1 + 1) ** 0.5
    assert abs(sig[("IT", "basil")][0] - 1 / l2) < 1e-12


def test_filter_recipes_and_tags(recipes):
    out = C.filter_recipes(recipes, minutes_range=(10, 20), steps_range=(3, 5))
    assert out.count() == 3 and out.columns == recipes.columns
    out = C.filter_tags_ingredients(recipes, include_tags=["quick"], exclude_tags=["garlicky"], ingredients=["toma"])
    assert [r["id"] for r in out.collect()] == [2]


def test_nutrition_expand(recipes):
    out, info = B.expand_nutrition(recipes, "nutrition")
    r = out.where(F.col("id") == 1).collect()[0]
    assert (r["calories"], r["carbohydrates"]) == (250.0, 40.0)
    assert info.collect()[0]["parsed_nut_column"]


def test_minutes_stats_exact(recipes):
    r = Q.minutes_stats(recipes).collect()[0]
    # pandas describe on [45, 20, 20, 10]
    assert r["count"] == 4 and r["min"] == 10 and r["max"] == 45
    assert r["p50"] == 20.0 and r["p25"] == 17.5 and r["p75"] == 26.25
    assert abs(r["p95"] - 41.25) < 1e-12


def test_duration_bands_labels(spark):
    df = spark.createDataFrame([(m,) for m in [5, 60, 1500, 600000]], "minutes long")
    bands = {r["band"]: r["label"] for r in S.duration_bands(df).collect()}
    assert bands["All"] == "5m - 1y 1mo 21d 6h"
    assert S.duration_bands(df).count() == 7


def test_cardinalities_lists(recipes):
    got = {r["column_name"]: r["cardinality"] for r in Q.cardinalities(recipes).collect()}
    assert got["ingredients"] == 4 and got["tags"] == 4 and got["season"] == 3


def test_na_counts(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "a"), (None, "b")], "x double, s string")
    got = {r["column_name"]: r["na_count"] for r in Q.na_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_time_tags(spark):
    df = spark.createDataFrame([(1, ["15-minutes", "easy", "4-hours", "1-day-or-more", "30-minutes-or-less"])],
                               "id long, tags array<string>")
    r = TX.extract_time_tags(df).collect()[0]
    assert r["time_tags"] == ["15-minutes", "4-hours", "1-day-or-more", "30-minutes-or-less"]


def test_minutes_stats_approx_option(recipes):
    r = Q.minutes_stats(recipes, approx=True).collect()[0]
    # the sketch returns observed values: nearest ranks of [10, 20, 20, 45]
    assert r["count"] == 4 and r["p50"] == 20.0 and r["p95"] == 45.0 and r["min"] == 10
