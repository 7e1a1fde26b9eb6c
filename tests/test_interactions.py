"""Interaction operators on the 6-row fixture (values worked out by hand)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from potluck.operators import aggregates as E
from potluck.operators import quality as Q
from potluck.operators import stats as S
from potluck.operators import timeseries as T
from potluck.operators.cleaning import text_features


def test_rating_range(interactions):
    r = Q.value_ranges(interactions, ["rating"]).collect()[0]
    assert (r["min"], r["max"]) == (2.0, 5.0)


def test_user_bias_counts(interactions):
    rows = {r["user_id"]: r for r in E.user_bias(interactions).collect()}
    assert rows[3]["n"] == 3
    assert rows[1]["mean"] == 4.5 and rows[1]["median"] == 4.5
    assert [r["user_id"] for r in E.user_bias(interactions).collect()][0] == 3  # most active first


def test_by_month(interactions):
    rows = T.by_month(interactions).collect()
    assert [r["n"] for r in rows] == [1, 2, 1, 2]
    assert [r["mean_rating"] for r in rows] == [5.0, 3.5, 5.0, 3.0]
    assert rows[0]["month"] == dt.datetime(2020, 1, 1)


def test_monthly_rolling_and_yoy(interactions):
    rows = T.monthly_rolling(interactions, window=3).collect()
    assert [r["n_roll3"] for r in rows] == [1.0, 1.5, 4 / 3, 5 / 3]
    yoy = T.monthly_yoy(interactions).collect()
    assert all(r["n_yoy"] is None for r in yoy)  # fewer than 13 months


def test_anomalies_zero_sigma(spark):
    df = spark.createDataFrame([(1, 5.0, dt.datetime(2020, m, 1)) for m in (1, 2, 3)], "user_id long, rating double, date timestamp_ntz")
    rows = T.monthly_anomalies(df).collect()
    assert all(r["z_n"] == 0.0 and not r["is_anomaly"] for r in rows)


def test_cohorts(interactions):
    got = {(r["cohort"].strftime("%Y-%m"), r["age"]): r["n"] for r in T.cohorts(interactions).collect()}
    assert got == {("2020-01", 0): 1, ("2020-01", 1): 1, ("2020-02", 0): 1, ("2020-03", 0): 1, ("2020-03", 1): 2}
    m = T.cohort_matrix(interactions).collect()
    assert m[0]["age_0"] == 1 and m[0]["age_1"] == 1 and m[0]["age_12"] == 0


def test_hist_rating(interactions):
    assert [r["count"] for r in S.hist_rating(interactions).collect()] == [0, 1, 1, 2, 2]


def test_decomposition_needs_24_months(interactions):
    assert T.seasonal_decompose(interactions).count() == 0


def test_text_features_null_review(interactions):
    tf = text_features(interactions, "review").orderBy("date").collect()
    assert tf[5]["review_len"] == 0 and tf[5]["review_words"] == 0
    assert tf[3]["review_has_caps"] and tf[3]["review_exclamations"] == 3
    assert tf[1]["review_mentions_thanks"] and not tf[0]["review_mentions_thanks"]


def test_tokens_by_rating(interactions):
    rows = E.tokens_by_rating(interactions, k=2).collect()
    by = {}
    for r in rows:
        by.setdefault(r["rating"], []).append((r["token"], r["count"]))
    assert by[5] == [("amazing", 1), ("best", 1)]  # ties by token
    assert by[3] == [("ok", 1), ("taste", 1)]
    assert "!" not in "".join(t for v in by.values() for t, _ in v)


def test_weekday_and_heat(interactions):
    wk = {r["wk"]: r["n"] for r in T.weekday_profile(interactions).collect()}
    assert sum(wk.values()) == 6 and wk[2] == 2  # 2020-01-15 and 2020-04-01 are Wednesdays
    heat = T.weekday_hour_heat(interactions).collect()
    assert sum(r["n"] for r in heat) == 6


def test_agg_by_user_null_user_kept(spark, interactions):
    extra = spark.createDataFrame([(None, 10, 1.0, "x", dt.datetime(2020, 5, 1))], interactions.schema)
    rows = E.agg_by_user(interactions.unionByName(extra)).collect()
    assert any(r["user_id"] is None for r in rows)
    assert {r["user_id"]: r["n_reviews"] for r in rows}[3] == 3


def test_filters(interactions):
    from potluck.operators.filters import filter_interactions

    out = filter_interactions(interactions, rating_range=(3, 5), review_len_range=(0, 10), year_range=(2020, 2020))
    assert sorted(out.columns) == sorted(interactions.columns)
    assert out.count() == 2  # "ok taste" (8) and the null review (0)


def test_duplicates_interactions(spark, interactions):
    assert Q.duplicates_interactions(interactions).count() == 0
    dup = interactions.unionByName(interactions.limit(1))
    got = {r["kind"]: r["n_duplicates"] for r in Q.duplicates_interactions(dup).collect()}
    assert got == {"user_recipe_date": 1, "full": 1}


def test_seasonal_profile_has_12_rows(interactions):
    rows = T.seasonal_profile(interactions).collect()
    assert len(rows) == 12 and rows[0]["n_mean"] == 1.0 and rows[11]["n_mean"] is None


def test_rating_trend(interactions):
    r = E.rating_length_trend(interactions).collect()[0]
    assert r["n"] == 6 and r["slope"] is not None
    assert F is not None
