"""Fuzzy scores by hand and against a brute-force LCS; lookups on tiny references."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from potluck.functions import fuzzy as FZ
from potluck.operators import enrich as EN


def _lcs_dp(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            m[i + 1][j + 1] = m[i][j] + 1 if a[i] == b[j] else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_lcs_matches_dynamic_programming():
    rnd = random.Random(7)
    for _ in range(300):
        a = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 12)))
        assert FZ.lcs_len(a, b) == _lcs_dp(a, b), (a, b)


def test_known_scores():
    assert FZ.ratio("this is a test", "this is a test!") == pytest.approx(96.551724, abs=1e-5)
    assert FZ.ratio("france", "french") == pytest.approx(100 * 8 / 12)
    assert FZ.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert FZ.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert FZ.token_set_ratio("", "x") == 0
    # common "new", rest "york" vs "jersey": max(ratio("new york", "new jersey"), ratio("new", ...))
    assert FZ.token_set_ratio("new york", "new jersey") == pytest.approx(FZ.ratio("new york", "new jersey"))
    assert FZ.mean_token_score("united states", "states united") == 100


def test_fuzzy_fetch_rule(spark):
    groups = [["france", "spain", "united states"], ["french", "spanish", "american"]]
    df = spark.createDataFrame([("french",), ("american",), ("xyz",), ("spain",)], "q string")
    got = {r["q"]: (r["match"], r["score"]) for r in EN.fuzzy_match(df, "q", groups).collect()}
    assert got["french"] == ("france", 100.0)
    assert got["american"][0] == "united states"
    assert got["xyz"][0] == ""
    assert got["spain"] == ("spain", 100.0)


@pytest.fixture(scope="module")
def countries(spark):
    rows = [("france", "France", "French Republic", "europe", "western europe", "french", 0),
            ("spain", "Spain", "Kingdom of Spain", "europe", "southern europe", "spanish", 1),
            ("japan", "Japan", "Japan", "asia", "eastern asia", "japanese", 2)]
    return spark.createDataFrame(rows, "name string, common_name string, official_name string, region string, "
                                       "subregion string, demonym string, country_id long")


def test_lookup_exact_order(spark, countries):
    df = spark.createDataFrame([
        (1, ["easy", "asia", "french"]),          # region before a demonym
        (2, ["europe", "kingdom of spain", "asia"]),  # official name; later region ignored
        (3, ["asia", "europe"]),                  # no country: last region wins
        (4, ["nothing"]),
    ], "id long, tags array<string>")
    got = {r["id"]: (r["country_id"], r["region_id"]) for r in EN.lookup_exact(df, "tags", countries).collect()}
    # region ids: asia=0, europe=1 (sorted names)
    assert got == {1: (0, 0), 2: (1, 1), 3: (-1, 1), 4: (-1, -1)}


def test_fetch_reference_and_infer(spark, countries):
    names = EN.reference_names(countries)
    df = spark.createDataFrame([(1, ["quick", "frenchh"]), (2, ["spanish", "france"]), (3, ["soup"]), (4, ["asia"])],
                               "id long, tags array<string>")
    out = {r["id"]: (r["country"], r["region"]) for r in EN.fetch_reference(df, ["tags"], names, countries=countries).collect()}
    assert out[1] == ("france", "europe")        # fuzzy, region inferred from the country
    assert out[2] == ("spain", "europe")         # "spanish" scores 100 first (list order)
    assert out[3] == ("", "")
    assert out[4] == ("", "asia")


def test_staged_fuzzy(spark, countries):
    df = spark.createDataFrame([(1, ["japanese"]), (2, ["kingdom of spainn"]), (3, ["zzz"])], "id long, tags array<string>")
    got = {r["id"]: r["country_id"] for r in EN.lookup_staged_fuzzy(df, "tags", countries).collect()}
    assert got == {1: 2, 2: 1, 3: -1}


def test_labels_and_least_ambiguous(spark):
    df = spark.createDataFrame([
        (1, ["winter", "christmas"], "soup", "a falling leaf"),
        (2, ["easy"], "summer salad", "for spring"),
        (3, ["easy"], "cake", "easter treat"),
        (4, ["winter", "summer"], "x", "fall"),
    ], "id long, tags array<string>, name string, description string")
    lab = {r["id"]: (r["season"], r["event"]) for r in EN.label_periods(df).collect()}
    assert lab == {1: ("winter", "christmas"), 2: ("summer", ""), 3: ("spring", "easter"), 4: ("winter", "")}
    la = {r["id"]: (r["season"], r["event"]) for r in EN.label_periods_least_ambiguous(df).collect()}
    assert la[1] == ("winter", "christmas") and la[4] == ("fall", "") and la[3] == ("", "easter")
    assert EN.fetch_period(df).count() == 4
    assert F is not None


@pytest.mark.parametrize("scorer", list(FZ.SCORERS))
def test_index_gives_the_first_best_of_all_names(scorer):
    rnd = random.Random(scorer)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    names = [" ".join(word() for _ in range(rnd.randint(0, 3))) for _ in range(120)] + ["", "a a b", "a b"]
    names += names[:10]  # ties: the first one wins
    index = FZ.NameIndex(names, scorer)
    for _ in range(150):
        query = rnd.choice([word(), f"{word()} {word()}", rnd.choice(names) or "b", "b a"])
        scores = [FZ.SCORERS[scorer](query, n) for n in names]
        bounds = index.bounds(query)
        assert all(s <= b + 1e-9 for s, b in zip(scores, bounds)), (query, scorer)
        place, score = index(query)
        assert score == pytest.approx(max(scores)) and place == scores.index(max(scores)), query


def test_index_scores_few_pairs():
    rnd = random.Random(3)
    names = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 12))) for _ in range(2000)]
    index = FZ.NameIndex(names)
    for k in range(100):
        index(names[k][:-1] + "z")
    assert index.scored < 100 * 40  # of 2000 names a query


def test_scan_over_chunks_equals_one_chunk(spark, countries):
    names = EN.reference_names(countries)
    tokens = spark.createDataFrame([(t,) for t in ["french", "france", "asia", "xyz", "", None, "japan-ese", "spain", "spain"]], "t string")
    one = {tuple(r[c] for c in ("token", "kind", "pos", "ref", "name", "score")) for r in EN.best_matches(tokens, names).collect()}
    assert len(one) == 12 and all(r["scored"] >= 1 for r in EN.best_matches(tokens, names).collect())
    few = EN.best_matches(tokens, names, max_bytes=100)
    assert {tuple(r[c] for c in ("token", "kind", "pos", "ref", "name", "score")) for r in few.collect()} == one
    plan = EN.best_matches(tokens, names)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan
    assert EN.best_matches(tokens, names.where("kind = 'none'")).count() == 0
