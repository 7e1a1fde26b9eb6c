"""Registered aggregates (E1-E12) and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import aggregates as E
from potluck.operators import filters as C
from potluck.plans import proxies as P
from potluck.plans.registry import register, rounded

_I = P.with_ctes(P.SQL_INTERACTIONS)
_R = P.with_ctes(P.SQL_RECIPES)
_RV = P.with_ctes(P.SQL_REVIEWS)
_G = P.with_ctes(P.SQL_GEO)


# ---------------------------------------------------------------- E1-E3 -----
def _agg_sql(key: str, where: str = "") -> str:
    return _I + f"""SELECT {key}, count(*) AS n_reviews, round(avg(rating), 6) AS mean_rating,
  round(quantile_cont(rating, 0.5), 6) AS median_rating,
  round(quantile_cont(length(coalesce(review, '')), 0.95), 6) AS p95_len
FROM interactions {where} GROUP BY {key}"""


@register("agg_by_user", _agg_sql("user_id"))
def q_agg_by_user(spark, sf):
    return rounded(E.agg_by_user(P.interactions(spark, sf)))


@register("agg_by_recipe", _agg_sql("recipe_id", "WHERE recipe_id IS NOT NULL"))
def q_agg_by_recipe(spark, sf):
    return rounded(E.agg_by_recipe(P.interactions(spark, sf)))


@register("agg_by_user_reviews", _RV + """SELECT user_id, count(*) AS n_reviews, round(avg(rating), 6) AS mean_rating,
  round(quantile_cont(rating, 0.5), 6) AS median_rating,
  round(quantile_cont(length(coalesce(review, '')), 0.95), 6) AS p95_len
FROM reviews GROUP BY user_id""")
def q_agg_by_user_reviews(spark, sf):
    return rounded(E.agg_by_user(P.reviews(spark, sf)))


@register("user_bias", _I + """SELECT user_id, count(*) AS n, round(avg(rating), 6) AS mean, round(quantile_cont(rating, 0.5), 6) AS median
FROM interactions WHERE user_id IS NOT NULL GROUP BY user_id""")
def q_user_bias(spark, sf):
    return rounded(E.user_bias(P.interactions(spark, sf)))


# ---------------------------------------------------------------- E4/E5 -----
@register("by_year", _R + "SELECT CAST(year(submitted) AS INTEGER) AS year, count(*) AS n FROM recipes WHERE submitted IS NOT NULL GROUP BY 1")
def q_by_year(spark, sf):
    return E.by_year(P.recipes(spark, sf))


@register("by_calendar_month", _R + """, c AS (SELECT CAST(month(submitted) AS INTEGER) AS month_num, count(*) AS n FROM recipes
  WHERE submitted IS NOT NULL GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS month_num, """ + "[" + ", ".join(f"'{m}'" for m in E.MONTH_NAMES) + """][r.range] AS month, c.n
FROM range(1, 13) r LEFT JOIN c ON c.month_num = r.range""")
def q_by_calendar_month(spark, sf):
    return E.by_calendar_month(P.recipes(spark, sf))


# ---------------------------------------------------------------- E6/E7 -----
@register("top_ingredients", _R + """SELECT ingredient, count(*) AS count FROM (
  SELECT trim(lower(unnest(ingredients))) AS ingredient FROM recipes) WHERE ingredient IS NOT NULL AND ingredient <> ''
GROUP BY ingredient ORDER BY count DESC, ingredient LIMIT 30""")
def q_top_ingredients(spark, sf):
    return E.top_ingredients(P.recipes(spark, sf), 30)


_PUNCT_SQL = E.PUNCT_NO_APOSTROPHE.replace("'", "''")


@register("tokens_by_rating", _RV + f""", t AS (
  SELECT CAST(round_even(rating, 0) AS INTEGER) AS rating,
         unnest(regexp_split_to_array(translate(lower(coalesce(review, '')), '{_PUNCT_SQL}', ''), '\\s+')) AS token
  FROM reviews WHERE rating IS NOT NULL),
c AS (SELECT rating, token, count(*) AS count FROM t WHERE token <> '' GROUP BY rating, token)
SELECT rating, token, count FROM (
  SELECT *, row_number() OVER (PARTITION BY rating ORDER BY count DESC, token) AS rn FROM c) WHERE rn <= 20""")
def q_tokens_by_rating(spark, sf):
    return E.tokens_by_rating(P.reviews(spark, sf), 20)


# ---------------------------------------------------------------- E8 --------
@register("rating_vs_length", _RV + """SELECT rating, CAST(length(coalesce(review, '')) AS INTEGER) AS review_len
FROM reviews WHERE rating IS NOT NULL""")
def q_rating_vs_length(spark, sf):
    return E.rating_vs_length(P.reviews(spark, sf))


@register("rating_length_trend", _RV + """SELECT round(regr_slope(rating, length(coalesce(review, ''))), 6) + 0.0 AS slope,
  round(regr_intercept(rating, length(coalesce(review, ''))), 6) + 0.0 AS intercept,
  round(regr_r2(rating, length(coalesce(review, ''))), 6) + 0.0 AS r2, count(*) AS n FROM reviews WHERE rating IS NOT NULL""")
def q_rating_length_trend(spark, sf):
    return rounded(E.rating_length_trend(P.reviews(spark, sf)))


@register("rating_length_trend_by_lang", _RV + """SELECT recipe_id, round(regr_slope(rating, length(coalesce(review, ''))), 6) + 0.0 AS slope,
  round(regr_intercept(rating, length(coalesce(review, ''))), 6) + 0.0 AS intercept,
  round(regr_r2(rating, length(coalesce(review, ''))), 6) + 0.0 AS r2, count(*) AS n FROM reviews WHERE rating IS NOT NULL GROUP BY recipe_id""")
def q_rating_length_trend_by_lang(spark, sf):
    return rounded(E.rating_length_trend(P.reviews(spark, sf), by=["recipe_id"]))


# ---------------------------------------------------------------- E9/E10 ----
@register("count_by_country", _G + """SELECT country, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM geo GROUP BY country""")
def q_count_by_country(spark, sf):
    return rounded(E.count_by_dimension(P.geo(spark, sf), "country"))


@register("count_by_region", _G + """SELECT region, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM geo GROUP BY region""")
def q_count_by_region(spark, sf):
    return rounded(E.count_by_dimension(P.geo(spark, sf), "region"))


@register("dimension_extremes", _G + """, c AS (SELECT country, count(*) AS n FROM geo WHERE country IS NOT NULL AND country <> '' GROUP BY country)
SELECT (SELECT country FROM c ORDER BY n DESC, country LIMIT 1) AS most, (SELECT n FROM c ORDER BY n DESC, country LIMIT 1) AS most_n,
       (SELECT country FROM c ORDER BY n, country LIMIT 1) AS least, (SELECT n FROM c ORDER BY n, country LIMIT 1) AS least_n""")
def q_dimension_extremes(spark, sf):
    return E.dimension_extremes(P.geo(spark, sf), "country")


@register("count_recipes_seasons", _R + """SELECT season, count(*) AS n FROM (SELECT tags[4] AS season FROM recipes)
WHERE season IN ('winter', 'spring', 'summer', 'fall') GROUP BY season""")
def q_count_recipes_seasons(spark, sf):
    r = P.recipes(spark, sf)
    s = r.select(F.when(F.element_at("tags", 4).isin("winter", "spring", "summer", "fall"), F.element_at("tags", 4))
                 .otherwise(F.lit("")).alias("season"))
    return E.count_recipes_seasons(s)


@register("coverage_rate", _G + """, t AS (SELECT tokens[2] AS label, region FROM geo)
SELECT count(*) AS rows, count(*) FILTER (WHERE label IS NOT NULL AND label <> '') AS known,
  count(*) FILTER (WHERE NOT (label IS NOT NULL AND label <> '')) AS unknown,
  count(*) FILTER (WHERE region IS NOT NULL AND region <> '' AND NOT (label IS NOT NULL AND label <> '')) AS parent_only,
  round(count(*) FILTER (WHERE label IS NOT NULL AND label <> '') * 100.0 / count(*), 6) AS known_pct FROM t""")
def q_coverage_rate(spark, sf):
    g = P.geo(spark, sf).select(F.try_element_at("tokens", F.lit(2)).alias("label"), "region")
    return rounded(E.coverage_rate(g, label_col="label", parent_col="region"))


# ---------------------------------------------------------------- E11/E12 ---
@register("diversity", """SELECT c_mktsegment, count(DISTINCT n_name) AS n_n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_mktsegment""")
def q_diversity(spark, sf):
    c = P.table(spark, sf, "customer")
    n = P.table(spark, sf, "nation")
    return E.diversity(c.join(n, c.c_nationkey == n.n_nationkey), "c_mktsegment", "n_name")


@register("diversity_customers_per_region", """SELECT r_name, count(DISTINCT o_custkey) AS n_o_custkey FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name""")
def q_diversity_region(spark, sf):
    o, c = P.table(spark, sf, "orders"), P.table(spark, sf, "customer")
    n, r = P.table(spark, sf, "nation"), P.table(spark, sf, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    return E.diversity(j, "r_name", "o_custkey")


@register("hierarchy_map", """SELECT r_name, array_to_string(list_sort(list(DISTINCT n_name)), ', ') AS n_names
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def q_hierarchy_map(spark, sf):
    n, r = P.table(spark, sf, "nation"), P.table(spark, sf, "region")
    h = E.hierarchy_map(r.join(n, n.n_regionkey == r.r_regionkey), "r_name", "n_name")
    return h.select("r_name", F.array_join("n_names", ", ").alias("n_names"))


# ---------------------------------------------------------------- C1-C4 -----
_RCOLS = "id, name, minutes, n_steps, array_to_string(tags, '|') AS tags"


def _rsel(df):
    return df.select("id", "name", "minutes", "n_steps", F.array_join("tags", "|").alias("tags"))


@register("filter_recipes", _R + f"SELECT {_RCOLS} FROM recipes WHERE minutes BETWEEN 20 AND 120 AND n_steps BETWEEN 5 AND 20")
def q_filter_recipes(spark, sf):
    return _rsel(C.filter_recipes(P.recipes(spark, sf), minutes_range=(20, 120), steps_range=(5, 20)))


@register("filter_interactions", _I + """SELECT * FROM interactions WHERE rating BETWEEN 2 AND 4
  AND length(coalesce(review, '')) BETWEEN 5 AND 8 AND year(date) BETWEEN 1995 AND 1998""")
def q_filter_interactions(spark, sf):
    return C.filter_interactions(P.interactions(spark, sf), rating_range=(2, 4), review_len_range=(5, 8),
                                 year_range=(1995, 1998))


@register("filter_tags_ingredients", _R + f"""SELECT {_RCOLS} FROM recipes
WHERE minutes BETWEEN 5 AND 200 AND (n_steps BETWEEN 2 AND 40 OR n_steps IS NULL)
  AND list_has_any(list_transform(tags, lambda t: lower(trim(t))), ['winter', 'economy'])
  AND NOT list_has_any(list_transform(tags, lambda t: lower(trim(t))), ['brand#2', 'christmas'])
  AND instr(lower(array_to_string(ingredients, ', ')), 're') > 0""")
def q_filter_tags_ingredients(spark, sf):
    return _rsel(C.filter_tags_ingredients(P.recipes(spark, sf), minutes_range=(5, 200), steps_range=(2, 40),
                                           include_tags=["winter", "Economy"], exclude_tags=["brand#2", "christmas"],
                                           ingredients=["re"]))


@register("filter_dimension", _G + "SELECT id, country, region FROM geo WHERE country = 'nation_3'")
def q_filter_dimension(spark, sf):
    return C.filter_dimension(P.geo(spark, sf), country="nation_3", region=None).select("id", "country", "region")


@register("sample_rows", "SELECT doc_id, lang, source FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 100")
def q_sample_rows(spark, sf):
    d = P.table(spark, sf, "documents").select("doc_id", "lang", "source")
    return C.sample_rows(d, 100, seed=7, key_cols=["doc_id"])


@register("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview(spark, sf):
    return C.preview(P.table(spark, sf, "orders"), 20, columns=["o_orderkey", "o_custkey", "o_totalprice"])
