"""Registered quality and distribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import quality as Q
from potluck.operators import stats as S
from potluck.plans import proxies as P
from potluck.plans.registry import register, rounded

# ---------------------------------------------------------------- Q1 --------
_NA_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _docs_labels(spark, sf):
    d = P.table(spark, sf, "documents")
    return d.join(P.table(spark, sf, "labels"), "doc_id", "left").select(*_NA_COLS)


_NA_SQL = ("WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
           "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),\n"
           "c AS (SELECT count(*) AS r, " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _NA_COLS) + " FROM j)\n"
           + "\nUNION ALL\n".join(
               f"SELECT '{c}' AS column_name, {c} AS na_count, round({c} * 100.0 / r, 6) AS na_rate, "
               f"round({c} / CAST(r AS DOUBLE), 6) AS na_frac FROM c" for c in _NA_COLS))


@register("na_counts", _NA_SQL)
def q_na_counts(spark, sf):
    return rounded(Q.na_counts(_docs_labels(spark, sf)))


@register("na_counts_missing_only", "SELECT * FROM (" + _NA_SQL + ") WHERE na_count > 0")
def q_na_counts_missing(spark, sf):
    return rounded(Q.na_counts(_docs_labels(spark, sf), only_missing=True))


# ---------------------------------------------------------------- Q2/Q3 -----
def _dup_input(spark, sf):
    li = P.table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("name"), "l_returnflag", "l_quantity")


@register("duplicates_recipes", """WITH t AS (SELECT l_orderkey AS id, l_linestatus AS name, l_returnflag, l_quantity FROM lineitem),
c AS (SELECT (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT id FROM t)) AS a,
             (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT id, name FROM t)) AS b,
             (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS f)
SELECT 'id' AS kind, a AS n_duplicates FROM c WHERE a > 0
UNION ALL SELECT 'id_name', b FROM c WHERE a > 0 AND b > 0
UNION ALL SELECT 'full', f FROM c WHERE a > 0 AND b > 0""")
def q_duplicates_recipes(spark, sf):
    return Q.duplicates_recipes(_dup_input(spark, sf))


@register("duplicates_interactions", P.with_ctes(P.SQL_INTERACTIONS, """c AS (
  SELECT (SELECT count(*) FROM interactions) - (SELECT count(*) FROM (SELECT DISTINCT user_id, recipe_id, date FROM interactions)) AS a,
         (SELECT count(*) FROM interactions) - (SELECT count(*) FROM (SELECT DISTINCT * FROM interactions)) AS f)""")
          + """SELECT 'user_recipe_date' AS kind, a AS n_duplicates FROM c WHERE a > 0
UNION ALL SELECT 'full', f FROM c WHERE a > 0""")
def q_duplicates_interactions(spark, sf):
    return Q.duplicates_interactions(P.interactions(spark, sf))


@register("duplicates_orders_by_customer_date", """WITH t AS (SELECT o_custkey AS user_id, o_orderstatus AS recipe_id, CAST(year(o_orderdate) AS INTEGER) AS date, o_orderpriority FROM orders),
c AS (SELECT (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT user_id, recipe_id, date FROM t)) AS a,
             (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS f)
SELECT 'user_recipe_date' AS kind, a AS n_duplicates FROM c WHERE a > 0
UNION ALL SELECT 'full', f FROM c WHERE a > 0""")
def q_duplicates_coarse(spark, sf):
    o = P.table(spark, sf, "orders")
    t = o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("recipe_id"),
                 F.year("o_orderdate").alias("date"), "o_orderpriority")
    return Q.duplicates_interactions(t)


# ---------------------------------------------------------------- Q4/Q7 -----
_DESC_COLS = ["o_orderkey", "o_custkey", "o_totalprice"]


@register("describe_numeric", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM orders""" for c in _DESC_COLS))
def q_describe_numeric(spark, sf):
    return rounded(Q.describe_numeric(P.table(spark, sf, "orders"), _DESC_COLS))


@register("minutes_stats", """SELECT count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
  round(min(l_quantity), 6) AS min, """ + ", ".join(
    f"round(quantile_cont(l_quantity, {p}), 6) AS p{int(round(p * 100))}" for p in Q.MINUTES_PROBS)
          + ", round(max(l_quantity), 6) AS max FROM lineitem")
def q_minutes_stats(spark, sf):
    return rounded(Q.minutes_stats(P.table(spark, sf, "lineitem"), "l_quantity"))


@register("minutes_stats_recipes", P.with_ctes(P.SQL_RECIPES) + """SELECT count(minutes) AS count, round(avg(minutes), 6) AS mean,
  round(stddev_samp(minutes), 6) AS std, round(CAST(min(minutes) AS DOUBLE), 6) AS min, """ + ", ".join(
    f"round(quantile_cont(minutes, {p}), 6) AS p{int(round(p * 100))}" for p in Q.MINUTES_PROBS)
          + ", round(CAST(max(minutes) AS DOUBLE), 6) AS max FROM recipes")
def q_minutes_stats_recipes(spark, sf):
    return rounded(Q.minutes_stats(P.recipes(spark, sf), "minutes"))


# ---------------------------------------------------------------- Q5 --------
@register("cardinalities", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS cardinality FROM documents" for c in ["text", "lang", "source"]))
def q_cardinalities(spark, sf):
    return Q.cardinalities(P.table(spark, sf, "documents"))


@register("cardinalities_lists", P.with_ctes(P.SQL_RECIPES) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS cardinality FROM recipes"
    for c in ["name", "ingredients", "tags", "description", "contributor_id"]))
def q_cardinalities_lists(spark, sf):
    return Q.cardinalities(P.recipes(spark, sf))


# ---------------------------------------------------------------- Q6 --------
@register("value_ranges", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM orders"
    for c in ["o_totalprice", "o_orderkey", "o_custkey"]))
def q_value_ranges(spark, sf):
    return Q.value_ranges(P.table(spark, sf, "orders"), ["o_totalprice", "o_orderkey", "o_custkey"])


@register("date_span", """WITH m AS (SELECT min(o_orderdate) AS f, max(o_orderdate) AS t FROM orders),
k AS (SELECT f, t, CAST((year(t) - year(f)) * 12 + (month(t) - month(f))
          - CASE WHEN strftime(t, '%d%H%M%S') < strftime(f, '%d%H%M%S') THEN 1 ELSE 0 END AS INTEGER) AS mo FROM m)
SELECT f AS date_from, t AS date_to, CAST(date_diff('day', CAST(f AS DATE), CAST(t AS DATE)) AS INTEGER) AS days,
  CAST(floor(mo / 12) AS INTEGER) AS years, CAST(mo % 12 AS INTEGER) AS months FROM k""")
def q_date_span(spark, sf):
    return Q.date_span(P.table(spark, sf, "orders"), "o_orderdate")


_TEXT_FEATURES = "review_len review_words review_exclamations review_question_marks".split()
_TEXT_SQL = P.with_ctes(P.SQL_REVIEWS) + r""", f AS (SELECT CAST(length(coalesce(review, '')) AS INTEGER) AS review_len,
  len(list_filter(regexp_split_to_array(coalesce(review, ''), '\s+'), lambda w: w <> '')) AS review_words,
  length(coalesce(review, '')) - length(replace(coalesce(review, ''), '!', '')) AS review_exclamations,
  length(coalesce(review, '')) - length(replace(coalesce(review, ''), '?', '')) AS review_question_marks, rating FROM reviews)"""


def _reviews_features(spark, sf):
    from potluck.operators.cleaning import text_features

    return text_features(P.reviews(spark, sf), "review")


@register("value_ranges_interactions", _TEXT_SQL + """, y AS (SELECT year(date) AS yr FROM (SELECT o_orderdate AS date FROM orders))
SELECT 'rating' AS column_name, min(rating) AS min, max(rating) AS max FROM f
UNION ALL SELECT 'review_len', CAST(min(review_len) AS DOUBLE), CAST(max(review_len) AS DOUBLE) FROM f
UNION ALL SELECT 'year', CAST(min(yr) AS DOUBLE), CAST(max(yr) AS DOUBLE) FROM y""")
def q_value_ranges_interactions(spark, sf):
    years = P.interactions(spark, sf).select(F.year("date").alias("year"))
    return Q.value_ranges(_reviews_features(spark, sf), ["rating", "review_len"]).unionByName(Q.value_ranges(years, ["year"]))


@register("describe_text_features", _TEXT_SQL + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM f""" for c in _TEXT_FEATURES))
def q_describe_text_features(spark, sf):
    return rounded(Q.describe_numeric(_reviews_features(spark, sf), _TEXT_FEATURES))


@register("duplicates_interactions_found", P.with_ctes(P.SQL_INTERACTIONS) + """, t AS (SELECT * FROM interactions UNION ALL SELECT * FROM interactions WHERE user_id % 10 = 0
  UNION ALL SELECT * REPLACE ('again' AS review) FROM interactions WHERE user_id % 15 = 0)
SELECT 'user_recipe_date' AS kind, (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT user_id, recipe_id, date FROM t)) AS n_duplicates
UNION ALL SELECT 'full', (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))""")
def q_duplicates_interactions_found(spark, sf):
    """Interactions of which some occur twice, some again with another review."""
    i = P.interactions(spark, sf)
    t = i.unionByName(i.where("user_id % 10 = 0")).unionByName(i.where("user_id % 15 = 0").withColumn("review", F.lit("again")))
    return Q.duplicates_interactions(t)


# ---------------------------------------------------------------- Q8-Q10 ----
def _hist_sql(src: str, col: str, bins: int) -> str:
    edge = lambda k: f"(CASE WHEN {k} = {bins} THEN hi ELSE {k} * step + lo END)"
    return f"""WITH v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
r0 AS (SELECT min(v) AS mn, max(v) AS mx FROM v HAVING count(*) > 0),
r AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r0),
rs AS (SELECT lo, hi, (hi - lo) / {bins} AS step FROM r),
b0 AS (SELECT v, lo, hi, step, CAST(least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS i0 FROM v, rs),
b1 AS (SELECT v, lo, hi, step, CASE WHEN v < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT CASE WHEN v >= {edge('(i1 + 1)')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM b1),
c AS (SELECT bin, count(*) AS cnt FROM b2 GROUP BY bin),
s AS (SELECT CAST(g.range AS INTEGER) AS bin, lo, hi, step FROM range(0, {bins}) g, rs)
SELECT s.bin, {edge('s.bin')} AS "left", {edge('(s.bin + 1)')} AS "right", CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM s LEFT JOIN c ON s.bin = c.bin"""


@register("histogram", _hist_sql("orders", "o_totalprice", 40))
def q_histogram(spark, sf):
    return S.histogram(P.table(spark, sf, "orders"), "o_totalprice", 40)


@register("histogram_steps", P.with_ctes(P.SQL_RECIPES).replace("WITH ", "WITH ", 1)
          + _hist_sql("recipes", "n_steps", 25).replace("WITH ", ", ", 1))
def q_histogram_steps(spark, sf):
    return S.histogram(P.recipes(spark, sf), "n_steps", 25)


@register("histogram_review_len", P.with_ctes(P.SQL_REVIEWS) + ", rl AS (SELECT CAST(length(coalesce(review, '')) AS INTEGER) AS review_len FROM reviews)"
          + _hist_sql("rl", "review_len", 50).replace("WITH ", ", ", 1))
def q_histogram_review_len(spark, sf):
    return S.histogram(_reviews_features(spark, sf), "review_len", 50)


@register("histogram_user_mean", P.with_ctes(P.SQL_INTERACTIONS) + ", um AS (SELECT user_id, avg(rating) AS mean_rating FROM interactions GROUP BY user_id)"
          + _hist_sql("um", "mean_rating", 25).replace("WITH ", ", ", 1))
def q_histogram_user_mean(spark, sf):
    means = P.interactions(spark, sf).groupBy("user_id").agg(F.avg("rating").alias("mean_rating"))
    return S.histogram(means, "mean_rating", 25)


@register("hist_rating", P.with_ctes(P.SQL_INTERACTIONS) + """, v AS (SELECT rating AS v FROM interactions WHERE rating BETWEEN 0.5 AND 5.5),
c AS (SELECT CAST((v >= 1.5)::INT + (v >= 2.5)::INT + (v >= 3.5)::INT + (v >= 4.5)::INT AS INTEGER) AS bin, count(*) AS cnt FROM v GROUP BY 1),
s AS (SELECT CAST(range AS INTEGER) AS bin, 0.5 + range AS "left", 1.5 + range AS right FROM range(0, 5))
SELECT s.bin, s."left", s."right", CAST(coalesce(c.cnt, 0) AS BIGINT) AS count FROM s LEFT JOIN c ON s.bin = c.bin""")
def q_hist_rating(spark, sf):
    return S.hist_rating(P.interactions(spark, sf))


@register("kde", """WITH v AS (SELECT CAST(p_size AS DOUBLE) AS v FROM part WHERE p_size IS NOT NULL),
st AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, var_samp(v) * pow(count(*), -0.4) AS bw2,
              (max(v) - min(v)) / 199 AS step FROM v HAVING count(*) > 1),
x AS (SELECT CAST(g.range AS INTEGER) AS i, CASE WHEN g.range = 199 THEN hi ELSE g.range * step + lo END AS x, n, bw2
      FROM range(0, 200) g, st)
SELECT i, round(x, 6) AS x, round(sum(exp(-pow(x - v, 2) / (2 * bw2))) / (n * sqrt(2 * pi() * bw2)), 6) AS density
FROM x, v GROUP BY i, x, n, bw2""")
def q_kde(spark, sf):
    return rounded(S.kde(P.table(spark, sf, "part"), "p_size", 200))


# ---------------------------------------------------------------- Q11/Q12 ---
@register("top_counts", """SELECT user_id AS value, count(*) AS count FROM events WHERE user_id IS NOT NULL
GROUP BY user_id ORDER BY count DESC, value LIMIT 15""")
def q_top_counts(spark, sf):
    return S.top_counts(P.table(spark, sf, "events"), "user_id", 15)


@register("distinct_values", P.with_ctes(P.SQL_RECIPES) + """SELECT CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS item_index, value
FROM (SELECT DISTINCT unnest(tags) AS value FROM recipes) WHERE value IS NOT NULL""")
def q_distinct_values(spark, sf):
    return S.distinct_values(P.recipes(spark, sf), "tags").withColumnRenamed("index", "item_index")


# ---------------------------------------------------------------- Q13/Q14 ---
@register("kpis", P.with_ctes(P.SQL_INTERACTIONS) + """SELECT 'rows' AS metric, count(*) AS value FROM interactions
UNION ALL SELECT 'columns', CAST(5 AS BIGINT)
UNION ALL SELECT 'unique_user_id', count(DISTINCT user_id) FROM interactions
UNION ALL SELECT 'unique_recipe_id', count(DISTINCT recipe_id) FROM interactions""")
def q_kpis(spark, sf):
    return Q.kpis(P.interactions(spark, sf), distinct_cols=["user_id", "recipe_id"])


@register("kpis_recipes", P.with_ctes(P.SQL_RECIPES) + """SELECT 'rows' AS metric, count(*) AS value FROM recipes
UNION ALL SELECT 'columns', CAST(11 AS BIGINT)
UNION ALL SELECT 'unique_tags', count(DISTINCT t) FROM (SELECT unnest(tags) AS t FROM recipes)
UNION ALL SELECT 'unique_ingredients', count(DISTINCT t) FROM (SELECT unnest(ingredients) AS t FROM recipes)""")
def q_kpis_recipes(spark, sf):
    return Q.kpis(P.recipes(spark, sf), list_cols=["tags", "ingredients"])


@register("list_length_check", P.with_ctes(P.SQL_RECIPES) + """SELECT count(*) AS rows,
  count(*) FILTER (WHERE n_ingredients <> len(coalesce(ingredients, []))) AS n_mismatch,
  CAST(min(len(coalesce(ingredients, []))) AS INTEGER) AS min_len, CAST(max(len(coalesce(ingredients, []))) AS INTEGER) AS max_len,
  count(*) FILTER (WHERE n_ingredients <> len(coalesce(ingredients, []))) = 0 AS all_match FROM recipes""")
def q_list_length_check(spark, sf):
    return Q.list_length_check(P.recipes(spark, sf))


@register("list_length_distribution", P.with_ctes(P.SQL_RECIPES) + """SELECT CAST(len(coalesce(ingredients, [])) AS INTEGER) AS length,
  count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM recipes GROUP BY 1""")
def q_list_length_distribution(spark, sf):
    return rounded(Q.list_length_distribution(P.recipes(spark, sf)))


# ---------------------------------------------------------------- C5 --------
def _period_sql(m: str) -> str:
    y = f"floor({m} / 525600)"
    r1 = f"({m} % 525600)"
    mo = f"floor({r1} / 43800)"
    r2 = f"({r1} % 43800)"
    d = f"floor({r2} / 1440)"
    r3 = f"({r2} % 1440)"
    h = f"floor({r3} / 60)"
    mi = f"({r3} % 60)"
    part = lambda v, s: f"CASE WHEN {v} <> 0 THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) || '{s}' END"
    head = f"concat_ws(' ', {part(y, 'y')}, {part(mo, 'mo')}, {part(d, 'd')}, {part(h, 'h')})"
    return (f"(CASE WHEN {mi} <> 0 OR {head} = '' THEN concat_ws(' ', nullif({head}, ''), "
            f"CAST(CAST({mi} AS BIGINT) AS VARCHAR) || 'm') ELSE {head} END)")


_BANDS_SQL = """WITH q AS (SELECT CAST(min(l_quantity) AS BIGINT) AS mn, CAST(max(l_quantity) AS BIGINT) AS mx,
  CAST(trunc(quantile_cont(l_quantity, 0.25)) AS BIGINT) AS p25, CAST(trunc(quantile_cont(l_quantity, 0.75)) AS BIGINT) AS p75,
  CAST(trunc(quantile_cont(l_quantity, 0.8)) AS BIGINT) AS p80, CAST(trunc(quantile_cont(l_quantity, 0.9)) AS BIGINT) AS p90,
  CAST(trunc(quantile_cont(l_quantity, 0.95)) AS BIGINT) AS p95 FROM lineitem),
b AS (SELECT 0 AS band_id, 'All' AS band, mn AS lo, mx AS hi FROM q
  UNION ALL SELECT 1, 'Very short', mn, p25 FROM q UNION ALL SELECT 2, 'Short', p25, p75 FROM q
  UNION ALL SELECT 3, 'Medium', p75, p80 FROM q UNION ALL SELECT 4, 'Long', p80, p90 FROM q
  UNION ALL SELECT 5, 'Very long', p90, p95 FROM q UNION ALL SELECT 6, 'Extra long', p95, mx FROM q)"""


@register("duration_bands", _BANDS_SQL + f"""
SELECT CAST(band_id AS INTEGER) AS band_id, band, lo, hi,
  CASE WHEN band_id = 6 THEN '> ' || {_period_sql('lo')} ELSE {_period_sql('lo')} || ' - ' || {_period_sql('hi')} END AS label FROM b""")
def q_duration_bands(spark, sf):
    return S.duration_bands(P.table(spark, sf, "lineitem"), "l_quantity")


@register("assign_duration_band", _BANDS_SQL + """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity,
  (SELECT band FROM b WHERE band_id > 0 AND l.l_quantity BETWEEN lo AND hi ORDER BY band_id LIMIT 1) AS band
FROM lineitem l""")
def q_assign_duration_band(spark, sf):
    li = P.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return S.assign_duration_band(li, "l_quantity")
