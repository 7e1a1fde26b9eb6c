"""Registered time-series queries (T1-T11) on the interaction proxies."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import timeseries as ts
from potluck.plans import proxies as P
from potluck.plans.registry import register, rounded

_I = P.with_ctes(P.SQL_INTERACTIONS)
_IH = P.with_ctes(P.SQL_INTERACTIONS_HOURLY)
_BM = P.with_ctes(P.SQL_INTERACTIONS, """bm AS (
  SELECT CAST(date_trunc('month', date) AS TIMESTAMP) AS month, count(*) AS n, avg(rating) AS mean_rating
  FROM interactions WHERE date IS NOT NULL GROUP BY 1)""")


@register("by_month", _BM + "SELECT month, n, round(mean_rating, 6) AS mean_rating FROM bm")
def q_by_month(spark, sf):
    return rounded(ts.by_month(P.interactions(spark, sf)))


@register("monthly_rolling", _BM + """SELECT month, n, round(mean_rating, 6) AS mean_rating,
  round(avg(n) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS n_roll3,
  round(avg(mean_rating) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mean_rating_roll3
FROM bm""")
def q_monthly_rolling(spark, sf):
    return rounded(ts.monthly_rolling(P.interactions(spark, sf), window=3))


@register("monthly_yoy", _BM + """SELECT month, n, round(mean_rating, 6) AS mean_rating,
  round(n / nullif(CAST(lag(n, 12) OVER (ORDER BY month) AS DOUBLE), 0) - 1, 6) AS n_yoy
FROM bm""")
def q_monthly_yoy(spark, sf):
    return rounded(ts.monthly_yoy(P.interactions(spark, sf)))


@register("monthly_yoy_calendar", _BM + """SELECT b.month, b.n, round(b.mean_rating, 6) AS mean_rating,
  round(b.n / nullif(CAST(p.n AS DOUBLE), 0) - 1, 6) AS n_yoy
FROM bm b LEFT JOIN bm p ON p.month + INTERVAL 12 MONTH = b.month""")
def q_monthly_yoy_calendar(spark, sf):
    return rounded(ts.monthly_yoy(P.interactions(spark, sf), calendar=True))


@register("monthly_anomalies", _BM + """, st AS (SELECT avg(n) AS mu, stddev_pop(n) AS sd FROM bm)
SELECT month, n, round(mean_rating, 6) AS mean_rating,
  round(CASE WHEN sd = 0 OR sd IS NULL THEN 0.0 ELSE (n - mu) / sd END, 6) AS z_n,
  abs(CASE WHEN sd = 0 OR sd IS NULL THEN 0.0 ELSE (n - mu) / sd END) >= 2.5 AS is_anomaly
FROM bm, st""")
def q_monthly_anomalies(spark, sf):
    return rounded(ts.monthly_anomalies(P.interactions(spark, sf), z_thresh=2.5))


@register("seasonal_profile", _BM + """, prof AS (SELECT CAST(month(month) AS INTEGER) AS m, avg(n) AS n_mean FROM bm GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS month, round(prof.n_mean, 6) AS n_mean
FROM range(1, 13) r LEFT JOIN prof ON prof.m = r.range""")
def q_seasonal_profile(spark, sf):
    return rounded(ts.seasonal_profile(P.interactions(spark, sf)))


@register("one_year", _BM + "SELECT month, n, round(mean_rating, 6) AS mean_rating FROM bm WHERE year(month) = 1997")
def q_one_year(spark, sf):
    return rounded(ts.one_year(P.interactions(spark, sf), 1997))


@register("year_range", _I + """SELECT CAST(min(year(date)) AS INTEGER) AS min_year, CAST(max(year(date)) AS INTEGER) AS max_year
FROM interactions WHERE date IS NOT NULL""")
def q_year_range(spark, sf):
    return ts.year_range(P.interactions(spark, sf))


@register("weekday_profile", _I + """SELECT CAST(isodow(date) - 1 AS INTEGER) AS wk, count(*) AS n,
  ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(date)] AS label
FROM interactions WHERE date IS NOT NULL GROUP BY 1, 3""")
def q_weekday_profile(spark, sf):
    return ts.weekday_profile(P.interactions(spark, sf))


@register("weekday_hour_heat", _IH + """SELECT CAST(isodow(date) - 1 AS INTEGER) AS wk, CAST(hour(date) AS INTEGER) AS h, count(*) AS n
FROM interactions_h WHERE date IS NOT NULL GROUP BY 1, 2""")
def q_weekday_hour_heat(spark, sf):
    return ts.weekday_hour_heat(P.interactions_hourly(spark, sf))


_COH = P.with_ctes(P.SQL_INTERACTIONS, """d AS (
  SELECT user_id, CAST(date_trunc('month', date) AS TIMESTAMP) AS month FROM interactions
  WHERE date IS NOT NULL AND user_id IS NOT NULL)""", """f AS (SELECT user_id, min(month) AS cohort FROM d GROUP BY user_id)""",
                   """coh AS (
  SELECT f.cohort, CAST((year(d.month) - year(f.cohort)) * 12 + (month(d.month) - month(f.cohort)) AS INTEGER) AS age,
         count(*) AS n
  FROM d JOIN f ON d.user_id = f.user_id GROUP BY 1, 2)""")


@register("cohorts", _COH + "SELECT cohort, age, n FROM coh")
def q_cohorts(spark, sf):
    return ts.cohorts(P.interactions(spark, sf))


@register("cohort_matrix", _COH + "SELECT cohort, " + ", ".join(
    f"CAST(sum(CASE WHEN age = {a} THEN n ELSE 0 END) AS BIGINT) AS age_{a}" for a in range(13)
) + " FROM coh WHERE age BETWEEN 0 AND 12 GROUP BY cohort")
def q_cohort_matrix(spark, sf):
    return ts.cohort_matrix(P.interactions(spark, sf))


_DECOMP_SQL = P.with_ctes(P.SQL_INTERACTIONS, """bm AS (
  SELECT CAST(date_trunc('month', date) AS TIMESTAMP) AS month, CAST(count(*) AS DOUBLE) AS n
  FROM interactions WHERE date IS NOT NULL GROUP BY 1)""",
    "b AS (SELECT min(month) AS lo, max(month) AS hi, count(*) AS cnt FROM bm)",
    "sp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS TIMESTAMP) AS month FROM b WHERE cnt >= 24)",
    "s AS (SELECT sp.month, bm.n, row_number() OVER (ORDER BY sp.month) - 1 AS t FROM sp LEFT JOIN bm ON sp.month = bm.month)",
    """i AS (SELECT month, t, n,
  last_value(n IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN n IS NOT NULL THEN t END IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
  first_value(n IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN n IS NOT NULL THEN t END IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
  FROM s)""",
    """x AS (SELECT month, t, CASE WHEN n IS NOT NULL THEN n WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END AS x FROM i)""",
    """m AS (SELECT month, t, x, count(*) OVER () AS nn,
  ((lag(x, 5) OVER w + lag(x, 4) OVER w + lag(x, 3) OVER w + lag(x, 2) OVER w + lag(x, 1) OVER w + x + lead(x, 1) OVER w + lead(x, 2) OVER w + lead(x, 3) OVER w + lead(x, 4) OVER w + lead(x, 5) OVER w) + 0.5 * lag(x, 6) OVER w + 0.5 * lead(x, 6) OVER w) / 12 AS ma0 FROM x WINDOW w AS (ORDER BY t))""",
    "ma AS (SELECT month, t, x, nn, CASE WHEN t >= 6 AND t < nn - 6 THEN ma0 END AS ma FROM m)",
    """fit AS (SELECT regr_slope(ma, t) FILTER (WHERE t >= 6 AND t < least(18, nn - 7)) AS fs,
  regr_intercept(ma, t) FILTER (WHERE t >= 6 AND t < least(18, nn - 7)) AS fi,
  regr_slope(ma, t) FILTER (WHERE t >= greatest(6, nn - 19) AND t < nn - 7) AS bs,
  regr_intercept(ma, t) FILTER (WHERE t >= greatest(6, nn - 19) AND t < nn - 7) AS bi FROM ma)""",
    """tr AS (SELECT month, t, x, CASE WHEN ma IS NOT NULL THEN ma WHEN t < 6 THEN fi + fs * t ELSE bi + bs * t END AS trend
  FROM ma, fit)""",
    "ph AS (SELECT t % 12 AS phase, avg(x - trend) AS pm FROM tr GROUP BY 1)",
    "mp AS (SELECT avg(pm) AS mpm FROM ph)",
    "fin AS (SELECT tr.month, tr.x, tr.trend, ph.pm - mp.mpm AS seasonal FROM tr JOIN ph ON tr.t % 12 = ph.phase, mp)",
) + """SELECT month, 'observed' AS part, round(x, 6) + 0.0 AS value FROM fin
UNION ALL SELECT month, 'trend', round(trend, 6) + 0.0 FROM fin
UNION ALL SELECT month, 'seasonal', round(seasonal, 6) + 0.0 FROM fin
UNION ALL SELECT month, 'resid', round(x - trend - seasonal, 6) + 0.0 FROM fin"""


@register("seasonal_decompose", _DECOMP_SQL)
def q_seasonal_decompose(spark, sf):
    return rounded(ts.seasonal_decompose(P.interactions(spark, sf)))


# one decomposition per series: every window and aggregate of the SQL above gets the key
_DECOMP_SERIES_SQL = P.with_ctes(P.SQL_INTERACTIONS, """bm AS (SELECT user_id % 3 AS k, CAST(date_trunc('month', date) AS TIMESTAMP) AS month, CAST(count(*) AS DOUBLE) AS n
  FROM interactions WHERE date IS NOT NULL AND NOT (user_id % 3 = 2 AND year(date) > 1992) GROUP BY 1, 2)""",
    "b AS (SELECT k, min(month) AS lo, max(month) AS hi, count(*) AS cnt FROM bm GROUP BY k)",
    "sp AS (SELECT k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS TIMESTAMP) AS month FROM b WHERE cnt >= 24)",
    "s AS (SELECT sp.k, sp.month, bm.n AS x, row_number() OVER (PARTITION BY sp.k ORDER BY sp.month) - 1 AS t FROM sp JOIN bm ON sp.month = bm.month AND sp.k = bm.k)",
    """m AS (SELECT k, month, t, x, count(*) OVER (PARTITION BY k) AS nn, (sum(x) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
  + 0.5 * lag(x, 6) OVER (PARTITION BY k ORDER BY t) + 0.5 * lead(x, 6) OVER (PARTITION BY k ORDER BY t)) / 12 AS ma0 FROM s)""",
    "ma AS (SELECT * EXCLUDE (ma0), CASE WHEN t >= 6 AND t < nn - 6 THEN ma0 END AS ma FROM m)",
    """fit AS (SELECT k, regr_slope(ma, t) FILTER (WHERE t >= 6 AND t < least(18, nn - 7)) AS fs, regr_intercept(ma, t) FILTER (WHERE t >= 6 AND t < least(18, nn - 7)) AS fi,
  regr_slope(ma, t) FILTER (WHERE t >= greatest(6, nn - 19) AND t < nn - 7) AS bs, regr_intercept(ma, t) FILTER (WHERE t >= greatest(6, nn - 19) AND t < nn - 7) AS bi FROM ma GROUP BY k)""",
    "tr AS (SELECT ma.k, month, t, x, CASE WHEN ma IS NOT NULL THEN ma WHEN t < 6 THEN fi + fs * t ELSE bi + bs * t END AS trend FROM ma JOIN fit ON ma.k = fit.k)",
    "ph AS (SELECT k, t % 12 AS phase, avg(x - trend) AS pm FROM tr GROUP BY 1, 2)",
    "mp AS (SELECT k, avg(pm) AS mpm FROM ph GROUP BY k)",
    "fin AS (SELECT tr.k, tr.month, tr.x, tr.trend, ph.pm - mp.mpm AS seasonal FROM tr JOIN ph ON tr.t % 12 = ph.phase AND tr.k = ph.k JOIN mp ON tr.k = mp.k)",
) + """SELECT k AS series, month, 'observed' AS part, round(x, 6) + 0.0 AS value FROM fin UNION ALL SELECT k, month, 'trend', round(trend, 6) + 0.0 FROM fin
UNION ALL SELECT k, month, 'seasonal', round(seasonal, 6) + 0.0 FROM fin UNION ALL SELECT k, month, 'resid', round(x - trend - seasonal, 6) + 0.0 FROM fin"""


@register("seasonal_decompose_series", _DECOMP_SERIES_SQL)
def q_seasonal_decompose_series(spark, sf):
    """A decomposition per group of users; one group has too few months and drops out."""
    i = P.interactions(spark, sf).withColumn("series", F.col("user_id") % 3)
    return rounded(ts.seasonal_decompose(i.where("not (series = 2 and year(date) > 1992)"), series_col="series"))
