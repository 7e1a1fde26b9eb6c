"""Per-user / per-item aggregates and dimension counts.

Skew: ``count``/``avg``/``sum`` combine map-side, so a user with a third of
all rows costs one partial row per task.  Per-group ``percentile``/``median``
keep a value->count map per group, so their state is bounded by the number
of distinct values (ratings, lengths), not by the group's row count.  Top-k
per group is salted (see ``common.topk_per_group``).
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potluck.operators.common import topk_per_group
from potluck.operators.stats import attach_row


def _review_len(review_col: str):
    return F.length(F.coalesce(F.col(review_col), F.lit("")))


# ---------------------------------------------------------------- E1/E2 -----
def agg_by_user(df: DataFrame, *, user_col: str = "user_id", rating_col: str = "rating",
                review_col: str = "review") -> DataFrame:
    """Per user (null user kept as a group): n_reviews, mean/median rating,
    95th percentile of review length; most active first."""
    return _agg_reviews(df, user_col, rating_col, review_col)


def agg_by_recipe(df: DataFrame, *, recipe_col: str = "recipe_id", rating_col: str = "rating",
                  review_col: str = "review") -> DataFrame:
    """Per recipe (null recipe dropped), same measures as ``agg_by_user``."""
    return _agg_reviews(df.where(F.col(recipe_col).isNotNull()), recipe_col, rating_col, review_col)


def _agg_reviews(df, key, rating_col, review_col):
    return (df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.avg(rating_col).alias("mean_rating"),
        F.percentile(F.col(rating_col), F.lit(0.5)).alias("median_rating"),
        F.percentile(_review_len(review_col), F.lit(0.95)).alias("p95_len"),
    ).orderBy(F.desc("n_reviews"), key))


# ---------------------------------------------------------------- E3 --------
def user_bias(df: DataFrame, *, user_col: str = "user_id", rating_col: str = "rating") -> DataFrame:
    """Per user (nulls dropped): n, mean and median rating; most active first."""
    return (df.where(F.col(user_col).isNotNull()).groupBy(user_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(rating_col).alias("mean"),
        F.percentile(F.col(rating_col), F.lit(0.5)).alias("median"),
    ).orderBy(F.desc("n"), user_col))


# ---------------------------------------------------------------- E4/E5 -----
def by_year(df: DataFrame, *, date_col: str = "submitted") -> DataFrame:
    """Rows per year (rows without a date dropped)."""
    return (df.where(F.col(date_col).isNotNull()).groupBy(F.year(date_col).alias("year"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("year"))


# Month names in calendar order.
MONTH_NAMES = ["january", "february", "march", "april", "may", "june",
               "july", "august", "september", "october", "november", "december"]


def by_calendar_month(df: DataFrame, *, date_col: str = "submitted") -> DataFrame:
    """Rows per calendar month, January..December, months without rows null."""
    spark = df.sparkSession
    counts = df.where(F.col(date_col).isNotNull()).groupBy(F.month(date_col).alias("month_num")).agg(
        F.count(F.lit(1)).alias("n"))
    spine = spark.createDataFrame([(i + 1, m) for i, m in enumerate(MONTH_NAMES)], "month_num int, month string")
    return spine.join(F.broadcast(counts), "month_num", "left").orderBy("month_num")


# ---------------------------------------------------------------- E6 --------
def top_items(df: DataFrame, col: str = "ingredients", k: int = 30, *, item_name: str = "ingredient") -> DataFrame:
    """Top-k items of a list column: lower-cased, trimmed, non-empty; ties by item."""
    items = df.select(F.explode(col).alias("_x")).select(F.trim(F.lower("_x")).alias(item_name))
    items = items.where(F.col(item_name).isNotNull() & (F.col(item_name) != ""))
    return (items.groupBy(item_name).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), item_name).limit(k))


def top_ingredients(df: DataFrame, k: int = 30, *, col: str = "ingredients") -> DataFrame:
    return top_items(df, col, k, item_name="ingredient")


# ---------------------------------------------------------------- E7 --------
# Fixed value: ASCII punctuation except the apostrophe (removed from tokens).
PUNCT_NO_APOSTROPHE = string.punctuation.replace("'", "")


def review_tokens(df: DataFrame, *, rating_col: str = "rating", review_col: str = "review",
                  stop_words: Sequence[str] | None = None) -> DataFrame:
    """(rating bucket, token) rows: bucket = rating rounded half-to-even."""
    t = F.translate(F.lower(F.coalesce(F.col(review_col), F.lit(""))), PUNCT_NO_APOSTROPHE, "")
    d = df.where(F.col(rating_col).isNotNull()).select(
        F.bround(F.col(rating_col).cast("double"), 0).cast("int").alias("rating"),
        F.explode(F.split(t, r"\s+")).alias("token"))
    d = d.where(F.col("token") != "")
    if stop_words:
        d = d.where(~F.col("token").isin(list(stop_words)))
    return d


def tokens_by_rating(df: DataFrame, k: int = 20, *, rating_col: str = "rating", review_col: str = "review",
                     stop_words: Sequence[str] | None = None) -> DataFrame:
    """Top-k tokens per rounded rating; sorted by rating, then count desc."""
    counts = review_tokens(df, rating_col=rating_col, review_col=review_col, stop_words=stop_words) \
        .groupBy("rating", "token").agg(F.count(F.lit(1)).alias("count"))
    top = topk_per_group(counts, ["rating"], [F.desc("count"), F.col("token")], k, ["token"])
    return top.orderBy("rating", F.desc("count"), "token")


# ---------------------------------------------------------------- E8 --------
def rating_vs_length(df: DataFrame, *, rating_col: str = "rating", review_col: str = "review") -> DataFrame:
    """(rating, review_len) pairs; rows without rating dropped."""
    return df.select(F.col(rating_col).alias("rating"), _review_len(review_col).alias("review_len")) \
        .where(F.col("rating").isNotNull())


def rating_length_trend(df: DataFrame, *, rating_col: str = "rating", review_col: str = "review",
                        by: Sequence[str] = ()) -> DataFrame:
    """OLS line rating ~ review_len (slope, intercept, r2, n), optionally per group."""
    pairs = df.select(*by, F.col(rating_col).cast("double").alias("y"), _review_len(review_col).cast("double").alias("x")) \
        .where(F.col("y").isNotNull())
    aggs = [F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
            F.regr_r2("y", "x").alias("r2"), F.count(F.lit(1)).alias("n")]
    return pairs.groupBy(*by).agg(*aggs) if by else pairs.agg(*aggs)


# ---------------------------------------------------------------- E9 --------
def count_by_dimension(df: DataFrame, col: str, *, drop_empty: bool = False) -> DataFrame:
    """Rows per value (null kept as a group unless ``drop_empty``), share of total."""
    d = df
    if drop_empty:
        d = d.where(F.col(col).isNotNull() & (F.col(col) != ""))
    g = d.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_total"))
    return attach_row(g, total).select(col, "n", (F.col("n") / F.col("_total")).alias("share")).orderBy(F.desc("n"), col)


def dimension_extremes(df: DataFrame, col: str, *, drop_empty: bool = True) -> DataFrame:
    """Most and least frequent value with their counts (ties by value)."""
    g = count_by_dimension(df, col, drop_empty=drop_empty)
    item = F.struct(F.col(col).alias("value"), F.col("n"))
    return g.agg(
        F.min_by(item, F.struct(-F.col("n"), F.col(col))).alias("_m"),
        F.min_by(item, F.struct(F.col("n"), F.col(col))).alias("_l"),
    ).select(F.col("_m.value").alias("most"), F.col("_m.n").alias("most_n"),
             F.col("_l.value").alias("least"), F.col("_l.n").alias("least_n"))


def count_recipes_seasons(df: DataFrame, *, col: str = "season") -> DataFrame:
    """Recipes per season, empty seasons excluded.  Columns: season, n."""
    return (df.where(F.col(col).isNotNull() & (F.col(col) != "")).groupBy(F.col(col).alias("season"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "season"))


# ---------------------------------------------------------------- E10 -------
def coverage_rate(df: DataFrame, *, label_col: str = "country", parent_col: str | None = "region") -> DataFrame:
    """One row: rows with/without a known label, percent known, and rows with a
    known parent but unknown label."""
    known = F.col(label_col).isNotNull() & (F.col(label_col) != "")
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(known).alias("known"), F.count_if(~known | F.col(label_col).isNull()).alias("unknown")]
    if parent_col:
        pk = F.col(parent_col).isNotNull() & (F.col(parent_col) != "")
        aggs.append(F.count_if(pk & ~F.coalesce(known, F.lit(False))).alias("parent_only"))
    out = df.agg(*aggs)
    return out.withColumn("known_pct", F.col("known") * 100.0 / F.nullif(F.col("rows"), F.lit(0)))


# ---------------------------------------------------------------- E11 -------
def diversity(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct ``b`` per ``a`` (nulls ignored), most diverse first.

    Distinct pairs are formed first (map-side de-duplicated), then counted.
    """
    pairs = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    return pairs.groupBy(a).agg(F.count(F.lit(1)).alias(f"n_{b}")).orderBy(F.desc(f"n_{b}"), a)


# ---------------------------------------------------------------- E12 -------
def hierarchy_map(df: DataFrame, parent: str, child: str) -> DataFrame:
    """parent -> sorted distinct children (reference-data sized groups)."""
    pairs = df.select(parent, child).where(F.col(parent).isNotNull() & F.col(child).isNotNull()).distinct()
    return pairs.groupBy(parent).agg(F.sort_array(F.collect_list(child)).alias(f"{child}s")).orderBy(parent)
