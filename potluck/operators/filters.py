"""Row selection.

Filters are plain predicates, so Catalyst pushes the comparisons on scalar
columns into the Parquet scan (row-group skipping) and prunes columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _between(c: str, rng):
    lo, hi = rng
    return F.col(c).between(F.lit(lo), F.lit(hi))


# ---------------------------------------------------------------- C1 --------
def filter_recipes(df: DataFrame, *, minutes_range=None, steps_range=None,
                   minutes_col: str = "minutes", steps_col: str = "n_steps") -> DataFrame:
    """Inclusive ranges on minutes and steps, each optional; columns unchanged."""
    out = df
    if minutes_range and minutes_col in df.columns:
        out = out.where(_between(minutes_col, minutes_range))
    if steps_range and steps_col in df.columns:
        out = out.where(_between(steps_col, steps_range))
    return out


# ---------------------------------------------------------------- C2 --------
def filter_interactions(df: DataFrame, *, rating_range=None, review_len_range=None, year_range=None,
                        rating_col: str = "rating", review_col: str = "review", date_col: str = "date") -> DataFrame:
    """Inclusive ranges on rating, review length and year; columns unchanged."""
    out = df
    if rating_range and rating_col in df.columns:
        out = out.where(_between(rating_col, rating_range))
    if review_len_range and review_col in df.columns:
        ln = F.length(F.coalesce(F.col(review_col), F.lit("")))
        out = out.where(ln.between(F.lit(review_len_range[0]), F.lit(review_len_range[1])))
    if year_range and date_col in df.columns:
        out = out.where(F.year(date_col).between(F.lit(year_range[0]), F.lit(year_range[1])))
    return out


# ---------------------------------------------------------------- C3 --------
def filter_tags_ingredients(df: DataFrame, *, minutes_range=None, steps_range=None,
                            include_tags: Sequence[str] = (), exclude_tags: Sequence[str] = (),
                            ingredients: Sequence[str] = (), minutes_col: str = "minutes",
                            steps_col: str = "n_steps", tags_col: str = "tags",
                            ingredients_col: str = "ingredients") -> DataFrame:
    """minutes in range; steps in range or null; any include tag; no exclude
    tag; every wanted ingredient is a (case-insensitive) substring of the
    ingredient list printed as "a, b, c"."""
    out = df
    if minutes_range:
        out = out.where(_between(minutes_col, minutes_range))
    if steps_range:
        out = out.where(_between(steps_col, steps_range) | F.col(steps_col).isNull())
    tags = F.transform(F.coalesce(F.col(tags_col), F.array()), lambda t: F.lower(F.trim(t)))
    if include_tags:
        out = out.where(F.arrays_overlap(tags, F.array(*[F.lit(t.strip().lower()) for t in include_tags])))
    if exclude_tags:
        out = out.where(~F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t.strip().lower()) for t in exclude_tags])), F.lit(False)))
    if ingredients:
        text = F.lower(F.array_join(F.coalesce(F.col(ingredients_col), F.array()), ", "))
        for ing in ingredients:
            out = out.where(F.instr(text, ing.strip().lower()) > 0)
    return out


# ---------------------------------------------------------------- C4 --------
def filter_dimension(df: DataFrame, **equals) -> DataFrame:
    """Optional equality filters, e.g. ``country="france", season=None``."""
    out = df
    for c, v in equals.items():
        if v is not None and v != "":
            out = out.where(F.col(c) == F.lit(v))
    return out


# ---------------------------------------------------------------- C6 --------
def sample_rows(df: DataFrame, n: int, *, seed: int = 42, key_cols: Sequence[str] | None = None) -> DataFrame:
    """n rows without replacement, reproducible for any partitioning: rows are
    ranked by the md5 of seed and key (all columns by default); all rows if
    n >= count.  (A sampling operator: the limit is the feature.)"""
    keys = list(key_cols or df.columns)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


# ---------------------------------------------------------------- C7 --------
def preview(df: DataFrame, n: int = 20, *, columns: Sequence[str] | None = None,
            order_by: Sequence[str] | None = None) -> DataFrame:
    """First n rows of the chosen columns in a given order (Spark has no row order)."""
    cols = list(columns or df.columns)
    order = list(order_by or cols[:1])
    return df.select(*cols).orderBy(*order).limit(n)
