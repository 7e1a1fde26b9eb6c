"""Group signatures by TF-IDF and time-tag extraction.

TF-IDF is computed relationally on long ``(group, term, count)`` rows: no
per-group lists are collected, so a group holding a third of all rows only
costs one partial count per (task, term).  The vocabulary cut keeps the
``max_features`` most frequent terms with a take-ordered (per-task top-k,
bounded by the parameter), and the result per group is a salted top-n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potluck.operators.common import topk_per_group
from potluck.operators.stats import attach_row

# The time-tag patterns ("15-minutes", "4-hours", "1-day-or-more", ...).
TIME_TAG_PATTERNS = [
    r"\b\d+-minutes?\b",
    r"\b\d+-hours?\b",
    r"\b\d+-day(?:s)?-or-more\b",
    r"\b\d+-minutes-or-less\b",
    r"\b\d+-hours-or-less\b",
]
TIME_TAG_REGEX = "|".join(f"(?:{p})" for p in TIME_TAG_PATTERNS)


# ---------------------------------------------------------------- G7 --------
def time_tags(tags: str | Column) -> Column:
    """Tags that look like durations, in their original order."""
    t = F.col(tags) if isinstance(tags, str) else tags
    return F.filter(F.coalesce(t, F.array()), lambda x: x.isNotNull() & x.rlike(TIME_TAG_REGEX))


def extract_time_tags(df: DataFrame, *, id_col: str = "id", tags_col: str = "tags") -> DataFrame:
    """(id, time_tags, time_tags_str)."""
    tt = time_tags(tags_col)
    return df.select(id_col, tt.alias("time_tags"), F.array_join(tt, " ").alias("time_tags_str"))


# ---------------------------------------------------------------- G1 --------
def signature_tfidf(df: DataFrame, group_col: str, items_col: str, *, top_n: int = 10,
                    max_df: float = 0.5, max_features: int | None = 14000) -> DataFrame:
    """Signature terms per group.

    Each group is one document made of all its rows' items.  Terms in more
    than ``max_df`` of the groups are dropped, then the ``max_features`` most
    frequent terms (ties by term; None: all) are kept.  tfidf = count * (ln((1+n)/(1+df)) + 1),
    L2-normalised per group; tf = count / total kept count of the group (L1).
    Output (group, term, tfidf, tf, rank) for the top ``top_n`` terms with
    tfidf > 0 (ties by term).
    """
    items = df.select(F.col(group_col).alias("group"), F.explode(items_col).alias("term")) \
        .where(F.col("group").isNotNull() & F.col("term").isNotNull())
    c = items.groupBy("group", "term").agg(F.count(F.lit(1)).alias("cnt"))
    # every group counts, also one whose lists are all empty
    ng = df.agg(F.countDistinct(group_col).alias("n_groups"))
    dfc = c.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("cnt").alias("total"))
    dfc = attach_row(dfc, ng).where(F.col("df") <= F.lit(max_df) * F.col("n_groups"))
    if max_features is not None:
        dfc = dfc.orderBy(F.desc("total"), "term").limit(max_features)
    w = c.join(dfc.select("term", "df", "n_groups"), "term")
    w = w.withColumn("raw", F.col("cnt") * (F.log((1 + F.col("n_groups")) / (1 + F.col("df"))) + 1))
    norms = w.groupBy("group").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("l2"), F.sum("cnt").alias("l1"))
    s = w.join(norms, "group").select("group", "term", (F.col("raw") / F.col("l2")).alias("tfidf"),
                                      (F.col("cnt") / F.col("l1")).alias("tf"))
    s = s.where(F.col("tfidf") > 0)
    top = topk_per_group(s, ["group"], [F.desc("tfidf"), F.col("term")], top_n, ["term"], rank_col="rank")
    return top.select(F.col("group").alias(group_col), "term", "tfidf", "tf", "rank").orderBy(group_col, "rank")


def signature_views(sig: DataFrame, group_col: str, k: int = 3) -> DataFrame:
    """Top-k terms per group as one comma-joined string (the compact view)."""
    return (sig.where(F.col("rank") <= k).groupBy(group_col)
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ")
                 .alias("top_terms")))
