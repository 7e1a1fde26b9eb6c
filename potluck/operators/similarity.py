"""Top-N cosine neighbours without a dense N x N matrix.

* Neighbours of given items (the lookup): token items are reduced to distinct
  vectors first; these, or the numeric vectors, are scanned once, with the asked
  ones and their heaps in the task, so no pair of items becomes a row.
* Neighbours of all items: items are reduced to distinct vectors, each with its
  top_n + 1 smallest ids, so equal items are never compared.  Token vectors
  meet under the terms of their prefix (``neighbors.vectors_by_postings``),
  numeric ones in the cells of a tree that are within their reach
  (``neighbors.vectors_by_pivots``).  The lists are then expanded to ids.

Scores: tokens -> dot(tf_a, tf_b) / sqrt(|a|^2 |b|^2) with integer counts;
numeric -> cosine of standardised vectors (population sigma, 0 -> 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potluck.operators.common import topk_per_group
from potluck.operators.neighbors import scan_numeric, scan_tokens, vectors_by_pivots, vectors_by_postings
from potluck.operators.stats import attach_row
from potluck.session import cut_lineage

def ingredient_tokens(col: str | Column) -> Column:
    """Ingredients -> lower-case word tokens (items joined by spaces, split on " ")."""
    c = F.col(col) if isinstance(col, str) else col
    items = F.filter(F.transform(F.coalesce(c, F.array()), lambda t: F.lower(F.trim(t))), lambda t: t.isNotNull() & (t != ""))
    return F.filter(F.split(F.array_join(items, " "), " "), lambda t: t != "")


def hyphen_tokens(col: str | Column) -> Column:
    """Space-joined text -> tokens of word characters and hyphens (lower case)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"\b[\w-]+\b"), 0)


def _known(query_ids: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    """The asked ids; an id that no item has raises when the plan runs."""
    asked = query_ids.select(F.col(query_ids.columns[0]).cast("long").alias("_q")).distinct()
    there = items.select(F.col(id_col).cast("long").alias("_there")).distinct()
    j = asked.join(there, F.col("_q") == F.col("_there"), "left")
    missing = F.raise_error(F.concat(F.lit("item id not found: "), F.col("_q").cast("string"))).cast("boolean")
    return j.where(F.when(F.col("_there").isNull(), missing).otherwise(F.lit(True))).select("_q")


# ---------------------------------------------------------------- G6 --------
def _term_counts(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    return (df.select(F.col(id_col).cast("long").alias("id"), F.explode(tokens_col).alias("term"))
            .where(F.col("term").isNotNull() & (F.col("term") != ""))
            .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")))


def _ranked(part: DataFrame, top_n: int) -> DataFrame:
    top = topk_per_group(part, ["id"], [F.desc("score"), F.col("neighbor_id")], top_n, ["neighbor_id"], rank_col="rank")
    return top.select("id", "neighbor_id", "score", "rank")


def cosine_topk_tokens(df: DataFrame, *, id_col: str = "id", tokens_col: str = "tokens", top_n: int = 25,
                       query_ids: DataFrame | None = None, block_rows: int = 2048) -> DataFrame:
    """Top-N other items by bag-of-token cosine (pairs with score > 0 only),
    of the items in ``query_ids`` (an unknown id raises) or of all.

    Columns: id, neighbor_id, score, rank.
    """
    tf = _term_counts(df, id_col, tokens_col)
    # distinct vectors: one hash of the sorted (term, count) list stands for a vector
    docs = tf.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms"))
    if query_ids is not None:
        docs = docs.where("id is not null")
    docs = cut_lineage(docs.select("id", F.concat(F.xxhash64("terms").cast("string"), F.lit("/"), F.xxhash64(F.lit(1), "terms").cast("string")).alias("vec"), "terms"))
    vectors = docs.groupBy("vec").agg(F.min("id").alias("low"), F.min_by("terms", "id").alias("terms"))
    vectors = cut_lineage(vectors.withColumn("n2", F.aggregate("terms", F.lit(0).cast("long"), lambda a, x: a + x["tf"] * x["tf"])))
    docs = docs.select("vec", "id")
    if query_ids is None:
        near, _ = vectors_by_postings(vectors, top_n + 1, block_rows)
        return _expanded(near, docs, vectors.select("vec", "low"), top_n)
    asked = cut_lineage(_known(query_ids, df, id_col).join(docs, F.col("_q") == F.col("id")).select("vec", "id"))
    near = scan_tokens(vectors, vectors.join(asked.select("vec").distinct(), "vec", "left_semi"), top_n + 1)
    return _expanded(near, docs, vectors.select("vec", "low"), top_n, asked)


def _expanded(near: DataFrame, docs: DataFrame, vectors: DataFrame, top_n: int, asked: DataFrame | None = None) -> DataFrame:
    """Neighbours of vectors -> of ids: the ``top_n`` + 1 best (score, id) of each
    vector, then of each of its ids (of those in ``asked``, if given) without
    itself.  ``docs``, ``asked``: (vec, id), ``vectors``: (vec, low)."""
    best = _ranked(near, top_n + 1).select(F.col("id").alias("low"), F.col("neighbor_id").alias("near"), "score")
    ids = topk_per_group(docs, ["vec"], [F.col("id")], top_n + 1, ["id"])
    lows = vectors.select(F.col("vec").alias("vec2"), F.col("low").alias("near"))
    held = best.join(lows, "near").join(ids.select(F.col("vec").alias("vec2"), F.col("id").alias("neighbor_id")), "vec2")
    best = topk_per_group(held.select("low", "neighbor_id", "score"), ["low"], [F.desc("score"), F.col("neighbor_id")], top_n + 1, ["neighbor_id"])
    owner = vectors.join(docs if asked is None else asked, "vec").select("low", "id")
    return _ranked(owner.join(best, "low").where("id <> neighbor_id").select("id", "neighbor_id", "score"), top_n)


# ---------------------------------------------------------------- G8 --------
def standardize(df: DataFrame, cols: Sequence[str], *, id_col: str = "id") -> DataFrame:
    """Rows with at least one value; nulls -> 0; z = (x - mean) / sigma_pop
    (sigma 0 -> 1); statistics from one aggregate attached by broadcast."""
    keep = df.where(F.greatest(*[F.col(c).isNotNull() for c in cols]))
    filled = keep.select(F.col(id_col).cast("long").alias("id"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    st = filled.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = attach_row(filled, st)
    z = [((F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))).alias(c) for c in cols]
    return j.select("id", *z)


def cosine_topk_numeric(df: DataFrame, cols: Sequence[str], *, id_col: str = "id", top_n: int = 10,
                        query_ids: DataFrame | None = None, block_rows: int = 4096) -> DataFrame:
    """Top-N other items by cosine of standardised numeric columns, of the
    items in ``query_ids`` (an unknown id raises; the asked vectors are
    collected in chunks of a checked size) or of all.
    Columns: id, neighbor_id, score, rank."""
    z = standardize(df, cols, id_col=id_col)
    # adding 0.0 makes one zero of both
    vec = z.select("id", F.array(*[F.col(c) + F.lit(0.0) for c in cols]).alias("v"))
    if query_ids is not None:
        asked = _known(query_ids, df, id_col).join(vec, F.col("_q") == F.col("id")).select("id", "v")
        return _ranked(scan_numeric(vec, asked, top_n), top_n)
    docs = cut_lineage(vec.where("id is not null").select("id", F.col("v").alias("vec")))
    vectors = cut_lineage(docs.groupBy("vec").agg(F.min("id").alias("low")))
    near, _ = vectors_by_pivots(vectors.select("low", F.col("vec").alias("v")), top_n + 1, block_rows)
    return _expanded(near, docs, vectors, top_n)
