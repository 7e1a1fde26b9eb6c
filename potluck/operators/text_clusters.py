"""Text clusters by Lloyd steps in whole numbers.

The TF-IDF rows of ``clustering`` with weights in units of 2 ** -20, so every
sum is exact: neither the partitions of the input nor the engine change a
cluster, which ``clustering.kmeans_text`` (Spark ML, k-means||) cannot promise.

Seeds: the text with the smallest id that has a term, then the text furthest
from all seeds so far (ties: smaller id).  A step assigns every text to its
nearest centre (ties: smaller number) and moves each centre with texts to the
floor of their mean.  Steps end when no centre moves.

The texts' weights lie in one row per id, at most ``max_features`` entries, in a
table in the shared folder.  A step reads it once without a shuffle of its rows:
centres (k x vocabulary, both parameters) go with the task, and only sums per
centre and term, combined in the tasks, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.operators import clustering as CL
from potluck.operators.common import topk_per_group
from potluck.operators.model_store import fitted
from potluck.session import scratch_path

SCALE = 1 << 20   # units of a weight
SLICE_ROWS = 512  # texts multiplied at once


@dataclass(frozen=True)
class TextClusters:
    vocab: DataFrame    # term, idf, t: number of the term, from 0
    centers: DataFrame  # cluster, c: one whole number a term
    stop_words: tuple[str, ...] | None = None


def weight_rows(df: DataFrame, vocab: DataFrame, id_col: str = "id", text_col: str = "text",
                stop_words: Sequence[str] | None = None) -> DataFrame:
    """(id, terms: [(t, w)] by t, n2: their squared length).  Rows of one id are
    one text; texts without a term of ``vocab`` (also null) have no entries."""
    listed = vocab.select("term", "idf", "t").collect()  # at most max_features
    listed.sort(key=lambda r: r["t"])
    own = CL.term_rows(df, [r["term"] for r in listed], [r["idf"] for r in listed], id_col, text_col, stop_words)
    schema = T.StructType([own.schema["id"], T.StructField("terms", T.ArrayType(T.StructType([
        T.StructField("t", T.IntegerType()), T.StructField("w", T.LongType())]))), T.StructField("n2", T.LongType())])

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pc.list_value_length(batch.column("t")).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)
            raw, length = batch.column("raw").flatten().to_numpy(zero_copy_only=False), batch.column("length").to_numpy(zero_copy_only=False)
            w = np.floor(raw / length[row] * SCALE + 0.5).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            upto = np.concatenate([[0], np.cumsum(w * w)])
            terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([batch.column("t").flatten(), pa.array(w)], ["t", "w"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), terms, pa.array(upto[ends[1:]] - upto[ends[:-1]])], names=schema.names)

    return own.mapInArrow(whole, schema)


def _assigned(batches: Iterable[pa.RecordBatch], by_term: np.ndarray):
    """(batch, term, weight, row bounds, cluster, distance) of ``SLICE_ROWS`` rows at a
    time, multiplied in 64-bit integers."""
    length = (by_term * by_term).sum(axis=1)
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            terms = batch.column("terms")
            flat = terms.flatten()
            t, w = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("t", "w"))
            ends = np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False), dtype=np.int64)
            bounds = np.concatenate([[0], ends])
            gap = np.empty((len(by_term), batch.num_rows), dtype=np.int64)
            for k, c in enumerate(by_term):
                upto = np.concatenate([[0], np.cumsum(w * c[t], dtype=np.int64)])
                gap[k] = length[k] - 2 * (upto[bounds[1:]] - upto[bounds[:-1]])
            far = batch.column("n2").to_numpy(zero_copy_only=False) + gap.min(axis=0)
            yield batch, t, w, bounds, gap.argmin(axis=0), far


def _by_term(centers: Sequence[Sequence[int]]) -> np.ndarray:
    return np.ascontiguousarray(np.array(centers, dtype=np.int64))


def nearest(rows: DataFrame, centers: Sequence[Sequence[int]]) -> DataFrame:
    """``rows`` with cluster and distance (squared, units of 2 ** -40)."""
    by_term = _by_term(centers)
    schema = T.StructType([*rows.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, _, best, far in _assigned(batches, by_term):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32()), pa.array(far, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def center_sums(rows: DataFrame, centers: Sequence[Sequence[int]]) -> DataFrame:
    """(cluster, t, s): the weights of the texts nearest to each centre, summed by
    term; t = -1: their number.  A task gives at most one row a centre and term."""
    by_term = _by_term(centers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(by_term.size, dtype=np.int64), np.zeros(len(by_term), dtype=np.int64)
        size = by_term.shape[1]
        for _, t, w, bounds, best, _ in _assigned(batches, by_term):
            place = np.repeat(best, np.diff(bounds)) * size + t
            sums += np.bincount(place, weights=w, minlength=len(sums)).astype(np.int64)  # a slice's sums stay below 2 ** 53
            n += np.bincount(best, minlength=len(n))
        some = np.flatnonzero(sums)
        cluster, t = np.concatenate([np.flatnonzero(n), some // size]), np.concatenate([np.full(np.count_nonzero(n), -1), some % size])
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(t, pa.int32()), pa.array(np.concatenate([n[n > 0], sums[some]]), pa.int64())],
                                         names=["cluster", "t", "s"])

    return rows.mapInArrow(run, "cluster int, t int, s long").groupBy("cluster", "t").agg(F.sum("s").alias("s"))


def _dense(terms, size: int) -> list[int]:
    out = [0] * size
    for x in terms:
        out[x["t"]] = x["w"]
    return out


def _lloyd(df: DataFrame, id_col: str, text_col: str, k: int, max_features: int, max_iter: int,
           stop_words: Sequence[str] | None) -> dict[str, DataFrame]:
    spark = df.sparkSession
    listed = CL.vocabulary(df, text_col, max_features=max_features, stop_words=stop_words) \
        .orderBy(F.desc("total"), "term").collect()  # at most max_features
    if not listed:
        raise ValueError("no terms in the texts")
    vocab = spark.createDataFrame([(r["term"], r["idf"], t) for t, r in enumerate(listed)], "term string, idf double, t int")
    path = scratch_path(spark, "text-weights")
    weight_rows(df, vocab, id_col, text_col, stop_words).write.parquet(path)
    rows = spark.read.parquet(path)
    some = rows.where(F.size("terms") > 0)
    centers = [_dense(some.orderBy("id").first()["terms"], len(listed))]
    while len(centers) < k:
        far = nearest(some, centers).orderBy(F.desc("distance"), "id").first()
        if far["distance"] <= 0:
            break  # fewer distinct texts than k
        centers.append(_dense(far["terms"], len(listed)))
    for _ in range(max_iter):
        sums = center_sums(rows, centers).collect()  # k x (max_features + 1)
        n = {r["cluster"]: r["s"] for r in sums if r["t"] == -1}
        moved = [[0] * len(c) if i in n else c for i, c in enumerate(centers)]
        for r in sums:
            if r["t"] >= 0:
                moved[r["cluster"]][r["t"]] = r["s"] // n[r["cluster"]]
        if moved == centers:
            break
        centers = moved
    return {"vocab": vocab, "centers": spark.createDataFrame(list(enumerate(centers)), "cluster int, c array<bigint>")}


def fit_text_clusters(df: DataFrame, id_col: str = "id", text_col: str = "text", *, k: int = 6, max_features: int = 8000,
                      max_iter: int = 10, stop_words: Sequence[str] | None = None) -> TextClusters:
    """Fitted once for the same texts and parameters, then read from the store.
    A table with fewer distinct texts than ``k`` has fewer clusters; texts
    without any term raise ValueError."""
    stop = None if stop_words is None else tuple(stop_words)
    params = {"form": 1, "k": k, "max_features": max_features, "max_iter": max_iter, "stop_words": stop, "id": id_col, "text": text_col}
    t = fitted(df.select(id_col, text_col), "text-clusters", params,
               lambda: _lloyd(df, id_col, text_col, k, max_features, max_iter, stop))
    return TextClusters(t["vocab"], t["centers"], stop)


def assign_text_clusters(df: DataFrame, model: TextClusters, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, cluster, distance) of each id's text, of the fit or new.  distance:
    squared, in units of the row's length; a text without terms has the centre
    nearest to zero."""
    centers = [r["c"] for r in model.centers.orderBy("cluster").collect()]  # k x vocabulary
    own = nearest(weight_rows(df, model.vocab, id_col, text_col, model.stop_words), centers)
    return own.select(F.col("id").alias(id_col), "cluster", (F.col("distance") / float(SCALE ** 2)).alias("distance"))


def center_terms(model: TextClusters, n: int = 10) -> DataFrame:
    """(cluster, top_terms): the ``n`` heaviest terms of each centre, ties by
    term, joined by commas; a centre at zero has none."""
    long = model.centers.select("cluster", F.posexplode("c").alias("t", "c")).where("c > 0").join(model.vocab, "t")
    top = topk_per_group(long, ["cluster"], [F.desc("c"), F.col("term")], n, ["term"], rank_col="rank")
    joined = top.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("x"))
    return model.centers.select("cluster").join(joined, "cluster", "left").select(
        "cluster", F.coalesce(F.array_join(F.transform("x", lambda x: x["term"]), ", "), F.lit("")).alias("top_terms"))
