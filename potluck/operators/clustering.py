"""Text clustering (G2-G5): TF-IDF + k-means, cluster assignment, top terms
per centroid and a 2-D projection by truncated SVD.

TF-IDF: runs of two or more word characters, lower case, without Spark's
English stop words; the ``max_features`` most frequent terms (ties by term);
idf = ln((1 + n) / (1 + df)) + 1; rows of length 1.  The weights exist as rows
(id, term, weight) for relational work and as vectors for Spark ML.  The
vocabulary, bounded by ``max_features``, is all that reaches the driver.

Fits work on ``FIT_PARTITIONS`` hash partitions ordered by id, so that the
partitioning of the input does not change the clusters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.operators.cleaning import english_stop_words
from potluck.operators.stats import attach_row

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
FIT_PARTITIONS = 32
SLICE_ROWS = 512  # texts counted at once


def words(text: str | Column, stop_words: Sequence[str] | None = None) -> Column:
    """The tokens of a text without stop words (default: Spark's English list)."""
    c = F.col(text) if isinstance(text, str) else text
    stop = sorted({w.lower() for w in (english_stop_words() if stop_words is None else stop_words)})
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({TOKEN_PATTERN})"), 1)
    return F.filter(found, lambda w: ~w.isin(*stop)) if stop else found


def vocabulary(df: DataFrame, text_col: str = "text", *, max_features: int = 8000, stop_words: Sequence[str] | None = None) -> DataFrame:
    """(term, total, idf): the most frequent terms of all rows, at most ``max_features``."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    terms = df.select(words(text_col, stop_words).alias("words")).mapInArrow(_term_totals, "term string, total long, df long")
    freq = terms.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    top = attach_row(freq.orderBy(F.desc("total"), "term").limit(max_features), n)
    return top.select("term", "total", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            yield whole.slice(at, SLICE_ROWS)


def _rows_of(lists: pa.Array) -> np.ndarray:
    """The row of every entry of a list column."""
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def _counted(row: np.ndarray, code: np.ndarray, size: int, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of the distinct (row, code), in their order; codes below ``size``."""
    key, at, n = np.unique(row.astype(np.int64) * size + code, return_inverse=True, return_counts=True)
    if count is not None:
        n = np.bincount(at, weights=count, minlength=len(key)).astype(np.int64)  # whole numbers below 2 ** 53: exact
    return key // size, key % size, n


def _term_totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: words -> (term, occurrences, rows that hold the term), summed in the task
    while its terms are few."""
    total, rows = Counter(), Counter()

    def out() -> Iterator[pa.RecordBatch]:
        terms = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([total[t] for t in terms], pa.int64()),
                                          pa.array([rows[t] for t in terms], pa.int64())], names=["term", "total", "df"])
        total.clear()
        rows.clear()

    for batch in _slices(batches):
        lists = batch.column(0)
        coded = lists.flatten().dictionary_encode()
        terms = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False)
        _, kind, n = _counted(_rows_of(lists), code, max(1, len(terms)))
        total.update(dict(zip(terms, np.bincount(code, minlength=len(terms)).tolist())))
        rows.update(dict(zip(terms, np.bincount(kind, minlength=len(terms)).tolist())))
        if len(total) > 200_000:
            yield from out()
    yield from out()


def term_rows(df: DataFrame, terms: Sequence[str], idf: Sequence[float], id_col: str = "id", text_col: str = "text",
              stop_words: Sequence[str] | None = None) -> DataFrame:
    """(id, t, raw, length): every id's terms, by their numbers in ``terms``, in rising
    order with their counts times idf, and the length of these.  Rows of one id
    are one text; texts without a term have empty lists.

    A row's words are counted in Arrow batches, and only numbers of terms and
    counts, at most ``len(terms)`` a row, are shuffled by id.
    """
    vocab, weight = pa.array(list(terms), pa.string()), np.array(idf, dtype=np.float64)
    size = max(1, len(weight))

    def listed(row: np.ndarray, n: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(1)
            code = pc.fill_null(pc.index_in(lists.flatten(), value_set=vocab), -1).to_numpy(zero_copy_only=False)
            known = code >= 0
            row, t, n = _counted(_rows_of(lists)[known], code[known], size)
            yield pa.RecordBatch.from_arrays([batch.column(0), listed(row, len(lists), t, pa.int32()), listed(row, len(lists), n, pa.int64())],
                                             names=["id", "t", "n"])

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(1)
            row, t, n = _counted(_rows_of(lists), lists.flatten().to_numpy(zero_copy_only=False), size,
                                 batch.column(2).flatten().to_numpy(zero_copy_only=False))
            raw = n * weight[t]
            length = np.sqrt(np.bincount(row, weights=raw * raw, minlength=len(lists)))  # summed in the order of terms
            yield pa.RecordBatch.from_arrays([batch.column(0), listed(row, len(lists), t, pa.int32()), listed(row, len(lists), raw, pa.float64()),
                                              pa.array(length)], names=["id", "t", "raw", "length"])

    def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField("id", df.schema[id_col].dataType), *(T.StructField(*f) for f in fields)])

    ints, longs, doubles = (T.ArrayType(x) for x in (T.IntegerType(), T.LongType(), T.DoubleType()))
    own = (df.select(F.col(id_col).alias("id"), words(text_col, stop_words).alias("words")).mapInArrow(count, schema(("t", ints), ("n", longs)))
           .groupBy("id").agg(F.flatten(F.collect_list("t")).alias("t"), F.flatten(F.collect_list("n")).alias("n")))
    return own.mapInArrow(weigh, schema(("t", ints), ("raw", doubles), ("length", T.DoubleType())))


def tfidf_weights(df: DataFrame, id_col: str = "id", text_col: str = "text", *, max_features: int = 8000,
                  stop_words: Sequence[str] | None = None, vocab: DataFrame | None = None) -> DataFrame:
    """(id, term, weight): the TF-IDF rows, each id's weights of length 1.
    ``vocab``: (term, idf) if it is known already."""
    if vocab is None:
        vocab = vocabulary(df, text_col, max_features=max_features, stop_words=stop_words)
    listed = vocab.select("term", "idf").collect()  # at most max_features
    terms = pa.array([r["term"] for r in listed], pa.string())
    rows = term_rows(df.where(F.col(id_col).isNotNull()), terms.to_pylist(), [r["idf"] for r in listed], id_col, text_col, stop_words)

    def long(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, t, weight in _weights(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), terms.take(pa.array(t)), pa.array(weight)], names=["id", "term", "weight"])

    return rows.mapInArrow(long, T.StructType([rows.schema["id"], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())]))


def _weights(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, row, t, weight) of ``term_rows``: rows of length 1."""
    for batch in _slices(batches):
        row = _rows_of(batch.column(1))
        t, raw = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
        yield batch, row, t, raw / batch.column(3).to_numpy(zero_copy_only=False)[row]


def _model_rows(df: DataFrame, model: PipelineModel, id_col: str, text_col: str) -> DataFrame:
    """``term_rows`` by the vocabulary of a fitted model."""
    return term_rows(df, model.stages[0].vocabulary, model.stages[1].getScalingVec().toArray().tolist(), id_col, text_col)


def fit_tfidf(df: DataFrame, text_col: str = "text", *, max_features: int = 8000, id_col: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """(model, features table with column ``features``).  ``id_col`` fixes the
    order of rows for fits."""
    rows = vocabulary(df, text_col, max_features=max_features).orderBy(F.desc("total"), "term").collect()  # at most max_features
    if not rows:
        raise ValueError("no terms in the texts")
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol="_words", outputCol="_tf")
    model = PipelineModel(stages=[
        counter, ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)])
    feats = _features(df, model, text_col)
    if id_col:  # the vectors are dealt, not the texts
        feats = feats.repartition(FIT_PARTITIONS, F.xxhash64(id_col)).sortWithinPartitions(id_col)
    return model, feats


def _features(df: DataFrame, model: PipelineModel, text_col: str) -> DataFrame:
    return model.transform(df.withColumn("_words", words(text_col))).drop("_words", "_tf", "_tfidf")


def kmeans_text(df: DataFrame, text_col: str = "text", *, k: int = 6, max_features: int = 8000,
                seed: int = 42, id_col: str | None = None):
    """Fit TF-IDF + k-means (k-means||).  Returns (tfidf_model, kmeans_model)."""
    tfidf, feats = fit_tfidf(df, text_col, max_features=max_features, id_col=id_col)
    # k-means makes one pass per iteration: keep its input materialised
    # (memory and disk; lost blocks are recomputed from lineage)
    feats = feats.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        km = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", initMode="k-means||").fit(feats)
    finally:
        feats.unpersist()
    return tfidf, km


def assign_clusters(df: DataFrame, tfidf: PipelineModel, km, text_col: str = "text") -> DataFrame:
    """Cluster id per row (missing text treated as "")."""
    return km.transform(_features(df, tfidf, text_col)).drop("features")


def centroid_rows(tfidf: PipelineModel, km, spark) -> DataFrame:
    """(cluster, term, weight) of the centroids: k x vocabulary, bounded by parameters."""
    vocab = tfidf.stages[0].vocabulary
    rows = [(c, t, float(w)) for c, center in enumerate(km.clusterCenters()) for t, w in zip(vocab, center) if w]
    return spark.createDataFrame(rows, "cluster int, term string, weight double")


def top_terms_per_cluster(tfidf: PipelineModel, km, spark, n: int = 10) -> DataFrame:
    """Comma-joined top-n terms of each centroid (k x vocabulary, both bounded
    by parameters, so the centroids are handled as a small table)."""
    vocab = tfidf.stages[0].vocabulary
    rows = []
    for ci, center in enumerate(km.clusterCenters()):
        order = sorted(range(len(center)), key=lambda j: (-center[j], vocab[j]))[:n]
        rows.append((ci, ", ".join(vocab[j] for j in order)))
    return spark.createDataFrame(rows, "cluster int, top_terms string")


def not_nearest(df: DataFrame, tfidf: PipelineModel, km, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row (n_docs, n_not_nearest): rows whose cluster is not the centroid
    nearest to their TF-IDF rows, found relationally."""
    by_term = np.array([c for c in km.clusterCenters()])
    length = (by_term * by_term).sum(axis=1)

    def gaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, t, weight in _weights(batches):
            gap = np.stack([n - 2 * np.bincount(row, weights=weight * c[t], minlength=batch.num_rows) for n, c in zip(length, by_term)], axis=1)
            ends = pa.array(np.arange(batch.num_rows + 1) * len(by_term), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(gap.ravel()))], names=["id", "d"])

    rows = _model_rows(df, tfidf, id_col, text_col)
    near = rows.mapInArrow(gaps, T.StructType([rows.schema["id"], T.StructField("d", T.ArrayType(T.DoubleType()))]))
    mine = assign_clusters(df, tfidf, km, text_col).select(F.col(id_col).alias("id"), F.col("cluster").alias("own"))
    j = near.join(mine, "id")
    return j.agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.get("d", F.col("own")) > F.array_min("d") + 1e-9).alias("n_not_nearest"))


def singular_vectors(feats: DataFrame, vocab: list[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """((term, v1, v2, ...), singular values) of the feature rows: matrix-vector
    passes over the rows; the driver holds vectors of vocabulary length."""
    from pyspark.mllib.linalg.distributed import IndexedRowMatrix
    from pyspark.mllib.util import MLUtils

    # one pass over the rows per iteration: keep them materialised meanwhile
    kept = feats.select(F.lit(0).cast("long").alias("index"), F.col("features").alias("vector")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        svd = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(kept, "vector")).computeSVD(k, computeU=False)
    finally:
        kept.unpersist()
    v = svd.V.toArray()
    names = [f"v{i + 1}" for i in range(v.shape[1])]
    table = feats.sparkSession.createDataFrame([(t, *map(float, row)) for t, row in zip(vocab, v)],
                                               "term string, " + ", ".join(f"{n} double" for n in names))
    return table, [float(s) for s in svd.s]


def project_2d(df: DataFrame, *, id_col: str = "id", text_col: str = "text", max_features: int = 8000) -> DataFrame:
    """Truncated SVD (no centring) of the TF-IDF rows to 2 components:
    (id, x, y) = rows . V (= U S).  Signs are arbitrary.  The rows are
    projected relationally from (id, term, weight)."""
    tfidf, feats = fit_tfidf(df, text_col, max_features=max_features, id_col=id_col)
    v, _ = singular_vectors(feats, tfidf.stages[0].vocabulary)
    by_term = _by_term(v, tfidf)

    def onto(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, t, weight in _weights(batches):
            xy = [pa.array(np.bincount(row, weights=weight * c[t], minlength=batch.num_rows)) for c in by_term]
            yield pa.RecordBatch.from_arrays([batch.column(0), *xy], names=["id", "x", "y"])

    rows = _model_rows(df.where(F.col(id_col).isNotNull()), tfidf, id_col, text_col)
    xy = rows.mapInArrow(onto, T.StructType([rows.schema["id"], T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
    return (df.select(F.col(id_col).alias("id")).join(xy, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("y", F.lit(0.0)).alias("y")))


def _by_term(v: DataFrame, model: PipelineModel) -> np.ndarray:
    """Both components by the model's numbers of terms: vectors of vocabulary length."""
    of = {r["term"]: (r["v1"], r["v2"]) for r in v.select("term", "v1", "v2").collect()}
    return np.array([of[t] for t in model.stages[0].vocabulary]).T.copy()


def singular_residuals(df: DataFrame, *, id_col: str = "id", text_col: str = "text", max_features: int = 8000) -> DataFrame:
    """(component, residual): |X'X v - s^2 v| / s^2 of both components, from the
    relational rows; zero for true singular vectors."""
    tfidf, feats = fit_tfidf(df, text_col, max_features=max_features, id_col=id_col)
    v, s = singular_vectors(feats, tfidf.stages[0].vocabulary)
    by_term = _by_term(v, tfidf)
    size = by_term.shape[1]

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """X'(X v) of a task's rows, at most one row a term and component."""
        z = np.zeros(by_term.shape)
        for batch, row, t, weight in _weights(batches):
            for k, c in enumerate(by_term):
                y = np.bincount(row, weights=weight * c[t], minlength=batch.num_rows)
                z[k] += np.bincount(t, weights=weight * y[row], minlength=size)
        k, t = np.nonzero(z)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(k + 1, pa.int32()), pa.array(z[k, t])], names=["t", "component", "z"])

    rows = _model_rows(df.where(F.col(id_col).isNotNull()), tfidf, id_col, text_col)
    z = rows.mapInArrow(back, "t int, component int, z double").groupBy("t", "component").agg(F.sum("z").alias("z"))
    long = df.sparkSession.createDataFrame([(t, k + 1, float(x)) for k, c in enumerate(by_term) for t, x in enumerate(c)], "t int, component int, v double")
    s2 = F.when(F.col("component") == 1, F.lit(s[0] ** 2)).otherwise(F.lit(s[1] ** 2))
    gap = long.join(z, ["t", "component"], "left").withColumn("g", F.coalesce("z", F.lit(0.0)) - s2 * F.col("v")).withColumn("s2", s2)
    return gap.groupBy("component").agg((F.sqrt(F.sum(F.col("g") * F.col("g"))) / F.max("s2")).alias("residual"))
