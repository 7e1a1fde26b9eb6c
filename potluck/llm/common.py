"""Helpers shared by the operators: lineage cuts, per-batch columns, numbering."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from potluck.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    A lost executor never forces work before this point to run again, and
    what reads the result several times reads the same rows each time.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/potluck-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have yet (it may hold clashing ones)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_python(df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable[..., Sequence]],
                fields: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """``df`` with the columns ``fields`` that Python computes per Arrow batch.

    ``make()`` runs once per task and returns ``fn(*columns) -> arrays`` where
    the columns are the lists of ``inputs`` and one array per field comes back.
    Every other column passes through untouched and needs no join; a column
    that has the name of a computed one gives way to it.
    """
    names = list(inputs)
    new = {n.lower() for n, _ in fields}
    if new & {n.lower() for n in names}:
        raise ValueError("a computed column cannot have the name of an input")
    df = df.drop(*[c for c in df.columns if c.lower() in new])
    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, t, True) for n, t in fields])
    kinds = [_arrow(t) for _, t in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            got = fn(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            arrays += [pa.array(x, type=k) for x, k in zip(got, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
              T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return simple[type(kind)]


def numbered(df: DataFrame, group: str, row_id: str, name: str, buckets: int = 128) -> DataFrame:
    """Number the rows of each ``group`` from 0 without a gap.

    ``df`` must be a written table with a unique ``row_id``.  No task gets a
    whole group: rows are dealt by (group, hash of the row id modulo
    ``buckets``), numbered there, and shifted by the counts of the buckets
    before.  The count table has at most groups x ``buckets`` rows; callers
    have a number of groups that a parameter bounds, so it may be broadcast.
    """
    bucket, before = fresh(df, "bucket", "before")
    df = df.withColumn(bucket, F.pmod(F.xxhash64(row_id), F.lit(buckets)))
    counts = df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias(before))
    upto = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col(bucket).alias("_b"),
                           F.coalesce(F.sum(before).over(upto), F.lit(0)).alias("_s"))
    own = Window.partitionBy(group, bucket).orderBy(row_id)
    ranked = df.withColumn(before, F.row_number().over(own) - F.lit(1))
    return (ranked.join(F.broadcast(starts), (F.col(group) == F.col("_g")) & (F.col(bucket) == F.col("_b")))
            .withColumn(name, (F.col(before) + F.col("_s")).cast("long"))
            .drop("_g", "_b", "_s", before, bucket))


def hash_share(key: Column, share: float, seed: int = 0) -> Column:
    """True for a fixed pseudo-random share of the keys (nulls: never)."""
    return key.isNotNull() & (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0,
                 steps: int = 200) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by accelerated gradient descent.

    Runs on a bounded sample on the driver.  Returns (coefficients, intercept).
    """
    n, d = x.shape
    w, b = np.zeros(d), 0.0
    sw = np.ones(n) if weight is None else weight
    total = sw.sum()
    lip = 0.25 * float((sw[:, None] * x * x).sum() + total) / total + l2 / total
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        r = (p - y) * sw
        nw = vw - (x.T @ r / total + l2 / total * vw) / lip
        nb = vb - r.sum() / total / lip
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, label: str, columns: dict[str, str],
                    max_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(key, y, *columns) of a pseudo-random sample: at most about ``max_rows``
    of each class, and the number of labels of each class.

    Rows with crc32(doc_id) mod 5 = 0 are held out; a document with several
    labels has the greatest.  ``columns`` maps new names to those of ``docs``.
    The sampled labels number at most about 2 x ``max_rows`` and are broadcast.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("key")).agg(F.max(F.col(label).cast("int")).alias("y"))
             .where(F.crc32(F.col("key").cast("string")) % 5 != 0))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [min(1.0, max_rows / max(1, n.get(y, 0))) for y in (0, 1)]
    picked = known.where(F.when(F.col("y") == 1, hash_share(F.col("key"), share[1], 3)).otherwise(hash_share(F.col("key"), share[0], 3)))
    rows = docs.select(F.col(doc_id).alias("key"), *[F.col(old).alias(new) for new, old in columns.items()])
    return rows.join(F.broadcast(picked), "key"), {0: n.get(0, 0), 1: n.get(1, 0)}
