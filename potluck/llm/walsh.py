"""Clustering around centroids in the Walsh-Hadamard domain.

Vectors of a power-of-two length become whole numbers and go once through the
Walsh-Hadamard transform, whose coefficients are whole numbers too, ordered
from coarse to fine (by the number of sign changes).  The transform multiplies
squared distances by the length, so distances of coefficients stand for those
of vectors, and a sum over the first coefficients is a lower bound.

A search adds squared differences of coefficients stage by stage.  After the
first stage the most promising centroid of each vector is finished; a centroid
whose partial sum exceeds that distance is strictly worse and goes.  What
survives is finished over all coefficients; ties go to the smaller number.

Rounds run over the written coefficients.  A task returns per centroid the
count and the sums of its vectors' coefficients; Spark adds them, and the
driver, which holds only k centroids, turns the sums back (the transform is
its own inverse up to the length) and takes the floor of the mean.

Defined cases: vectors that are null, of another length, or hold null,
non-finite or (scaled) components above 2 ** 62 / length take no part; fewer rows
than k make fewer centroids; empty centroids stay; a null id takes part and is
the last choice as a start; equal rows are rows of their own; rows of equal
start order (repeated ids) start in the order of their components; distances
beyond a long are null; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potluck.llm.common import written
from potluck.llm.whole import LIMIT, as_long, decimals, exact, floor_mean, matrix, usable, whole

BLOCK = 8192


def sequency_order(length: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by their number of sign changes."""
    changes = (np.diff(_hadamard(length), axis=1) != 0).sum(axis=1)
    return np.argsort(changes, kind="stable")


def _hadamard(length: int) -> np.ndarray:
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < length:
        h = np.block([[h, h], [h, -h]])
    return h


def transform(x: np.ndarray) -> np.ndarray:
    """Coefficients [rows, length] from coarse to fine, by log2(length) steps
    of sums and differences; exact."""
    n, length = x.shape
    y = x.reshape(n, length)
    step = 1
    while step < length:
        pairs = y.reshape(n, length // (2 * step), 2, step)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, length)
        step *= 2
    return y[:, sequency_order(length)]


def restore(coefficients: list[int]) -> list[int]:
    """The vector of exact coefficients (Python integers)."""
    length = len(coefficients)
    natural = [0] * length
    for place, row in enumerate(sequency_order(length)):
        natural[row] = int(coefficients[place])
    h = _hadamard(length)
    return [sum(v if s > 0 else -v for s, v in zip(row, natural)) // length for row in h]


def stages(length: int) -> list[tuple[int, int]]:
    """Runs of coefficients, coarse to fine: 4, then doubling."""
    cuts = [0, min(4, length)]
    while cuts[-1] < length:
        cuts.append(min(length, cuts[-1] * 2))
    return list(zip(cuts, cuts[1:]))


def nearest(x: np.ndarray, centroids: np.ndarray, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, length * squared distance) of each row of coefficients.

    ``seen`` gets the number of (row, centroid) pairs met in every stage.
    """
    n, k = len(x), len(centroids)
    runs = stages(x.shape[1])

    def part(rows: np.ndarray, who: np.ndarray, lo: int, hi: int) -> np.ndarray:
        gap = x[rows, lo:hi] - centroids[who, lo:hi]
        return (gap * gap).sum(axis=1)

    lo, hi = runs[0]
    first = np.stack([((x[:, lo:hi] - c[lo:hi]) ** 2).sum(axis=1) for c in centroids], axis=1)
    if seen is not None:
        seen.append(first.size)
    guess = first.argmin(axis=1)
    every = np.arange(n)
    bar = first[every, guess] + part(every, guess, hi, x.shape[1])
    rows, who = np.nonzero((first <= bar[:, None]) & (np.arange(k)[None, :] != guess[:, None]))
    total = first[rows, who]
    for lo, hi in runs[1:]:
        if seen is not None:
            seen.append(len(rows))
        total = total + part(rows, who, lo, hi)
        keep = total <= bar[rows]
        rows, who, total = rows[keep], who[keep], total[keep]
    # dropped pairs stand above their bar; argmin takes the smaller number of equals
    far = np.repeat((bar + 1)[:, None], k, axis=1)
    far[rows, who] = total
    far[every, guess] = bar
    cluster = far.argmin(axis=1)
    return cluster, far[every, cluster]


def _blocks(batch: pa.RecordBatch, length: int, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, coefficients, centroids) in one exact type."""
    column = batch.column(batch.schema.get_field_index("w"))
    for at in range(0, batch.num_rows, BLOCK):
        x = matrix(column, np.arange(at, min(at + BLOCK, batch.num_rows)), length)
        both = exact(np.concatenate([x, centroids]), length)
        yield at, both[:len(x)], both[len(x):]


def coefficients(vectors: DataFrame, length: int, scale: float, vec_id: str, embedding: str, order: Column) -> DataFrame:
    """A written table (vec_id, start, w): each kept vector's coefficients."""
    kept = (vectors.where(usable(embedding, scale, LIMIT / length) & (F.size(embedding) == length))
            .select(F.col(vec_id).cast("long").alias("vec_id"), order.alias("start"), whole(embedding, scale).alias("w")))

    def run(batches):
        for batch in batches:
            place = batch.schema.get_field_index("w")
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = exact(matrix(part.column(place), np.arange(part.num_rows), length), length * length)
                flat = transform(x).astype(np.int64).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, length, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["vec_id", "start", "w"])

    return written(kept.mapInArrow(run, kept.schema), "walsh-coefficients")


def _sums(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """centroid -> (count, sums of coefficients): k rows of ``length`` numbers."""
    length = centroids.shape[1]

    def run(batches):
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=object)
        for batch in batches:
            for _, x, c in _blocks(batch, length, centroids):
                cluster, _ = nearest(x, c)
                for k in np.unique(cluster):
                    mine = x[cluster == k]
                    counts[k] += len(mine)
                    sums[k] += mine.sum(axis=0, dtype=object if mine.dtype == object else np.int64).astype(object)
        for k in np.flatnonzero(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(k)] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([int(counts[k])] * length, pa.int64()),
                 decimals(sums[k])], names=["cluster", "place", "n", "total"])

    got = (rows.select("w").mapInArrow(run, "cluster int, place int, n long, total decimal(38,0)")
           .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in got:
        n, sums = out.setdefault(r["cluster"], (r["n"], [0] * length))
        sums[r["place"]] = int(r["total"])
    return out


def cluster(vectors: DataFrame, k: int = 8, length: int = 64, rounds: int = 10, scale: float = 1024.0, salt: str = "3:",
            vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) as a written table, the final centroids).

    Starts: the ``k`` rows with the smallest sha256 of ``salt`` + id; each of
    ``rounds`` assigns all rows and moves the centroids; then all are assigned.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("the length must be a power of two")
    rows = coefficients(vectors, length, scale, vec_id, embedding,
                        F.sha2(F.concat(F.lit(salt), F.col(vec_id).cast("long").cast("string")), 256))
    starts = rows.orderBy(F.asc_nulls_last("start"), "vec_id", "w").limit(k).select("w").collect()
    spectra = [list(r["w"]) for r in starts]
    points = [restore(s) for s in spectra]
    schema = "vec_id long, cluster int, distance long"
    if not points:
        return rows.sparkSession.createDataFrame([], schema), []
    for _ in range(rounds):
        for c, (n, sums) in _sums(rows, np.array(spectra, dtype=np.int64)).items():
            points[c] = [floor_mean(s, n) for s in restore(sums)]
        spectra = transform(np.array(points, dtype=object)).tolist()
    final = np.array(spectra, dtype=np.int64)

    def run(batches):
        for batch in batches:
            for at, x, c in _blocks(batch, length, final):
                who, far = nearest(x, c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(x)), pa.array(who.astype(np.int32)), pa.array(as_long(far // length), pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return written(rows.select("vec_id", "w").mapInArrow(run, schema), "walsh-clusters"), points


def assign(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    found, points = cluster(vectors, **options)
    prints = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    spark = found.sparkSession
    sums = {r["cluster"]: int(r["s"] or 0) for r in  # one row a centroid
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    each = as_long(sums.get(c, 0) for c in range(len(points)))
    facts = spark.createDataFrame([(c, each[c], p) for c, p in enumerate(prints)], "cluster int, cluster_inertia long, centroid_sha256 string")
    whole_sum = F.lit(as_long([sum(sums.values())])[0]).cast("long")
    return (found.join(F.broadcast(facts), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", whole_sum.alias("inertia"), "centroid_sha256"))
