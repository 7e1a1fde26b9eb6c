"""Compression of vectors to codes, over per-dimension value dictionaries.

Vectors become whole numbers and are cut into parts; a codebook per part
position holds its entries, and a part's code is its nearest entry.

Rows are written once as blocks: for each dimension the sorted distinct
values of the block (its dictionary) and each row's place in it, a byte or
two.  A search tabulates, per dimension, the squared differences of every
distinct value to all entries, once a block; the distances of a part are then
gathers from these tables by code, added over the part's dimensions.  The
sums that move the entries are counts per (entry, dictionary place) times the
dictionary.  All arithmetic is exact.

A task returns sums per entry and dimension, Spark adds them, the driver holds
the codebooks only.  Sums over equal labels are joined back as a broadcast
for labels with over a thousandth of all rows (fewer than a thousand such) and
by a shuffle for the others, so that no task takes a hot label's rows.

Defined cases: vectors that are null or hold null, non-finite or (scaled) more
than a long's components take no part.  Vectors of different lengths have
codebooks of their own (one run, one print a length); a length that does not
divide into equal parts is cut as evenly as possible, and a part without
components always has code 0.  Fewer rows than entries make fewer entries; a
null id is the last choice as an entry; rows of equal id start in the order of
their components; repeated rows are rows of their own; errors beyond a long
are null and add nothing; null labels are equal; other columns are not read;
no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from potluck.llm.common import written
from potluck.llm.whole import as_long, decimals, exact, floor_mean, matrix, usable, whole

BLOCK = 4096


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    """The dimensions of each part."""
    return [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]


class Block:
    """Up to ``BLOCK`` vectors of one length as dictionary codes."""

    def __init__(self, values: list[np.ndarray], codes: np.ndarray):
        self.values, self.codes = values, codes  # a sorted array a dimension; [dimension, row]

    @classmethod
    def of(cls, x: np.ndarray) -> "Block":
        values, codes = [], np.empty(x.shape[::-1], dtype=np.uint16)
        for j in range(x.shape[1]):
            v, codes[j] = np.unique(x[:, j], return_inverse=True)
            values.append(v)
        return cls(values, codes)

    def distances(self, book: list[list[list[int]]], part: int, span: tuple[int, int], rows: int) -> np.ndarray:
        """[rows, entries]: squared distances of a part to all its entries."""
        entries = np.array(book[part], dtype=np.int64).reshape(len(book[part]), span[1] - span[0])
        total = np.zeros((rows, len(entries)), dtype=np.int32)
        for j in range(*span):
            both = exact(np.concatenate([self.values[j], entries[:, j - span[0]]]), span[1] - span[0])
            known, wanted = both[:len(self.values[j])], both[len(self.values[j]):]
            table = (known[:, None] - wanted[None, :]) ** 2
            got = table[self.codes[j]]
            # parts keep the widest type any of their dimensions needs
            total = total + got if got.dtype != total.dtype else np.add(total, got, out=total)
        return total

    def nearest(self, book: list[list[list[int]]], spans: list[tuple[int, int]], rows: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry [part, row], error [row]): the nearest entries, ties to the lower."""
        who = np.zeros((len(spans), rows), dtype=np.int64)
        error = np.zeros(rows, dtype=np.int64)
        for p, span in enumerate(spans):
            d = self.distances(book, p, span, rows)
            who[p] = d.argmin(axis=1)
            least = d[np.arange(rows), who[p]]
            # four parts at a time could pass a long only where a part is near it
            if least.dtype == np.int64 and len(least) and int(least.max()) > (1 << 62) // max(1, len(spans)):
                least = least.astype(object)
            error = error + least
        return who, error

    def sums(self, j: int, who: np.ndarray, entries: int) -> list[int]:
        """Sum of dimension ``j`` over the rows of each entry, exactly."""
        v = self.values[j]
        times = np.bincount(who * len(v) + self.codes[j], minlength=entries * len(v)).reshape(entries, len(v))
        safe = not len(v) or max(abs(int(v[0])), abs(int(v[-1]))) < 1 << 49
        return (times @ (v if safe else v.astype(object))).tolist()


def blocks(vectors: DataFrame, scale: float, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The kept rows as a written table of dictionary blocks (dim, vec_id,
    label, sizes, values, codes), and as plain rows (vec_id, label, v)."""
    kind = vectors.schema[label].dataType
    rows = vectors.where(usable(embedding, scale)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), whole(embedding, scale).alias("v"))
    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("vec_id", T.ArrayType(T.LongType())),
                           T.StructField("label", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.IntegerType())),
                           T.StructField("values", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType())])

    def run(batches):
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(lengths):
                mine = np.flatnonzero(lengths == dim)
                for at in range(0, len(mine), BLOCK):
                    take = mine[at:at + BLOCK]
                    block = Block.of(matrix(batch.column(2), take, int(dim)))
                    some = pa.array(take)
                    narrow = all(len(v) <= 256 for v in block.values)
                    values = np.concatenate([np.empty(0, dtype=np.int64), *block.values])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(dim)], pa.int32()), _list(batch.column(0).take(some)), _list(batch.column(1).take(some)),
                         _list(pa.array([len(v) for v in block.values], pa.int32())), _list(pa.array(values)),
                         pa.array([block.codes.astype(np.uint8 if narrow else np.uint16).tobytes()], pa.binary())], names=schema.names)

    return written(rows.mapInArrow(run, schema), "dictionary-blocks"), rows


def _list(values: pa.Array) -> pa.ListArray:
    """One list that holds all of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Block, dict]]:
    """(dim, rows, block, its columns) of each written block."""
    for i in range(batch.num_rows):
        r = {n: batch.column(n)[i] for n in batch.schema.names}
        dim, raw = r["dim"].as_py(), r["codes"].as_py()
        rows = len(r["vec_id"].values)
        codes = np.frombuffer(raw, dtype=np.uint8 if len(raw) == dim * rows else np.uint16)
        ends = np.cumsum(r["sizes"].values.to_numpy())
        values = np.split(r["values"].values.to_numpy(zero_copy_only=False).astype(np.int64), ends[:-1]) if dim else []
        yield dim, rows, Block(values, codes.reshape(dim, rows)), r


def _starts(rows: DataFrame, entries: int, parts: int) -> dict[int, list[list[list[int]]]]:
    """dim -> codebooks [part][entry]: the parts of the smallest ids."""
    own = Window.partitionBy("dim").orderBy(F.asc_nulls_last("vec_id"), "v")
    few = (rows.select(F.size("v").alias("dim"), "vec_id", "v").withColumn("r", F.row_number().over(own))
           .where(F.col("r") <= entries))  # a group limit, first in every task
    books: dict[int, list[list[list[int]]]] = {}
    for r in few.orderBy("dim", "r").collect():
        book = books.setdefault(r["dim"], [[] for _ in range(parts)])
        for p, (lo, hi) in enumerate(cuts(r["dim"], parts)):
            book[p].append(list(r["v"][lo:hi]))
    return books


def _move(held: DataFrame, books: dict[int, list[list[list[int]]]], parts: int) -> None:
    """Every entry with parts becomes the floor of their mean."""
    def run(batches):
        counts: dict[tuple[int, int], np.ndarray] = {}
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, rows, block, _ in _read(batch):
                spans = cuts(dim, parts)
                who, _ = block.nearest(books[dim], spans, rows)
                for p, span in enumerate(spans):
                    k = len(books[dim][p])
                    counts[dim, p] = counts.get((dim, p), 0) + np.bincount(who[p], minlength=k)
                    for j in range(*span):
                        sums[dim, j] = sums.get((dim, j), 0) + np.array(block.sums(j, who[p], k), dtype=object)
        for (dim, p), n in counts.items():
            for place, j in enumerate(range(*cuts(dim, parts)[p])):
                used = np.flatnonzero(n)
                fixed = [pa.array([v] * len(used), pa.int32()) for v in (dim, p)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array(used.astype(np.int32)), pa.array([place] * len(used), pa.int32()), pa.array(n[used]), decimals(sums[dim, j][used])],
                    names=["dim", "part", "entry", "place", "n", "total"])

    moved = (held.select("dim", "vec_id", "sizes", "values", "codes")
             .mapInArrow(run, "dim int, part int, entry int, place int, n long, total decimal(38,0)")
             .groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    for r in moved:  # entries x dimensions numbers
        books[r["dim"]][r["part"]][r["entry"]][r["place"]] = floor_mean(r["total"], r["n"])


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
             vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, dict[int, list[list[list[int]]]]]:
    """((dim, vec_id, label, code, error) as a written table, the codebooks of
    each length: [part][entry] -> components)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    held, rows = blocks(vectors, scale, vec_id, embedding, label)
    books = _starts(rows, entries, parts)
    for _ in range(rounds):
        _move(held, books, parts)
    kind = vectors.schema[label].dataType
    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("label", kind),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        for batch in batches:
            for dim, n, block, r in _read(batch):
                who, error = block.nearest(books[dim], cuts(dim, parts), n)
                codes = [row.tobytes().hex() for row in np.ascontiguousarray(who.T.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * n, pa.int32()), r["vec_id"].values, r["label"].values, pa.array(codes, pa.string()),
                     pa.array(as_long(error), pa.int64())], names=schema.names)

    return written(held.mapInArrow(run, schema), "dictionary-codes"), books


def sum_by_label(rows: DataFrame, value: str, out: str, label: str = "label", salts: int = 64) -> DataFrame:
    """``rows`` with ``out``, the sum of ``value`` over the rows of equal label
    (nulls together).  ``rows`` is read twice: give a written table."""
    sums = rows.groupBy(F.col(label).alias("_l")).agg(
        F.sum(F.col(value).cast("decimal(38,0)")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    sums = written(sums.select("_l", F.expr("try_cast(coalesce(_s, 0) as long)").alias("_s"), "_n"), "label-sums")
    n = rows.count()
    hot = sums.where(F.col("_n") * 1000 > n).select("_l", F.col("_s").alias("_hot"))  # fewer than a thousand rows
    cold = sums.where(F.col("_n") * 1000 <= n).select(F.col("_l").alias("_c"), F.col("_s").alias("_cold"), F.lit(0).alias("_salt"))
    marked = hot.select("_l", "_hot", F.lit(True).alias("_is_hot"))
    one = rows.join(F.broadcast(marked), F.col(label).eqNullSafe(F.col("_l")), "left")
    # rows of a hot label need no partner: they are spread by their own content
    one = one.withColumn("_k", F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(salts)) + 1).otherwise(F.lit(0)))
    both = one.join(cold, F.col(label).eqNullSafe(F.col("_c")) & (F.col("_k") == F.col("_salt")), "left")
    return both.select(*rows.columns, F.when(F.col("_is_hot"), F.col("_hot")).otherwise(F.col("_cold")).alias(out))


def codes(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    found, books = compress(vectors, **options)
    prints = {dim: hashlib.sha256(",".join(str(c) for part in book for entry in part for c in entry).encode()).hexdigest()
              for dim, book in books.items()}
    which = F.lit(None).cast("string")
    for dim, digest in prints.items():
        which = F.when(F.col("dim") == dim, F.lit(digest)).otherwise(which)
    return sum_by_label(found, "error", "label_error").select("vec_id", "code", "error", "label_error", which.alias("codebooks_sha256"))
