"""Top-N neighbours: a bounded heap per asked row in a map-side scan, a tree of
cells for numeric vectors, prefix-filtered postings for token vectors.

All scores of numeric vectors are sums over the components in their order, so
equal vectors get equal scores wherever they are scored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from potluck.operators.chunks import chunks
from potluck.session import cut_lineage

FOUND = "id long, neighbor_id long, score double"
_CELLS = 1 << 22  # scores held at once by a scan
_SCAN_PAIRS = 1 << 29  # pairs of vectors that a task of a token scan meets
MAX_SCANS = 1000  # tasks of a token scan: each gives a heap per asked vector


class Heap:
    """The ``n`` best (score, id) of each asked row: score descending, then id."""

    def __init__(self, rows: int, n: int):
        self.score = np.full((rows, n), -np.inf)
        self.id = np.full((rows, n), np.iinfo(np.int64).max)

    def push(self, at: int, score: np.ndarray, ids: np.ndarray) -> None:
        """``score`` [asked rows from ``at`` on, candidates]; -inf: no candidate."""
        rows, n = slice(at, at + len(score)), self.score.shape[1]
        bar = self.score[rows, -1]
        if score.shape[1] > n:  # what is below the nth of this block cannot stay
            bar = np.maximum(bar, np.partition(score, score.shape[1] - n, axis=1)[:, -n])
        r, c = np.nonzero((score >= bar[:, None]) & (score > -np.inf))
        if not len(r):
            return
        row = np.concatenate([np.repeat(np.arange(len(score)), n), r])
        s = np.concatenate([self.score[rows].ravel(), score[r, c]])
        i = np.concatenate([self.id[rows].ravel(), ids[c]])
        order = np.lexsort((i, -s, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        keep = order[place < n]
        self.score[rows], self.id[rows] = s[keep].reshape(-1, n), i[keep].reshape(-1, n)

    def rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, c = np.nonzero(self.score > -np.inf)
        return ids[r], self.id[r, c], self.score[r, c]


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay."""
    size = np.zeros(len(v))
    for j in range(v.shape[1]):
        size = size + v[:, j] * v[:, j]
    size = np.sqrt(size)
    return v / np.where(size == 0, 1.0, size)[:, None]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += a[:, j][:, None] * b[:, j][None, :]
    return out


def _matrix(column) -> np.ndarray:
    return np.vstack([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def scan_numeric(items: DataFrame, asked: DataFrame, top_n: int, max_bytes: int | None = None) -> DataFrame:
    """(id, neighbor_id, score): the best ``top_n`` other items of every asked
    row within each task; to be merged.  ``items``, ``asked``: (id, v).

    The items are scanned where they lie.  A task holds a chunk of asked
    vectors of a checked size, their heaps and one block of scores, whatever
    the number of items.
    """
    found = None
    for held in chunks(asked, max_bytes):
        part = items.select("id", "v").mapInArrow(_scan(held, top_n), FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def _scan(held, top_n: int):
    def run(batches):
        ids = held.value["id"].to_numpy(dtype=np.int64)
        if not len(ids):
            return
        vectors = unit(_matrix(held.value["v"]))
        heap = Heap(len(ids), top_n)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                other = part.column(0).to_numpy().astype(np.int64)
                x = unit(np.asarray(part.column(1).flatten().to_numpy(), dtype=np.float64).reshape(len(other), -1))
                step = max(1, _CELLS // len(other))
                for at in range(0, len(ids), step):
                    score = products(vectors[at:at + step], x)
                    score[ids[at:at + step, None] == other[None, :]] = -np.inf
                    heap.push(at, score, other)
        a, b, s = heap.rows(ids)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["id", "neighbor_id", "score"])
    return run


def scan_tokens(vectors: DataFrame, asked: DataFrame, n: int, max_bytes: int | None = None) -> DataFrame:
    """(id, neighbor_id, score): the best ``n`` vectors with a common term, itself
    included, of every asked vector within each task; to be merged.  ``vectors``,
    ``asked``: (low, terms [(term, tf)], n2).

    As ``scan_numeric``: the vectors are scanned once a chunk of asked ones, no
    pair is a row, and only the heaps leave a task.  Dot products of whole counts
    are exact.
    """
    flat = [F.col("terms.term").alias("term"), F.col("terms.tf").cast("array<double>").alias("tf"), F.col("n2").cast("double").alias("n2")]
    found = None
    for held in chunks(asked.select("low", *flat), max_bytes):
        pairs = vectors.count() * max(1, len(held.value))
        part = (vectors.select("low", *flat).repartition(max(1, min(MAX_SCANS, math.ceil(pairs / _SCAN_PAIRS))), "low")
                .mapInArrow(_scan_terms(held, n), FOUND))
        found = part if found is None else found.unionByName(part)
    return found


def _scan_terms(held, n: int):
    def entries(terms: pa.Array, counts: pa.Array, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, row, count) of the entries with a term of ``vocab``, by term."""
        row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        term = pc.fill_null(pc.index_in(terms.flatten(), value_set=vocab), -1).to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        order = order[np.searchsorted(term[order], 0):]
        return term[order], row[order], counts.flatten().to_numpy(zero_copy_only=False)[order]

    def run(batches):
        frame = held.value
        ids = frame["low"].to_numpy(dtype=np.int64)
        if not len(ids):
            return
        size, heap = frame["n2"].to_numpy(dtype=np.float64), Heap(len(ids), n)
        terms, counts = pa.array(frame["term"], pa.list_(pa.string())), pa.array(frame["tf"], pa.list_(pa.float64()))
        vocab = pc.unique(terms.flatten())
        step = max(1, _CELLS // 4096)
        parts = [(at, *entries(terms.slice(at, step), counts.slice(at, step), vocab)) for at in range(0, len(ids), step)]
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                batch = whole.slice(lo, 4096)
                other = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                term_b, row_b, w_b = entries(batch.column(1), batch.column(2), vocab)
                n2 = batch.column(3).to_numpy(zero_copy_only=False)
                for at, term_a, row_a, w_a in parts:
                    dot = np.zeros((min(step, len(ids) - at), len(other)))
                    for t in np.intersect1d(term_a, term_b):
                        a, b = (slice(*np.searchsorted(x, [t, t + 1])) for x in (term_a, term_b))
                        dot[np.ix_(row_a[a], row_b[b])] += np.outer(w_a[a], w_b[b])
                    score = np.full(dot.shape, -np.inf)
                    np.divide(dot, np.sqrt(np.outer(size[at:at + len(dot)], n2)), out=score, where=dot > 0)
                    heap.push(at, score, other)
        a, b, s = heap.rows(ids)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["id", "neighbor_id", "score"])
    return run


# ------------------------------------------------- all items, by numbers ----
BLOCK_CELLS = 8  # cells of the tree in a block of vectors
MAX_CELLS, CELL_NUMBERS = 1 << 14, 1 << 18  # cells and components of their boxes
CELL_SAMPLE, SAMPLE_NUMBERS = 8, 1 << 21  # sampled vectors a cell, components of all
SEATS = 128  # from here on a seat takes more than one block, up to SEAT_BLOCKS
SEAT_BLOCKS = 8
SLACK = 1e-9  # of a bar: the sums of a matrix product come in another order
_PENDING = 1 << 20  # found pairs held before they are cut to the best


def _lists(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _splits(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(component, value) at which the inner nodes of a tree split the sample
    into halves; the children of node k are 2k (up to the value) and 2k + 1."""
    component, value = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    parts = {1: sample}
    for node in range(1, 1 << depth):
        x = parts.pop(node)
        if len(x):
            component[node] = x.var(axis=0).argmax()
            value[node] = np.median(x[:, component[node]])
        right = x[:, component[node]] > value[node]
        parts[2 * node], parts[2 * node + 1] = x[~right], x[right]
    return component, value


def _boxes(facts: list, depth: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low corner, high corner, greatest squared reach) of every node's vectors."""
    cells = 1 << depth
    low, high = np.full((2 * cells, width), np.inf), np.full((2 * cells, width), -np.inf)
    reach = np.full(2 * cells, -np.inf)
    for r in facts:
        low[cells + r["cell"]], high[cells + r["cell"]], reach[cells + r["cell"]] = r["low"], r["high"], r["reach"]
    for node in range(cells - 1, 0, -1):
        two = slice(2 * node, 2 * node + 2)
        low[node], high[node], reach[node] = low[two].min(axis=0), high[two].max(axis=0), reach[two].max()
    return low, high, reach


def _reached(u: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell), in order: the cells whose box is within its reach of a row."""
    who, node = np.arange(len(u)), np.ones(len(u), dtype=np.int64)
    for level in range(depth + 1):
        far = np.zeros(len(node))
        for j in range(u.shape[1]):
            x = u[who, j]
            gap = np.maximum(np.maximum(low[node, j] - x, x - high[node, j]), 0.0)
            far += gap * gap
        near = far <= reach[node]
        who, node = who[near], node[near]
        if level < depth:
            who, node = np.repeat(who, 2), (2 * node[:, None] + np.arange(2)).ravel()
        if len(u) > 1 and len(node) > _PENDING // 2:  # a part at a time
            half = len(u) // 2
            (a, x), (b, y) = (_reached(part, low, high, reach, depth) for part in (u[:half], u[half:]))
            return np.concatenate([a, b + half]), np.concatenate([x, y])
    return who, node - (1 << depth)


def _bars(n: int, width: int, sample: np.ndarray):
    """applyInArrow: for every vector of a group a score that the nth best of all
    vectors reaches: the nth best of the group, or of a sample for small groups."""
    def nth(u: np.ndarray, other: np.ndarray) -> np.ndarray:
        bar = np.full(len(u), -np.inf)
        if len(other) >= n:
            step = max(1, _CELLS // len(other))
            for at in range(0, len(u), step):
                score = u[at:at + step] @ other.T
                bar[at:at + step] = np.partition(score, len(other) - n, axis=1)[:, -n]
        return bar

    def run(group: pa.Table) -> pa.Table:
        u = _lists(group.column("u"), width)
        bar = nth(u, u)
        if len(u) < SEAT_BLOCKS * n:
            bar = np.maximum(bar, nth(u, sample))
        return group.append_column("bar", pa.array(bar - SLACK))
    return run


class _Seat:
    """Asked vectors, in the order of their cells, and the best ``n`` found for each."""

    def __init__(self, n: int, ids: np.ndarray, u: np.ndarray, cell: np.ndarray, bar: np.ndarray):
        self.n, self.ids, self.u, self.bar = n, ids, u, bar
        self.start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        self.end = np.r_[self.start[1:], len(ids)]
        self.low, self.high = np.minimum.reduceat(u, self.start), np.maximum.reduceat(u, self.start)
        self.kept = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self.pending = 0
        self.widen()

    def widen(self) -> None:
        self.reach = 2 - 2 * np.minimum.reduceat(self.bar, self.start) + SLACK

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        far = np.zeros((len(self.start), len(x)))
        for j in range(x.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, j, None] - x[None, :, j], x[None, :, j] - self.high[:, j, None]), 0.0)
            far += gap * gap
        for k in range(len(self.start)):
            near = np.flatnonzero(far[k] <= self.reach[k])
            if not len(near):
                continue
            other, step = x[near].T, max(1, _CELLS // len(near))
            for at in range(self.start[k], self.end[k], step):
                to = min(at + step, self.end[k])
                r, c = np.nonzero(self.u[at:to] @ other >= self.bar[at:to, None])
                if not len(r):
                    continue
                r, c = r + at, near[c]
                score = np.zeros(len(r))
                for j in range(x.shape[1]):  # as in products
                    score += self.u[r, j] * x[c, j]
                self.kept.append((r, ids[c], score))
                self.pending += len(r)
                if self.pending > _PENDING:
                    self.cut()
                    self.widen()

    def cut(self) -> None:
        row, i, s = (np.concatenate(x) for x in zip(*self.kept))
        order = np.lexsort((i, -s, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        last = order[place == self.n - 1]
        self.bar[row[last]] = np.maximum(self.bar[row[last]], s[last] - SLACK)
        keep = order[place < self.n]
        self.kept, self.pending = [(row[keep], i[keep], s[keep])], 0

    def rows(self) -> pa.RecordBatch:
        self.cut()
        row, i, s = self.kept[0]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[row]), pa.array(i), pa.array(s)], names=["id", "neighbor_id", "score"])


def _meet_seats(n: int, width: int):
    """mapInArrow over (seat, chunk, held, low, u, cell, bar) sorted by the first
    three and the cell: the asked vectors of a seat are held, then the others
    that reach it pass by."""
    def run(batches):
        key, asked, seat = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for at, to in zip(np.r_[0, edges], np.r_[edges, len(keys)]):
                if at == to:
                    continue
                if key != tuple(keys[at, :2]):
                    if seat is not None:
                        yield seat.rows()
                    key, asked, seat = tuple(keys[at, :2]), [], None
                part = batch.slice(at, to - at)
                ids, u = part.column(3).to_numpy(), _lists(part.column(4), width)
                if keys[at, 2] == 0:
                    asked.append((ids, u, part.column(5).to_numpy(), part.column(6).to_numpy()))
                    continue
                if not asked:  # a chunk without vectors
                    continue
                if seat is None:
                    seat = _Seat(n, *(np.concatenate(x) for x in zip(*asked)))
                for lo in range(0, len(ids), 4096):
                    seat.meet(ids[lo:lo + 4096], u[lo:lo + 4096])
        if seat is not None:
            yield seat.rows()
    return run


def vectors_by_pivots(vectors: DataFrame, n: int, block_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """((id, neighbor_id, score), the plan's skips): for every distinct vector
    (low, v) the best ``n`` vectors by cosine, itself included.

    A tree whose pivots are medians of a bounded sample deals the vectors of
    length 1 to cells, about ``BLOCK_CELLS`` a block of ``block_rows``; a seat
    is a subtree of one to ``SEAT_BLOCKS`` blocks.  The nth best score within
    its seat is a vector's bar, so what can still be among its best lies within
    a distance of it, its reach.  Every vector is then sent once to each seat
    that has a cell whose box, widened by the greatest reach in the cell,
    holds it, and meets there the cells that it is in reach of.  How many these
    are depends on ``n`` and the components, not on the number of vectors.  A
    task holds the asked vectors of one seat; a seat that the tree cannot split
    (equal directions) is dealt to chunks.  The zero vector has cosine 0 with
    every other and stands outside the tree.
    """
    spark = vectors.sparkSession
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    count, width = facts["n"], max(1, facts["width"])
    wanted = min(math.ceil(count * BLOCK_CELLS / block_rows), MAX_CELLS, CELL_NUMBERS // width)
    depth = max(0, math.ceil(math.log2(max(1, wanted))))
    shift = min(depth, BLOCK_CELLS.bit_length() - 1)
    while depth - shift > SEATS.bit_length() - 1 and (count << shift >> depth) < SEAT_BLOCKS * block_rows // 2:
        shift += 1
    nonzero = F.exists("v", lambda x: x != 0)
    size = max(1, min(CELL_SAMPLE << depth, SAMPLE_NUMBERS // width))
    drawn = vectors.where(nonzero & (F.pmod(F.xxhash64("v"), F.lit(max(1, count // size))) == 0)).select("v").limit(2 * size).toArrow()
    sample = unit(_lists(drawn.column("v"), width)) if drawn.num_rows else np.zeros((0, width))
    sample = sample[np.isfinite(sample).all(axis=1)]
    component, value = _splits(sample, depth)

    def place(batches):
        for batch in batches:
            u = unit(_lists(batch.column(1), width))
            fit = np.isfinite(u).all(axis=1)  # others have no score with any vector
            u, node = u[fit], np.ones(fit.sum(), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + (u[np.arange(len(u)), component[node]] > value[node])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * width, pa.int32()), pa.array(u.ravel()))
            cell = node - (1 << depth)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fit)), lists, pa.array(cell, pa.int32())], names=["low", "u", "cell"])

    placed = cut_lineage(vectors.where(nonzero).select("low", "v").mapInArrow(place, "low long, u array<double>, cell int"))
    seats, most = 1 << (depth - shift), max(block_rows, 2 * (count << shift >> depth))
    chunks_of = np.zeros(seats, dtype=np.int64)
    for r in placed.groupBy(F.shiftright("cell", shift).alias("seat")).count().collect():  # a row a seat
        chunks_of[r["seat"]] = 1 if r["count"] <= 2 * most else math.ceil(r["count"] / most)
    tasks = int(min(MAX_SCANS, max(1, 2 * chunks_of.sum())))
    seat = F.shiftright("cell", shift)
    of_seat = F.element_at(F.array(*[F.lit(int(c)) for c in chunks_of]), seat + 1)
    dealt = placed.withColumn("seat", seat).withColumn("chunk", F.pmod(F.xxhash64("low"), of_seat).cast("int"))
    ready = cut_lineage(dealt.repartition(tasks, "seat", "chunk").groupBy("seat", "chunk").applyInArrow(
        _bars(n, width, sample[:4096]), "low long, u array<double>, cell int, seat int, chunk int, bar double"))
    corner = [F.array(*[f(F.col("u")[j]) for j in range(width)]) for f in (F.min, F.max)]
    boxes = _boxes(ready.groupBy("cell").agg(corner[0].alias("low"), corner[1].alias("high"), (2 - 2 * F.min("bar") + SLACK).alias("reach"))
                   .collect(), depth, width)  # a row a cell

    def send(batches):
        """Every vector once to each seat, and chunk of it, that it is in reach of."""
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                who, cell = _reached(_lists(batch.column(1), width), *boxes, depth)
                to = cell >> shift
                first = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (to[1:] != to[:-1])][:len(who)])
                who, to = who[first], to[first]
                times = chunks_of[to]
                who, to = np.repeat(who, times), np.repeat(to, times)
                chunk = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times)
                for at in range(0, len(who), 8192):
                    part, some = slice(at, at + 8192), batch.take(pa.array(who[at:at + 8192]))
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), pa.array(to[part], pa.int32()),
                                                      pa.array(chunk[part], pa.int32())], names=["low", "u", "own", "seat", "chunk"])

    asks = ready.select("low", "u", "seat").mapInArrow(send, "low long, u array<double>, own int, seat int, chunk int")
    held = ready.select("seat", "chunk", F.lit(0).alias("held"), "low", "u", "cell", "bar")
    passing = asks.select("seat", "chunk", F.lit(1).alias("held"), "low", "u", F.lit(0).alias("cell"), F.lit(0.0).alias("bar"))
    found = (held.unionByName(passing).repartition(tasks, "seat", "chunk").sortWithinPartitions("seat", "chunk", "held", "cell")
             .mapInArrow(_meet_seats(n, width), FOUND))
    skips = asks.where("seat <> own").groupBy(F.col("seat").alias("to_part")).agg(F.countDistinct("low").alias("searched"))
    zero = vectors.where(~nonzero).select("low").first()
    if zero is not None:
        meets = [r["low"] for r in vectors.orderBy("low").limit(n).collect()]
        own = spark.createDataFrame([(zero["low"], x, 0.0) for x in {*meets, zero["low"]}], FOUND)
        found = found.unionByName(placed.select(F.col("low").alias("id"), F.lit(zero["low"]).alias("neighbor_id"), F.lit(0.0).alias("score"))).unionByName(own)
    return found, skips


# -------------------------------------------------- all items, by tokens ----
PAIRS = FOUND + ", compared long"


def _postings_scores(n: int):
    """cogroup of (t, asked vectors) and (t, vectors that hold t): pairs that
    share t, scored where t is their first common term.  A row with score -1
    a group tells how many pairs were compared."""
    def flat(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, row, weight) of all entries, in the order of terms."""
        row = np.repeat(np.arange(len(part)), [len(x) for x in part["terms"]])
        term = np.concatenate([np.asarray(x, dtype=np.int64) for x in part["terms"]])
        weight = np.concatenate([np.asarray(x, dtype=np.float64) for x in part["w"]])
        order = np.argsort(term, kind="stable")
        return term[order], row[order], weight[order]

    def score(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        compared = 0
        others = dict(tuple(held.groupby("t", sort=False))) if len(held) else {}
        for t, mine in asked.groupby("t", sort=False):
            if t not in others:
                continue
            other = others[t]
            (term_a, row_a, w_a), (term_b, row_b, w_b) = flat(mine), flat(other)
            ids_a, ids_b = mine["low"].to_numpy(np.int64), other["low"].to_numpy(np.int64)
            dot, skip = np.zeros((len(mine), len(other))), ids_a[:, None] == ids_b[None, :]
            for term in np.intersect1d(term_a, term_b):
                a, b = (slice(*np.searchsorted(x, [term, term + 1])) for x in (term_a, term_b))
                cells = np.ix_(row_a[a], row_b[b])
                dot[cells] += np.outer(w_a[a], w_b[b])
                if term < t:
                    skip[cells] = True  # met under that term
            s = dot / np.sqrt(np.outer(mine["n2"].to_numpy(np.float64), other["n2"].to_numpy(np.float64)))
            s[skip] = -np.inf
            compared += int((~skip).sum())
            heap = Heap(len(mine), n)
            heap.push(0, s, ids_b)
            out.append(heap.rows(ids_a))
        a, b, s = (np.concatenate(x) for x in zip(*out))
        rows = pd.DataFrame({"id": a, "neighbor_id": b, "score": s, "compared": np.zeros(len(a), dtype=np.int64)})
        return pd.concat([rows, pd.DataFrame({"id": [0], "neighbor_id": [0], "score": [-1.0], "compared": [compared]})])
    return score


def vectors_by_postings(vectors: DataFrame, n: int, block_rows: int = 2048) -> tuple[DataFrame, DataFrame]:
    """((id, neighbor_id, score), one row ``compared``): for every distinct
    vector (low, terms [(term, tf)], n2) the best ``n`` vectors by cosine with
    a common term, itself included.

    Terms are numbered from the rarest on.  A vector first meets those that
    hold its rarest shared term; of what it finds the (n - 1)th best is its bar
    (0 without).  Its prefix is the run of its rarest terms after which the
    rest stays below the bar, by the greatest weight of each term anywhere and
    by the rest's length: a vector that reaches the bar shares a term of the
    prefix.  So only postings of prefix terms meet, in blocks of about
    ``block_rows`` a side, and a pair is scored once, under its first common
    term.
    """
    from potluck.operators.common import with_index

    size = F.sqrt(F.col("n2").cast("double"))
    flat = vectors.select("low", "n2", F.explode("terms").alias("x")).select(
        "low", "n2", F.col("x.term").alias("term"), F.col("x.tf").alias("tf"))
    numbered = with_index(flat.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(F.col("tf") / size).alias("most")), ["df", "term"], "t")
    rows = flat.join(numbered, "term").groupBy("low").agg(
        F.array_sort(F.collect_list(F.struct("t", "tf", "df", "most"))).alias("x"), F.first("n2").alias("n2"))
    rows = cut_lineage(rows.select("low", "n2", F.col("x.t").alias("terms"), F.col("x.tf").cast("array<double>").alias("w"), "x"))
    postings = numbered.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    packs = max(1, math.ceil(postings / block_rows))

    def meet(asked: DataFrame) -> DataFrame:
        """``asked``: (low, n2, terms, w, t, df) against all vectors that hold t.
        Rare terms share groups; one with many vectors has blocks of its own."""
        def dealt(df: DataFrame) -> DataFrame:
            hot = F.col("df") > block_rows
            return df.select(
                "low", "n2", "terms", "w", "t", F.when(hot, F.col("t")).otherwise(-1 - F.pmod(F.xxhash64("t"), F.lit(packs))).alias("g"),
                F.when(hot, F.ceil(F.col("df") / F.lit(block_rows))).otherwise(F.lit(1)).cast("long").alias("blocks")).withColumn(
                "own", F.pmod(F.xxhash64("low"), F.col("blocks")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        vector = ["low", "n2", "terms", "w", "t"]
        left = dealt(asked).select(*[F.col(c).alias(c) for c in vector], F.col("g").alias("g"), F.col("own").alias("a"), every.alias("b"))
        right = (dealt(rows.select("low", "n2", "terms", "w", F.explode("x").alias("e")).select("low", "n2", "terms", "w", "e.t", "e.df").where("df > 1"))
                 .select(*[F.col(c).alias(c) for c in vector], F.col("g").alias("h"), every.alias("c"), F.col("own").alias("d")))
        return left.groupBy("g", "a", "b").cogroup(right.groupBy("h", "c", "d")).applyInPandas(_postings_scores(n), PAIRS)

    shared = F.filter("x", lambda e: e["df"] > 1)
    asks = rows.withColumn("home", F.get(shared, F.lit(0)))
    home = cut_lineage(meet(asks.where("home is not null").select("low", "n2", "terms", "w", "home.t", "home.df")))
    own = Window.partitionBy("id").orderBy(F.desc("score"), "neighbor_id")
    bar = (home.where("score > 0").withColumn("r", F.row_number().over(own)).where(F.col("r") == n - 1)
           .select(F.col("id").alias("of"), F.col("score").alias("bar")))

    def rest(k):
        """What the terms from the kth on can add to a score."""
        tail = F.slice("x", k + 1, F.size("x"))
        by_term = F.aggregate(tail, F.lit(0.0), lambda s, e: s + e["tf"] / size * e["most"])
        by_length = F.sqrt(F.aggregate(tail, F.lit(0.0), lambda s, e: s + e["tf"] * e["tf"])) / size
        return F.least(by_term, by_length) * (1 + 1e-9)

    with_rest = F.transform("x", lambda e, k: F.struct(e["t"].alias("t"), e["df"].alias("df"), rest(k).alias("rest")))
    needed = F.filter(with_rest, lambda e: (e["df"] > 1) & (e["t"] != F.col("home.t")) & (e["rest"] >= F.coalesce("bar", F.lit(0.0))))
    later = asks.join(bar, F.col("low") == F.col("of"), "left").select("low", "n2", "terms", "w", F.explode(needed).alias("e"))
    pairs = cut_lineage(home.unionByName(meet(later.select("low", "n2", "terms", "w", "e.t", "e.df"))))
    itself = rows.select(F.col("low").alias("id"), F.col("low").alias("neighbor_id"), F.lit(1.0).alias("score"))
    return pairs.where("score > 0").drop("compared").unionByName(itself), pairs.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))
