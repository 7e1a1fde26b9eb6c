"""SimHash near-duplicate detection with bit-sliced comparison.

1. A fingerprint per document: lower-cased word shingles (repeats included),
   XXH64 of each, and the majority of every bit.
2. Equal fingerprints are one node from here on, so exact copies cost nothing.
3. The 64 bits are cut into ``blocks`` runs; two fingerprints within
   ``radius`` differ in at most ``radius`` runs, hence agree in the others.
   Every choice of ``blocks - radius`` runs is one table, its value the bucket
   key: no link is lost, whatever the data.
4. Inside a bucket fingerprints are compared bit-sliced: the bit planes are
   stored vertically (bit r of plane p belongs to row r), one bitwise
   operation updates 64 distances, carry-save counters hold them and a block
   of rows is abandoned as soon as all of it exceeds the radius.
5. A bucket returns edges to one member of each connected group, not its
   pairs; buckets above ``split_rows`` are dealt as a grid of chunk pairs so
   that no task holds a hot bucket.
6. Edges become components by alternating large and small stars.

Defined cases: a null or wordless text has fingerprint zero and links like
any other; a text with fewer words than a shingle is one shingle; repeated
rows get the same component; a null id never becomes a component's id unless
all its members' ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.llm.common import fresh, with_python, written

SEED = 42
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------ fingerprints --
def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    votes = np.zeros(64, dtype=np.int64)
    n = len(words) - shingle + 1
    for at in range(0, n, 65536):  # bounded memory for very long texts
        spans = zip(starts[at:min(at + 65536, n)].tolist(), ends[at + shingle - 1:at + 65536 + shingle - 1].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, out: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``out``."""
    def make():
        def run(texts):
            return [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)]
        return run
    return with_python(docs, [text], make, [(out, T.LongType())])


# ------------------------------------------------- bit-sliced comparison ----
def planes(fps: np.ndarray) -> np.ndarray:
    """[64, words]: bit r of plane p is bit p (from the top) of fingerprint r."""
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    pad = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view("<u8")


def within(diff, shape: tuple[int, ...], radius: int) -> np.ndarray:
    """Bits that mark the rows whose set bits over all planes number <= radius.

    ``diff(p)`` gives the XOR plane p.  Three planes go through one carry-save
    adder; the sum and the carry enter saturating vertical counters.  Every 8
    planes or so the block stops if all its rows are over the radius.
    """
    width = max(1, radius.bit_length())
    counters = [np.zeros(shape, dtype=np.uint64) for _ in range(width)]
    over = np.zeros(shape, dtype=np.uint64)

    def add(x: np.ndarray, at: int) -> None:
        for k in range(at, width):
            x, counters[k] = counters[k] & x, counters[k] ^ x
        np.bitwise_or(over, x, out=over)

    for p in range(0, 63, 3):
        a, b, c = diff(p), diff(p + 1), diff(p + 2)
        ab = a ^ b
        add(ab ^ c, 0)
        add((a & b) | (c & ab), 1)
        if p % 9 == 6 and bool((over == FULL).all()):
            return np.zeros(shape, dtype=np.uint64)
    add(diff(63), 0)
    above, equal = np.zeros(shape, dtype=np.uint64), np.full(shape, FULL)
    for k in reversed(range(width)):  # counter > radius, from the top bit
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return ~(over | above)


def _rows(bits: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), bitorder="little", count=n).astype(bool)


def small_links(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked row pairs inside many small groups at once (rows sorted by group).

    The planes of all rows are shifted against themselves by 1, 2, ... rows.
    """
    n, most = len(fps), int(np.bincount(group).max(initial=0))
    own = planes(fps)
    first, second = [], []
    for d in range(1, most):
        whole, part = divmod(d, 64)
        shifted = np.zeros_like(own)
        moved = own[:, whole:]
        shifted[:, :moved.shape[1]] = moved >> np.uint64(part)
        if part and moved.shape[1] > 1:
            shifted[:, :moved.shape[1] - 1] |= moved[:, 1:] << np.uint64(64 - part)
        found = within(lambda p, s=shifted: own[p] ^ s[p], own.shape[1:], radius)
        hit = np.flatnonzero(_rows(found, n)[:n - d] & (group[:n - d] == group[d:]))
        first.append(hit)
        second.append(hit + d)
    return (np.concatenate(first), np.concatenate(second)) if first else (np.empty(0, int), np.empty(0, int))


def group_links(fps: np.ndarray, radius: int, tile: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """One link from every row of a large group to the seed of its connected part.

    The group is searched breadth first: all rows found in one step are the
    queries of the next and are compared, bit-sliced, with the rows not yet
    reached.  A dense group of near copies is done after a step or two.
    """
    left = np.arange(len(fps))
    first, second = [], []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        front = np.array([seed])
        while len(front) and len(left):
            own = planes(fps[left])
            hit = np.zeros(own.shape[1], dtype=np.uint64)
            step = max(1, tile // own.shape[1])
            for at in range(0, len(front), step):
                masks = planes_masks(fps[front[at:at + step]])
                got = within(lambda p, m=masks: own[p][None, :] ^ m[p][:, None], (masks.shape[1], own.shape[1]), radius)
                hit |= np.bitwise_or.reduce(got, axis=0)
            reached = _rows(hit, len(left))
            front, left = left[reached], left[~reached]
            first.append(np.full(len(front), seed))
            second.append(front)
    return (np.concatenate(first), np.concatenate(second)) if first else (np.empty(0, int), np.empty(0, int))


def planes_masks(fps: np.ndarray) -> np.ndarray:
    """[64, queries]: all ones where the query has the bit, else zero."""
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
    return np.where(bits == 1, FULL, np.uint64(0))


# ------------------------------------------------------------------ edges ---
EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _runs(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of ``blocks`` runs of the 64 bits, nearly equal."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(64 - hi, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def edges(nodes: DataFrame, fp: str, radius: int = 3, blocks: int | None = None, split_rows: int = 4096) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``nodes`` within ``radius``.

    Two rows within the radius are always in one connected part of the edges.
    ``nodes`` holds distinct fingerprints.  ``blocks`` (default radius + 2)
    trades tables for smaller buckets; the result does not depend on it.
    """
    blocks = blocks or radius + 2
    runs = _runs(blocks)
    value = F.col(fp)
    keys = []
    for number, keep in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << runs[k][1]) - 1) << runs[k][0] for k in keep)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(number).alias("t"), value.bitwiseAND(F.lit(signed)).alias("v")))
    dealt = written(nodes.select(value.alias("f"), F.explode(F.array(*keys)).alias("k"))
                    .select("f", F.col("k.t").alias("t"), F.col("k.v").alias("v")), "simhash-buckets")
    hot = (dealt.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split_rows)
           .select("t", "v", F.ceil(F.col("n") / F.lit(split_rows / 2)).cast("int").alias("chunks")))
    # a hot bucket is dealt as pairs of chunks (i < j): a row of chunk c goes to every pair that holds c
    marked = dealt.join(hot, ["t", "v"], "left")
    chunk = F.pmod(F.xxhash64(F.lit(7), F.col("f")), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: o != chunk)
    cells = F.when(F.col("chunks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(others, lambda o: F.struct(F.least(chunk, o).alias("i"), F.greatest(chunk, o).alias("j"))))
    cell = (marked.select("f", "t", "v", F.explode(cells).alias("x"))
            .select("f", "t", "v", F.col("x.i").alias("i"), F.col("x.j").alias("j")))

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)])
            if kept:
                rows = np.concatenate([kept.pop(), rows], axis=1)
            new = np.flatnonzero((np.diff(rows[1:], axis=1) != 0).any(axis=0)) + 1
            last = int(new[-1]) if len(new) else 0  # the last cell may go on in the next batch
            kept.append(rows[:, last:])
            if last:
                yield _edge_batch(*_cells(rows[:, :last], radius))
        if kept:
            yield _edge_batch(*_cells(kept[0], radius))

    found = cell.repartition("t", "v", "i", "j").sortWithinPartitions("t", "v", "i", "j").mapInArrow(link, EDGE)
    return found.dropDuplicates(["a", "b"])


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _cells(rows: np.ndarray, radius: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Edges of whole cells: rows [f, t, v, i, j], sorted by cell."""
    f = rows[0].view(np.uint64)
    change = np.flatnonzero((np.diff(rows[1:5], axis=1) != 0).any(axis=0)) + 1
    starts = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([starts, [rows.shape[1]]]))
    number = np.repeat(np.arange(len(starts)), sizes)
    first, second = [], []
    few = np.flatnonzero((sizes[number] > 1) & (sizes[number] <= small))
    if len(few):
        _, group = np.unique(number[few], return_inverse=True)
        x, y = small_links(group, f[few], radius)
        first.append(few[x])
        second.append(few[y])
    for k in np.flatnonzero(sizes > small):
        x, y = group_links(f[starts[k]:starts[k] + sizes[k]], radius)
        first.append(starts[k] + x)
        second.append(starts[k] + y)
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = rows[0][np.concatenate(first)], rows[0][np.concatenate(second)]
    return np.minimum(a, b), np.maximum(a, b)


# ------------------------------------------------------------- components ---
HOT_KEYS = 4096  # keys whose rows a join may deal over several tasks


def dealt_join(rows: DataFrame, side: DataFrame, key: str, total: int, least: int = 4096) -> DataFrame:
    """``rows`` joined with ``side`` on ``key``; no task has to take all rows of a key.

    ``side`` has one row a key and ``n``, the key's number of ``rows``, ``total``
    in all.  A key with more than ``total`` / ``HOT_KEYS`` rows (and ``least``)
    is dealt over as many salts as it holds such portions.  There are fewer than
    ``HOT_KEYS`` of these keys, so the list of them may be broadcast.  Rows are
    dealt by their place in a written table.  ``n`` is left out of the result.
    """
    portion = max(least, total // HOT_KEYS)
    hot = F.broadcast(side.where(F.col("n") > portion).select(F.col(key).alias("_hot"), F.ceil(F.col("n") / portion).cast("int").alias("_salts")))
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int")
    left = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    right = side.drop("n").join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", every).drop("_hot", "_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge but the roots; root: the part's smallest node.

    Alternating large and small stars: in each round every node links its
    larger (then its smaller) neighbours to its smallest one.  Only per-node
    minima are aggregated (partially, before the shuffle), and a hub's edges
    meet its minimum in several tasks (``dealt_join``).  Rounds are written to
    the shared folder; counts and a checksum come back to the driver.
    """
    count = F.count(F.lit(1))
    now = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").dropDuplicates(["u", "v"]), "edges")
    seen, size = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), count.alias("n"))
                        .select("u", F.least("u", "m").alias("m"), "n"), "large-star-least")
        large = written(dealt_join(both.where("v > u"), least, "u", 2 * size).select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v").dropDuplicates(["u", "v"]), "large-star")
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), count.alias("n")), "small-star-least")
        small = dealt_join(large, low, "u", large.count())
        now = written(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).dropDuplicates(["u", "v"]), "small-star")
        state = now.agg(count, F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, size = tuple(state), state[0]


def rooted(marked: DataFrame, fp: str, doc_id: str, radius: int = 3, blocks: int | None = None,
           split_rows: int = 4096) -> DataFrame:
    """(node, root, component_id, n: its rows) of every fingerprint in the
    written table ``marked``, as a written table."""
    nodes = written(marked.groupBy(F.col(fp).alias("node")).agg(F.min(doc_id).alias("low"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    part = components(edges(nodes, "node", radius, blocks, split_rows))
    known = written(nodes.join(part, "node", "left").select("node", "low", F.col("n").alias("rows"), F.coalesce("root", "node").alias("root")),
                    "simhash-roots")
    lows = written(known.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-components")
    return written(dealt_join(known, lows, "root", known.count())
                   .select("node", "root", "component_id", F.col("rows").alias("n")), "simhash-known")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3, blocks: int | None = None, split_rows: int = 4096) -> DataFrame:
    """doc_id, fingerprint (signed long), component_id of every row."""
    marked = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "fp", shingle)
                     .select("doc_id", "fp"), "simhash-fingerprints")
    known = rooted(marked, "fp", "doc_id", radius, blocks, split_rows)
    rows = marked.select("doc_id", F.col("fp").alias("node"))
    return (dealt_join(rows, known, "node", marked.count())
            .select("doc_id", F.col("node").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each near-duplicate group, with all its columns: the smallest
    id (nulls last; of rows that repeat this id, one)."""
    fp, rid = fresh(docs, "_fp", "_rid")
    marked = written(fingerprints(docs, text, fp, shingle).withColumn(rid, F.monotonically_increasing_id()), "simhash-docs")
    known = rooted(marked, fp, doc_id, radius)
    least = F.col(doc_id).eqNullSafe(F.col("component_id")).alias("least")  # null only where all ids are
    rows = marked.select(F.col(rid).alias("r"), doc_id, F.col(fp).alias("node"))
    member = dealt_join(rows, known, "node", marked.count()).select("r", "root", least)
    # one row of those with the smallest id stays; no step gathers the rows of a group
    first = member.where("least").groupBy("root").agg(F.min("r").alias("r"))
    gone = member.join(first, "r", "left_anti").select(F.col("r").alias("_gone"))
    return marked.join(gone, F.col(rid) == F.col("_gone"), "left_anti").drop(fp, rid)
