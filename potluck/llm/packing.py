"""Packing token sequences into windows by non-negative least squares.

1. ``pieces`` tokenises every document and cuts it at the window: whole
   windows and a rest, each with its ids.
2. Rests are counted by length class (exact up to 64 tokens, then rounded up
   in steps of 8).  From here the histogram, of a size that the window bounds,
   is all that the driver sees.
3. Shallow combinations of classes that fill a window (pairs, triples, some
   deeper ones) are the columns of a least-squares problem; non-negative
   repeat counts that explain the histogram are rounded down.
4. What is left is packed greedily, again on the histogram: the largest class
   that still fits, repeated as often as the counts allow.
5. Rows get their place by their number within their class, so the plan is
   carried out by a numbering and one shuffle by sequence.

Defined cases: a null text is an empty one, a document of the end id alone;
rows that repeat a document are packed as often as they occur; ties in the
numbering go by the row ids of the written table; an empty table gives no
sequence.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from potluck.llm.common import fresh, numbered, written

STEP, EXACT = 8, 64


# ----------------------------------------------------------- tokenisation ---
def _chars(kind: str) -> str:
    """A regular-expression class of the letters (L) or numbers (N) below U+0250."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


#: Texts of these characters only are split here; others go to the library whole.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_chars('L')}]+|[{_chars('N')}]|[^\\s{_chars('L')}{_chars('N')}]+")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Words(dict):
    """Part of a text -> its ids as little-endian 32-bit integers; of bounded size."""

    def __init__(self, path: str, keep: int = 300_000):
        super().__init__()
        self.model, self.keep = _tokenizer(path).model, keep
        self.letters = str.maketrans(_byte_letters())

    def __missing__(self, part: str) -> bytes:
        mapped = part.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(mapped)], dtype="<u4").tobytes()
        if len(self) < self.keep:
            self[part] = ids
        return ids


@lru_cache(maxsize=4)
def _words(path: str) -> Words:
    return Words(path)


def token_bytes(text: str | None, path: str) -> bytes:
    """The ids of a text (without special tokens), little-endian 32-bit.

    Exactly the library's: plain Latin text is normalised and split as the
    tokenizer's file says and its parts are looked up or given to its model.
    Texts that may hold the string of a special token, which the library
    reads as that token, go to it whole.
    """
    text = text or ""
    if "<|" not in text and PLAIN.fullmatch(text):
        return b"".join(map(_words(path).__getitem__, PARTS.findall(text.lower())))
    return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (binary, little-endian 32-bit)
    of every piece: a document's ids and the end id, cut at the window."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        for batch in batches:
            row, start, length, total, ids = [], [], [], [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                raw = token_bytes(t, path) + end
                n = len(raw) // 4
                for at in range(0, n, window):
                    part = raw[4 * at:4 * (at + window)]
                    row.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    total.append(n)
                    ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(total, pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


# ------------------------------------------------------------------- plan ---
def size_class(length: int) -> int:
    return length if length <= EXACT else EXACT + -(-(length - EXACT) // STEP) * STEP


def combinations_for(window: int, present: list[int]) -> list[dict[int, int]]:
    """Shallow combinations of the present classes that fill a window closely."""
    have = np.array(sorted(present))
    out: set[tuple[int, ...]] = set()

    def close(parts: tuple[int, ...]) -> None:
        """Complete with the largest class that fits; keep it if little is left."""
        gap = window - sum(parts)
        if gap > 0:
            k = int(np.searchsorted(have, gap, side="right"))
            if not k:
                return
            parts = (*parts, int(have[k - 1]))
        if 0 <= window - sum(parts) <= STEP:
            out.add(tuple(sorted(parts)))

    coarse = have[np.unique(np.searchsorted(have, np.arange(0, window, max(1, window // 32)).clip(have[0], have[-1])))]
    for a in have.tolist():
        close((a,))
        copies = window // a
        for m in {2, 3, copies - 1, copies}:
            if 2 <= m <= copies:
                close((a,) * m)
        for b in coarse.tolist():
            if a + b <= window:
                close((a, b))
                for c in coarse[::4].tolist():
                    if a + b + c <= window:
                        close((a, b, c))
    return [{s: parts.count(s) for s in set(parts)} for parts in sorted(out)]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 60, tol: float = 1e-6) -> np.ndarray:
    """min |a x - b| for x >= 0: active sets, several columns entering at once."""
    m = a.shape[1]
    x, inside = np.zeros(m), np.zeros(m, dtype=bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        enter = np.argsort(-slope, kind="stable")[:16]
        enter = enter[slope[enter] > tol * max(1.0, float(np.abs(b).max()))]
        if not len(enter):
            break
        inside[enter] = True
        while inside.any():
            at = np.flatnonzero(inside)
            p = a[:, at]
            s = np.linalg.solve(p.T @ p + 1e-9 * np.eye(len(at)), p.T @ b)
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            bad = s <= 0
            old = x[at]
            ratio = np.where(bad, old / np.maximum(old - s, 1e-300), np.inf)
            t = min(1.0, float(ratio.min()))
            x[at] = old + t * (s - old)
            drop = at[bad & (x[at] <= 1e-12)]
            x[drop] = 0
            inside[drop] = False
    return x


def plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """[(classes with their multiplicity, repeats)] that place every piece."""
    left = {s: n for s, n in histogram.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []

    def take(parts: dict[int, int], most: int) -> None:
        k = min([most, *(left.get(s, 0) // m for s, m in parts.items())])
        if k > 0:
            out.append((parts, k))
            for s, m in parts.items():
                left[s] -= k * m
                if not left[s]:
                    del left[s]

    if window in left:
        take({window: 1}, left[window])
    if left:
        columns = combinations_for(window, list(left))
        rows = sorted(left)
        at = {s: i for i, s in enumerate(rows)}
        if columns:
            a = np.zeros((len(rows), len(columns)))
            for j, parts in enumerate(columns):
                for s, m in parts.items():
                    a[at[s], j] = m
            b = np.array([left[s] for s in rows], dtype=float)
            x = nnls(a, b)
            for j in np.argsort(-x, kind="stable"):
                if x[j] >= 1:
                    take(columns[j], int(x[j]))
    while left:  # greedily: the largest class that fits, and so on
        gap, parts = window, {}
        for s in sorted(left, reverse=True):
            m = min(left[s], gap // s)
            if m:
                parts[s] = m
                gap -= m * s
        take(parts, 1 << 62)
    return out


def pack(parts: DataFrame, window: int = 2048, length: str = "length") -> DataFrame:
    """``parts`` (pieces of 1 to ``window`` tokens) with sequence_id and offset.

    Other columns are carried along; a caller that wants the ids in place
    leaves them in, one that only wants the layout drops them before.
    """
    rid, kind, rank, sequence, slot = fresh(parts, "_rid", "_class", "_rank", "sequence_id", "_slot")
    size = F.col(length)
    rounded = F.when(size <= EXACT, size).otherwise(F.lit(EXACT) + F.ceil((size - EXACT) / F.lit(float(STEP))).cast("long") * STEP)
    rows = written(parts.withColumn(kind, F.least(rounded, F.lit(window))).withColumn(rid, F.monotonically_increasing_id()), "pieces")
    histogram = {r[kind]: r["n"] for r in rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row a class
    # where the rows of a class go, by their number: (first number, first sequence, copies, first slot)
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for combo, repeats in plan(histogram, window):
        at = 0
        for s in sorted(combo, reverse=True):
            places.setdefault(s, []).append((used.get(s, 0), base, combo[s], at))
            used[s] = used.get(s, 0) + combo[s] * repeats
            at += combo[s]
        base += repeats
    tables = {s: np.array(v, dtype=np.int64).T for s, v in places.items()}
    ranked = numbered(rows, kind, rid, rank)
    schema = T.StructType(list(ranked.schema.fields) + [T.StructField(sequence, T.LongType()), T.StructField(slot, T.LongType())])

    def place(batches):
        for batch in batches:
            kinds = batch.column(batch.schema.get_field_index(kind)).to_numpy(zero_copy_only=False)
            number = batch.column(batch.schema.get_field_index(rank)).to_numpy(zero_copy_only=False)
            seq, pos = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for s in np.unique(kinds):
                own = np.flatnonzero(kinds == s)
                first, start, copies, at = tables[int(s)]
                k = np.searchsorted(first, number[own], side="right") - 1
                q = number[own] - first[k]
                seq[own], pos[own] = start[k] + q // copies[k], at[k] + q % copies[k]
            arrays = [*batch.columns, pa.array(seq), pa.array(pos)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    before = Window.partitionBy(sequence).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    (offset,) = fresh(parts, "offset")
    return (ranked.mapInArrow(place, schema).withColumn(offset, F.coalesce(F.sum(length).over(before), F.lit(0)))
            .drop(rid, kind, rank, slot))


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """The layout of all documents with a checksum of each piece's ids."""
    cut = pieces(docs, path, doc_id, text, window, end_id)
    light = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(light, window).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
