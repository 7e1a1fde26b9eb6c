"""Language by unigram pieces, summed over all segmentations of the text.

Each language has a probability per piece of a fixed public vocabulary.  The
probability of a word is the sum, over all ways to cut it into pieces, of the
product of their probabilities; a forward pass over its positions sums them in
the logarithm.  White space separates words (in lower case, so that capitals
tell nothing), each begins with the word mark, and no piece of the vocabulary
that spans words is used, so the text's value is the sum of its words'.  A
character without a piece of its own may stand as its bytes.

Learning is expectation-maximisation.  Words are counted per language over
all learned documents (in tasks first, then by Spark), written once, and every
round adds the expected piece counts of all of them: the posterior of a piece
at a place is forward x piece x backward / whole.  The first round starts from
equal probabilities.  Languages share a part of their mass (the mean language
and an even floor), so that a piece rare everywhere tells little.

Words of a batch are worked on together: windows of up to the longest piece
are looked up by a rolling 64-bit hash, and the passes go over (end, length)
groups of matches of all words at once.  A task keeps the values of words it
has met in a bounded table, which changes speed only.

Defined cases: a text that is null or has no letter is ``und`` with score 0,
and so is every text where no language could be learned; texts are read
whole, very long ones in slices cut between words; a word of any length is
one pass; equal probabilities go to the language that is first in order; rows
with a null id are scored and never learned from; repeated rows count each
time; an empty or blank language name is a language like any other; clashing
columns of the input give way to the computed ones.

The score is the posterior probability of the language, languages being
likely a priori by their learned documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.llm.common import with_python, written

MARK = "▁"
UNDEFINED = "und"
SLICE = 1 << 20  # characters that are split into words at once
TOGETHER = 5_000  # words worked on at once
UNIT = 1 << 20  # expected counts are added as whole parts of this: sums do not depend on their order
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary with its window lookup."""

    def __init__(self, pieces: Sequence[str], byte_ids: Sequence[int] | None = None):
        """``pieces``: text of each id, or "" for an id that no text matches;
        ``byte_ids``: the ids of the 256 byte pieces."""
        self.size = len(pieces)
        self.byte_ids = None if byte_ids is None else np.asarray(byte_ids, dtype=np.int64)
        known = [(p, i) for i, p in enumerate(pieces) if p and MARK not in p[1:]]
        self.longest = max((len(p) for p, _ in known), default=1)
        keys = np.array([self._whole_hash(p) for p, _ in known], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for _, i in known], dtype=np.int64)[order]
        # leading bits of the keys, and of all beginnings of pieces: most windows end here
        self.seen, self.begun = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 20, dtype=bool)
        self.seen[self._bits(self.keys)] = True
        begins = {p[:k] for p, _ in known for k in range(1, len(p) + 1)}
        self.begun[self._bits(np.array([self._whole_hash(p) for p in begins], dtype=np.uint64))] = True

    @staticmethod
    def _bits(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(44)).astype(np.int64)

    @staticmethod
    def _mix(codes: np.ndarray) -> np.ndarray:
        x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def _whole_hash(self, piece: str) -> np.uint64:
        h = np.zeros(1, dtype=np.uint64)
        for c in self._mix(np.array([ord(x) for x in piece])):
            h = (h + c) * _BASE
        return h[0]

    def windows(self, codes: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, ids) of all pieces in the string of code points;
        none goes beyond the ``left`` code points from its start."""
        mixed = self._mix(codes)
        at, h = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        for length in range(1, self.longest + 1):
            if length > 1:
                more = left[at] >= length
                at, h = at[more], h[more]
            h = (h + mixed[at + (length - 1)]) * _BASE
            bits = self._bits(h)
            maybe = np.flatnonzero(self.seen[bits])
            place = np.searchsorted(self.keys, h[maybe])
            place[place == len(self.keys)] = 0
            hit = self.keys[place] == h[maybe] if len(self.keys) else np.zeros(len(maybe), dtype=bool)
            yield length, at[maybe[hit]], self.ids[place[hit]]
            go = self.begun[bits]
            at, h = at[go], h[go]


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """The pieces of a sentencepiece file."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    pieces, bytes_of = [], {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            bytes_of[int(p[3:-1], 16)] = i
        pieces.append("" if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else p)
    return Pieces(pieces, [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None)


class Lattice:
    """All pieces at all places of some words."""

    def __init__(self, pieces: Pieces, words: Sequence[str]):
        self.pieces, self.n = pieces, len(words)
        text = MARK + MARK.join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(self.n), sizes)
        # word w holds the nodes first[w] + w .. first[w] + w + sizes[w]: one more than its characters
        self.begin, self.end = first + np.arange(self.n), first + np.arange(self.n) + sizes
        starts, lengths, ids = [], [], []
        alone = np.zeros(len(codes), dtype=bool)
        left = first[word] + sizes[word] - np.arange(len(codes))  # characters to the word's end
        for length, at, who in pieces.windows(codes, left):
            if length == 1:
                alone[at] = True
            starts.append(at)
            lengths.append(np.full(len(at), length))
            ids.append(who)
        # characters without a piece: one edge each, made of their bytes
        lost = np.flatnonzero(~alone)
        self.strange, which = np.unique(codes[lost], return_inverse=True)
        starts.append(lost)
        lengths.append(np.ones(len(lost), dtype=np.int64))
        ids.append(pieces.size + which)
        at, size, who = (np.concatenate(x) for x in (starts, lengths, ids))
        self.tail, self.head, self.id, self.word = at + word[at], at + word[at] + size, who, word[at]
        # edges of one (place of the end in its word, length) meet every node once
        place = self.head - self.begin[self.word]
        key = place * (pieces.longest + 1) + size
        if len(key) and key.max() < 1 << 16:
            key = key.astype(np.uint16)  # sorted in one pass
        order = np.argsort(key, kind="stable")
        self.tail, self.head, self.id, self.word, key = (x[order] for x in (self.tail, self.head, self.id, self.word, key))
        cut = np.flatnonzero(np.diff(key)) + 1
        self.groups = [slice(a, b) for a, b in zip([0, *cut], [*cut, len(key)]) if b > a]
        self.bytes = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), dtype=np.uint8) for c in self.strange.tolist()]

    def weights(self, log_p: np.ndarray) -> np.ndarray:
        """Logarithms of pieces and of the strange characters [id, column]."""
        if not len(self.strange):
            return log_p
        if self.pieces.byte_ids is None:
            more = np.full((len(self.strange), log_p.shape[1]), log_p.min() if log_p.size else 0.0)
        else:
            more = np.stack([log_p[self.pieces.byte_ids[b]].sum(axis=0) for b in self.bytes])
        return np.concatenate([log_p, more])

    def forward(self, edge: np.ndarray) -> np.ndarray:
        """Logarithm of the sum over all paths from the word's begin to each node."""
        a = np.full((int(self.end[-1]) + 1 if self.n else 0, edge.shape[1]), -np.inf)
        a[self.begin] = 0.0
        for g in self.groups:
            a[self.head[g]] = np.logaddexp(a[self.head[g]], a[self.tail[g]] + edge[g])
        return a

    def backward(self, edge: np.ndarray) -> np.ndarray:
        """The same from each node to the word's end."""
        b = np.full((int(self.end[-1]) + 1 if self.n else 0, edge.shape[1]), -np.inf)
        b[self.end] = 0.0
        # from the last end on: an edge's head has then met all that follow it
        for g in reversed(self.groups):
            b[self.tail[g]] = np.logaddexp(b[self.tail[g]], b[self.head[g]] + edge[g])
        return b

    def values(self, log_p: np.ndarray) -> np.ndarray:
        """[word, column]: logarithm of the probability of each word."""
        if not self.n:
            return np.zeros((0, log_p.shape[1]))
        return self.forward(self.weights(log_p)[self.id])[self.end]

    def expected(self, log_p: np.ndarray, column: np.ndarray, times: np.ndarray) -> np.ndarray:
        """[id, column]: expected piece counts of the words, each under its own
        ``column`` of ``log_p`` and counted ``times``."""
        out = np.zeros(log_p.shape)
        if not self.n:
            return out
        all_w = self.weights(log_p)
        edge = all_w[self.id, column[self.word]][:, None]
        a, b = self.forward(edge), self.backward(edge)
        part = np.exp(a[self.tail] + edge + b[self.head] - a[self.end][self.word])[:, 0] * times[self.word]
        flat = np.bincount(self.id * log_p.shape[1] + column[self.word], weights=part, minlength=all_w.size).reshape(all_w.shape)
        out += flat[:len(log_p)]
        if self.pieces.byte_ids is not None:
            for k, some in enumerate(self.bytes):
                np.add.at(out, self.pieces.byte_ids[some], flat[len(log_p) + k])
        return out


# ------------------------------------------------------------------ model --
@dataclass
class Model:
    """Log probabilities [piece, language] and prior of the languages."""

    path: str
    languages: list[str]
    log_p: np.ndarray
    log_prior: np.ndarray


def words(text: str) -> Iterator[list[str]]:
    """The words of a text in lower case, in slices of about ``SLICE`` characters."""
    if len(text) <= SLICE:
        yield text.lower().split()
        return
    at = 0
    while at < len(text):
        gap = re.compile(r"\s").search(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield text[at:end].lower().split()
        at = end


def _count_words(spelled: dict[str, int]):
    """mapInArrow: (text, lang) -> (lang, word, n), counted within the task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter() for _ in spelled]

        def out():
            for k, c in enumerate(counts):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(c), pa.int32()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                                     names=["lang", "word", "n"])
                    c.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                for some in words(text.as_py()):
                    counts[spelled[lang.as_py()]].update(some)
                if sum(map(len, counts)) > 300_000:
                    yield from out()
        yield from out()
    return run


def _step(counted: DataFrame, path: str, log_p: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] of all counted words."""
    sent = counted.sparkSession.sparkContext.broadcast(log_p)  # vocabulary x languages

    def run(batches):
        pieces, logs = load(path), sent.value
        total = np.zeros(logs.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                total += Lattice(pieces, part.column(1).to_pylist()).expected(
                    logs, part.column(0).to_numpy(), part.column(2).to_numpy().astype(np.float64))
        units = np.rint(total * UNIT)
        piece, lang = np.nonzero(units)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)),
                                          pa.array(units[piece, lang].astype(np.int64))], names=["lang", "piece", "units"])

    got = (counted.select("lang", "word", "n").mapInArrow(run, "lang int, piece int, units long")
           .groupBy("lang", "piece").agg(F.sum(F.col("units").cast("decimal(38,0)")).cast("double").alias("units")).toPandas())
    out = np.zeros(log_p.shape)
    out[got["piece"].to_numpy(dtype=np.int64), got["lang"].to_numpy(dtype=np.int64)] = got["units"].to_numpy(dtype=np.float64) / UNIT
    return out


def smoothed(counts: np.ndarray, shared: float, even: float) -> np.ndarray:
    """Log probabilities from expected counts [piece, language]."""
    own = counts / np.maximum(counts.sum(axis=0, keepdims=True), 1e-300)
    mean = own.mean(axis=1, keepdims=True)
    return np.log((1 - shared) * own + shared * ((1 - even) * mean + even / len(counts)))


def learn(docs: DataFrame, learned: Column, path: str, text: str = "text", lang: str = "lang", rounds: int = 2,
          shared: float = 0.05, even: float = 0.05) -> Model:
    """Piece probabilities per language, from all rows marked ``learned``.

    ``shared``: part of each language's mass that is the mean of all;
    ``even``: part of that mean that is spread evenly over the vocabulary.
    The driver holds vocabulary x languages numbers.
    """
    rows = docs.where(F.coalesce(learned, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))
    n = {r["lang"]: r["n"] for r in rows.where(_has_letter(F.col("text"))).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(n)
    size = load(path).size
    if not languages:
        return Model(path, [], np.zeros((size, 0)), np.zeros(0))
    spelled = {name: k for k, name in enumerate(languages)}
    known = rows.where(F.col("lang").isin(languages))
    counted = written(known.mapInArrow(_count_words(spelled), "lang int, word string, n long")
                      .groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    log_p = np.full((size, len(languages)), -np.log(size))
    for _ in range(rounds):
        log_p = smoothed(_step(counted, path, log_p), shared, even)
    docs_of = np.array([n[x] for x in languages], dtype=np.float64)
    return Model(path, languages, log_p, np.log(docs_of / docs_of.sum()))


def _has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


class Values(dict):
    """word -> row of a growing matrix of word values; started anew when full."""

    def __init__(self, model: Model, log_p: np.ndarray, keep_bytes: int = 64 << 20):
        super().__init__()
        self.pieces, self.log_p = load(model.path), log_p
        self.keep = max(20_000, keep_bytes // (8 * max(1, log_p.shape[1])))
        self.matrix = np.zeros((0, log_p.shape[1]))

    def learn(self, some: Iterable[list[str]]) -> None:
        met = set().union(*some)
        new = list(met - self.keys())
        if len(self) + len(new) > self.keep:
            self.clear()
            new = list(met)
        at, step = len(self), max(200, 4 * TOGETHER // max(4, self.log_p.shape[1]))
        if at + len(new) > len(self.matrix):
            grown = np.empty((max(2 * len(self.matrix), at + len(new)), self.log_p.shape[1]))
            grown[:at] = self.matrix[:at]
            self.matrix = grown
        for k in range(0, len(new), step):
            part = new[k:k + step]
            self.matrix[at + k:at + k + len(part)] = Lattice(self.pieces, part).values(self.log_p)
        self.update(zip(new, range(at, at + len(new))))

    def total(self, some: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self.__getitem__, some), dtype=np.int64, count=len(some))
        return self.matrix[rows].sum(axis=0)


def predict(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of every whole text and its probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model.log_p)  # vocabulary x languages
    light = Model(model.path, model.languages, np.zeros((0, 0)), model.log_prior)

    def make():
        names = light.languages
        if not names:
            return lambda texts: ([UNDEFINED] * len(texts), [0.0] * len(texts))
        values = Values(light, sent.value)

        def fn(texts):
            totals = np.tile(light.log_prior, (len(texts), 1))
            waiting: list[tuple[int, list[str]]] = []

            def work():
                values.learn(some for _, some in waiting)
                for row, some in waiting:
                    totals[row] += values.total(some)
                waiting.clear()

            size = 0
            for row, whole in enumerate(texts):
                for some in words(whole or ""):
                    waiting.append((row, some))
                    size += len(some)
                    if size > 200_000:
                        work()
                        size = 0
            work()
            p = np.exp(totals - totals.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            return [names[k] for k in best], p[np.arange(len(best)), best]
        return fn

    found = with_python(docs, [text], make, [(lang_pred, T.StringType()), (score, T.DoubleType())])
    sure = _has_letter(F.col(text))
    return found.withColumn(lang_pred, F.when(sure, F.col(lang_pred)).otherwise(F.lit(UNDEFINED))).withColumn(
        score, F.when(sure, F.col(score)).otherwise(F.lit(0.0)))
