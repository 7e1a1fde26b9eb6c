"""Toxicity: a learned lexicon, misspellings by automaton, context windows.

Learning (near copies of one another count once):

* words and word beginnings whose rate among toxic documents is far above
  their rate among clean ones (smoothed, and ``min_docs`` toxic documents or
  more) form the lexicon, whatever their number; rates are over the labelled
  rows that are not held out, at most about ``evidence_rows`` a class;
* the lexicon is a trie; Levenshtein automata run over it at once: a state is
  a set of (trie node, edits used), so one walk over a word's letters finds
  every term within its distance (none for short terms, 1, or 2 for long);
* a term has the log-odds of these rows; every distance from it has those of a
  bounded, documented sample, so one that also catches clean words has no
  weight;
* each hit is read in a window of words: a hit inside quotation marks counts
  as quoted and enters a feature of its own;
* logistic regression over the few features gives the score.

Scoring is one pass over whole texts.  Neither labels nor lang, source or
doc_id are inputs of a score.

Defined cases: null and empty texts have no hit and get the score of a
document without hits; a table without labels of both kinds learns no lexicon
and every score is the labelled share (0 without labels); a document that
repeats or has several labels counts as toxic if one says so; a null id is
never learned from and is not held out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.llm.common import fit_logistic, fresh, hash_share, with_python, written

WORD = re.compile(r"[^\W_]+")
#: Characters that open or close a quotation.
QUOTES = "\"'“”„«»‘’‹›"
WINDOW = 6
PREFIXES = range(4, 9)
LIFT = 20.0
N_FEATURES = 5


# --------------------------------------------------- trie x automata --------
def allowed_edits(term: str) -> int:
    n = len(term) - 2 * term.endswith("*")  # a beginning says less than a word of its length
    return 0 if n < 5 else 1 if n < 9 else 2


class Lexicon:
    """Trie of terms (a trailing ``*``: any ending) walked with Levenshtein automata.

    The product of the automata and the trie is determinised lazily: states
    are frozen sets of (node, edits) and transitions are kept, up to a bound.
    """

    def __init__(self, terms: Iterable[str], keep: int = 50_000):
        self.terms = sorted(set(terms))
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]      # whole-word terms that end here
        self.opens: list[list[int]] = [[]]     # beginnings that end here
        self.room: list[int] = [0]             # most edits a term below still allows
        for t, term in enumerate(self.terms):
            stem = term.rstrip("*")
            k, path = allowed_edits(stem), [0]
            for ch in stem:
                at = self.children[path[-1]].get(ch)
                if at is None:
                    at = len(self.children)
                    self.children[path[-1]][ch] = at
                    self.children.append({})
                    self.ends.append([])
                    self.opens.append([])
                    self.room.append(0)
                path.append(at)
            for node in path:
                self.room[node] = max(self.room[node], k)
            (self.opens if term.endswith("*") else self.ends)[path[-1]].append(t)
        self.keep = keep
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.found: list[tuple] = []
        self.start = self._state({(0, 0)})

    def _state(self, raw: set) -> int:
        best: dict[int, int] = {}
        todo = list(raw)
        while todo:  # letters of the term left out of the word
            node, e = todo.pop()
            if e > self.room[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(c, e + 1) for c in self.children[node].values()]
        key = frozenset(best.items())
        at = self.states.get(key)
        if at is None:
            at = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            ends: dict[int, int] = {}
            opens: dict[int, int] = {}
            for node, e in key:
                for here, terms in ((ends, self.ends[node]), (opens, self.opens[node])):
                    for t in terms:
                        if e <= allowed_edits(self.terms[t]):
                            here[t] = min(e, here.get(t, 9))
            self.found.append((tuple(sorted(ends.items())), tuple(opens.items())))
        return at

    def _step(self, state: int, ch: str) -> int:
        raw = set()
        for node, e in self.sets[state]:
            child = self.children[node].get(ch)
            if child is not None:
                raw.add((child, e))
            raw.add((node, e + 1))                                             # a letter too many
            raw.update((c, e + 1) for c in self.children[node].values())        # another letter
        at = self._state(raw)
        self.next[state][ch] = at
        return at

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term number, distance) of every term that ``word`` matches; a
        beginning matches with the least distance of any start of the word."""
        if len(self.sets) > self.keep:
            self._reset()
        at, opened = self.start, ()
        steps, sets, found = self.next, self.sets, self.found
        for ch in word:
            nxt = steps[at].get(ch)
            at = self._step(at, ch) if nxt is None else nxt
            if found[at][1]:
                opened += found[at][1]
            if not sets[at]:
                break
        hits = dict(found[at][0])
        for t, e in opened:
            hits[t] = min(e, hits.get(t, 9))
        return tuple(sorted(hits.items()))


# ------------------------------------------------------------- the model ----
@dataclass
class Model:
    """What scoring needs: terms, weight per (term, distance), regression."""
    terms: list[str] = field(default_factory=list)
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    coef: list[float] = field(default_factory=lambda: [0.0] * N_FEATURES)
    intercept: float = -20.0


class Scorer:
    def __init__(self, model: Model, keep: int = 50_000):
        self.model, self.lexicon, self.keep = model, Lexicon(model.terms), keep
        assert self.lexicon.terms == sorted(set(model.terms))
        self.cache: dict[str, tuple] = {}
        self.coef = np.array(model.coef)

    def hits(self, word: str) -> tuple:
        got = self.cache.get(word)
        if got is None:
            got = self.lexicon.match(word)
            if len(self.cache) < self.keep:
                self.cache[word] = got
        return got

    def features(self, text: str | None) -> list[float]:
        """Strongest term; plain and quoted weight; distinct terms; hits a word."""
        low = (text or "").lower()
        words = WORD.findall(low)
        if not self.lexicon.terms:
            return [0.0] * N_FEATURES
        cache, hits = self.cache, self.hits
        bad = {}
        for w in set(words):
            got = cache.get(w)
            if got is None:
                got = hits(w)
            if got:
                weight, term = max((self.model.weights.get(h, 0.0), h[0]) for h in got)
                if weight > 0:
                    bad[w] = (weight, term)
        if not bad:
            return [0.0] * N_FEATURES
        plain = quoted = top = 0.0
        count, kinds = 0, set()
        spans = [(m.start(), m.end(), m.group()) for m in WORD.finditer(low)]
        for k, (start, end, w) in enumerate(spans):
            if w not in bad:
                continue
            weight, term = bad[w]
            before = low[max(0, spans[max(0, k - WINDOW)][0] - 1):start]
            after = low[end:spans[min(len(spans) - 1, k + WINDOW)][1] + 1]
            count += 1
            if _opened(before) and _closed(after):
                quoted += weight
                continue
            kinds.add(term)
            top = max(top, weight)
            plain += weight
        return [top, math.log1p(plain), math.log1p(quoted), math.log1p(len(kinds)), math.log1p(100.0 * count / len(words))]

    def score(self, texts: list) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=float).reshape(-1, N_FEATURES)
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.coef + self.model.intercept, -30, 30)))


def _opened(before: str) -> bool:
    """A quotation mark that starts a word stands in the window before, unclosed."""
    open_now = False
    for k, ch in enumerate(before):
        if ch in QUOTES:
            starts = k == 0 or before[k - 1].isspace() or before[k - 1] in "(["
            ends = k + 1 < len(before) and (before[k + 1].isspace() or before[k + 1] in ".,;:!?)")
            if starts and not ends:
                open_now = True
            elif not starts:
                open_now = open_now and k + 1 < len(before) and before[k + 1].isalnum()
    return open_now


def _closed(after: str) -> bool:
    for k, ch in enumerate(after):
        if ch in QUOTES and (k == 0 or not after[k - 1].isspace()):
            if k + 1 >= len(after) or not after[k + 1].isalnum():
                return True
    return False


# -------------------------------------------------------------- learning ----
HELD_TERMS = 400_000  # terms counted in a task before they go to the shuffle
HELD_WORDS = 20_000  # words whose terms a task remembers


def _terms(words: Iterable[str]) -> set[str]:
    out = set()
    for w in words:
        if len(w) >= 3:
            out.add(w)
        out.update(w[:k] + "*" for k in PREFIXES if len(w) > k)
    return out


def _sketch(words: list[str]) -> list[int]:
    """A hash for each pair of the least values of the word triples under three
    orders.  Near copies have two of the three in common, and so a pair; texts
    that only share a passage seldom have."""
    import xxhash
    if len(words) < 3:
        return [xxhash.xxh64_intdigest(" ".join(words)) >> 1]
    h = np.fromiter((xxhash.xxh64_intdigest(f"{a} {b} {c}") for a, b, c in zip(words, words[1:], words[2:])), dtype=np.uint64, count=len(words) - 2)
    least = [int((h * np.uint64(2 * k + 0x9E3779B97F4A7C15)).min()) for k in range(3)]
    return [xxhash.xxh64_intdigest(f"{k} {least[k]} {least[k - 1]}") >> 1 for k in range(3)]


def _labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_rows: int, evidence_rows: int) -> DataFrame:
    """(key, y, text, picked) of labelled rows that are not held out, without
    near copies of a row of the same label and smaller key, from a written table.

    A pseudo-random sample of about ``evidence_rows`` labels a class (all, if
    fewer); ``picked`` marks about ``max_rows`` of them.  Labels, and the keys
    that stay, number at most about 2 x ``evidence_rows``: they are broadcast,
    and no text is shuffled.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("key")).agg(F.max(F.col(label).cast("int")).alias("y"))
             .where(F.crc32(F.col("key").cast("string")) % 5 != 0))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}

    def sampled(rows: int, seed: int):
        share = [min(1.0, rows / max(1, n.get(y, 0))) for y in (0, 1)]
        return F.when(F.col("y") == 1, hash_share(F.col("key"), share[1], seed)).otherwise(hash_share(F.col("key"), share[0], seed))
    # one seed: the smaller sample lies within the larger one
    known = known.where(sampled(evidence_rows, 3)).select("key", "y", sampled(max_rows, 3).alias("picked"))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("key"), F.col(text).alias("text")).join(F.broadcast(known), "key")

    def sketch():
        return lambda texts: [[_sketch(WORD.findall(t.lower())) for t in texts]]
    rows = written(with_python(rows, ["text"], sketch, [("pairs", T.ArrayType(T.LongType()))]), "toxic-labelled")
    pairs = rows.select("key", "y", F.explode("pairs").alias("pair"))
    least = pairs.groupBy("pair", "y").agg(F.min("key").alias("least"))
    first = (pairs.join(least, ["pair", "y"]).groupBy("key").agg(F.max(F.col("least") < F.col("key")).alias("copy"))
             .where("not copy").select("key"))
    return rows.join(F.broadcast(written(first, "toxic-keys")), "key").select("key", "y", "text", "picked")


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (text, y) -> (term, y, n), documents that hold the term."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    terms_of: dict[str, tuple[str, ...]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for y, got in enumerate(counts):
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([y] * len(got), pa.int32()), pa.array(list(got.values()), pa.int64())],
                                                 names=["term", "y", "n"])
                got.clear()
        terms_of.clear()

    for b in batches:
        for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            terms: set[str] = set()
            for w in set(WORD.findall(t.lower())):
                if w not in terms_of:
                    if len(terms_of) >= HELD_WORDS:
                        terms_of.clear()
                    terms_of[w] = tuple(_terms([w]))
                terms.update(terms_of[w])
            counts[y].update(terms)
            if len(counts[0]) + len(counts[1]) > HELD_TERMS:
                yield from out()
    yield from out()


def log_odds(c1: int, c0: int, n1: int, n0: int) -> float:
    return math.log(((c1 + 0.1) / (n1 + 1)) / ((c0 + 0.5) / (n0 + 1)))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          max_rows: int = 4000, min_docs: int = 5, evidence_rows: int = 100_000) -> Model:
    """Lexicon from about ``evidence_rows`` labelled rows of each class that are
    not held out (all, if fewer); weights of misspellings and the regression
    from about ``max_rows`` of each class."""
    rows = _labelled(docs, labels, doc_id, text, label, max_rows, evidence_rows)
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if n1 < min_docs or not n0:
        share = n1 / (n1 + n0) if n1 + n0 else 0.0
        return Model(intercept=math.log(share / (1 - share)) if 0 < share < 1 else 20.0 if share == 1 else -20.0)
    # evidence of every term over all rows, counted and judged in Spark
    many = (rows.select("text", "y").mapInArrow(_term_counts, "term string, y int, n long").groupBy("term")
            .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("c1"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c0")))
    strong = {r["term"]: (r["c1"], r["c0"]) for r in many.where(
        (F.col("c1") >= min_docs) & (F.col("c1") * F.lit(float(n0)) > F.lit(LIFT * n1) * (F.col("c0") + 0.5))).collect()}  # the lexicon's terms
    model = Model(terms=choose({t: c for t, (c, _) in strong.items()}))
    sample = rows.where("picked")
    s = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    s1, s0 = s.get(1, 0), s.get(0, 0)

    def catch(texts_y: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, got = Lexicon(model.terms), Counter()
        for b in texts_y:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen = {h for w in set(WORD.findall(t.lower())) for h in lexicon.match(w)}
                # a misspelling explains a toxic row only where no term stands as it is
                exact = y == 1 and any(d == 0 for _, d in seen)
                got.update((k, d, y) for k, d in seen if d == 0 or not exact)
        rows = [(k, d, y, c) for (k, d, y), c in got.items()]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (zip(*rows) if rows else ([],) * 4)], names=["k", "d", "y", "n"])

    seen: dict[tuple[int, int], list[int]] = {}
    if model.terms:
        caught = sample.select("text", "y").mapInArrow(catch, "k long, d long, y long, n long")
        for r in caught.groupBy("k", "d", "y").agg(F.sum("n").alias("n")).collect():
            seen.setdefault((r["k"], r["d"]), [0, 0])[r["y"]] = r["n"]
    for k, term in enumerate(model.terms):
        c1, c0 = strong[term]
        own = model.weights[k, 0] = min(max(log_odds(c1, c0, n1, n0), 0.0), 8.0)
        for d in range(1, allowed_edits(term) + 1):
            if (k, d) in seen:
                odds = log_odds(seen[k, d][1], seen[k, d][0], s1, s0)
                if odds > math.log(3):
                    model.weights[k, d] = min(odds, 8.0)
            else:  # misspellings that the sample does not hold count somewhat less than the term
                model.weights[k, d] = own * 0.8 ** d

    def measured():
        scorer = Scorer(model)
        return lambda texts: [[scorer.features(t) for t in texts]]
    rows = with_python(sample.select("text", "y"), ["text"], measured, [("x", T.ArrayType(T.DoubleType()))]).select("x", "y").collect()
    x, y = np.array([r["x"] for r in rows]).reshape(-1, N_FEATURES), np.array([r["y"] for r in rows], dtype=float)
    coef, model.intercept = fit_logistic(x, y, l2=0.5, steps=800)
    model.coef = coef.tolist()
    return model


def choose(strong: dict[str, int]) -> list[str]:
    """The lexicon of terms with their toxic rows: without the beginnings and
    words that another chosen term already covers.  In order of the alphabet."""
    words = {t for t in strong if not t.endswith("*")}
    out: list[str] = []
    stems = sorted((t for t in strong if t.endswith("*")), key=lambda t: (len(t), t))
    covered: set[str] = set()
    at = sorted(strong)  # terms of one beginning stand together
    for stem in stems:
        if any(stem[:k] in covered for k in PREFIXES if k < len(stem)):
            continue
        start = stem[:-1]
        kin = at[bisect_left(at, start):bisect_left(at, start + chr(0x10FFFF))]
        # the longest beginning, or the word, that keeps nearly all of its rows
        reach, best = strong[stem], stem
        for longer in sorted((t for t in kin if t.endswith("*")), key=lambda t: (len(t), t)):
            if strong[longer] >= 0.95 * reach and len(longer) > len(best):
                best = longer
        whole = [w for w in kin if w in words and strong[w] >= 0.9 * reach]
        out.append(max(whole, key=lambda w: (strong[w], w)) if whole else best)
        covered.add(start)
    out += [w for w in words if not any(w[:k] in covered for k in PREFIXES)]
    return sorted(set(out))


# --------------------------------------------------------------- scoring ----
def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score column ``out``: one pass, no shuffle."""
    def make():
        scorer = Scorer(model)
        return lambda texts: [scorer.score(texts)]
    return with_python(docs, [text], make, [(out, T.DoubleType())])


def keep_clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns."""
    (name,) = fresh(docs, "_toxicity")
    model = learn(docs, labels, doc_id, text)
    return score(docs, model, text, name).where(F.col(name) < threshold).drop(name)
