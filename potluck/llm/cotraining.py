"""Quality classifier by co-training of two views of a page.

* text view: what the text says, hashed byte trigrams of the whole text and
  how much of it repeats;
* metadata view: what is known about the page without reading it, its source,
  language, length and layout (lines, shares of character classes).

Each view has a logistic classifier.  Over some rounds each gives the
documents of an unlabelled pool of which it is surest to the other as
pseudo-labels; then both are calibrated on labelled rows kept aside, and a
logistic combination of the calibrated views scores every document.

Fitting uses a bounded sample: at most about ``max_rows`` labelled rows of
each class and ``pool_rows`` unlabelled rows (parameters), whose feature
vectors, not texts, come to the driver.  Rows with crc32(doc_id) mod 5 = 0 are
never learned from; of rows that repeat an id one is.  Scoring is one pass over whole texts without a shuffle.

Defined cases: null and empty texts have zero text features and are scored by
the same formula; null source, lang or length are values of their own; with
labels of one class only every score is 1 or 0, without labels 1 (nothing is
rejected); a document with several labels has the best; tied pseudo-labels go
by pool order; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.llm.common import fit_logistic, fresh, hash_share, labelled_sample, with_python

TEXT_DIM = 1024
#: A text of so many bytes has half the weight of a long one in the trigram shares.
SHORT = 300
#: How much the two repetition shares weigh beside one trigram share.
REPETITION = 12.0
SOURCE_DIM, LANG_DIM = 32, 16
#: Classes of bytes whose shares describe a page's layout.
CLASSES = ("upper", "lower", "digit", "space", "newline", "high", "mark", "stop")
META_DIM = SOURCE_DIM + LANG_DIM + 4 + len(CLASSES)


def _class_of() -> np.ndarray:
    kind = np.full(256, CLASSES.index("mark"))
    kind[128:] = CLASSES.index("high")
    for lo, hi, name in (("A", "Z", "upper"), ("a", "z", "lower"), ("0", "9", "digit")):
        kind[ord(lo):ord(hi) + 1] = CLASSES.index(name)
    kind[[9, 11, 12, 13, 32]] = CLASSES.index("space")
    kind[10] = CLASSES.index("newline")
    kind[[ord(c) for c in ".,;:?'\"()-"]] = CLASSES.index("stop")
    return kind


CLASS_OF = _class_of()


def text_view(text: str | None) -> np.ndarray:
    """Square roots of hashed trigram shares (less for short texts, which say
    little), then two repetition shares."""
    out = np.zeros(TEXT_DIM + 2, dtype=np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if len(raw) >= 3:
        counts = np.zeros(TEXT_DIM, dtype=np.int64)
        for at in range(0, len(raw) - 2, 1 << 20):  # bounded memory for very long texts
            b = np.frombuffer(raw[at:at + (1 << 20) + 2], dtype=np.uint8).astype(np.uint32)
            code = (b[:-2] * np.uint32(40503) + b[1:-1] * np.uint32(30011) + b[2:] * np.uint32(9176471)) >> np.uint32(4)
            counts += np.bincount(code & np.uint32(TEXT_DIM - 1), minlength=TEXT_DIM)
        out[:TEXT_DIM] = np.sqrt(counts / (counts.sum() + SHORT))
    words = raw.split()
    if words:
        out[TEXT_DIM] = 1.0 - len(set(words)) / len(words)
        out[TEXT_DIM + 1] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    return out


def meta_view(text: str | None, source, lang, n_chars) -> np.ndarray:
    """Hashed source and language, log lengths, shares of character classes."""
    out = np.zeros(META_DIM, dtype=np.float32)
    out[xxhash.xxh32_intdigest(f"s{source}") % SOURCE_DIM] = 1.0
    out[SOURCE_DIM + xxhash.xxh32_intdigest(f"l{lang}") % LANG_DIM] = 1.0
    raw = (text or "").encode("utf-8", "surrogatepass")
    at = SOURCE_DIM + LANG_DIM
    lines = raw.count(b"\n") + 1
    out[at] = np.log1p(max(0, n_chars or 0)) / 10
    out[at + 1] = np.log1p(lines) / 10
    out[at + 2] = np.log1p(len(raw) / lines) / 10
    out[at + 3] = float(n_chars is None)
    if raw:
        counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        out[at + 4:] = np.sqrt(np.bincount(CLASS_OF, weights=counts, minlength=len(CLASSES)) / len(raw))
    return out


@dataclass
class View:
    """A standardised logistic classifier and its calibration (slope, shift)."""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    coef: np.ndarray | None = None
    shift: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, steps: int) -> View:
        self.mean = x.mean(axis=0)
        self.scale = 1.0 / np.sqrt(x.var(axis=0) + 1e-4)
        if x.shape[1] == TEXT_DIM + 2:
            self.scale[TEXT_DIM:] *= REPETITION
        self.scale *= 4.0 / max(1e-9, float(np.linalg.norm((x - self.mean) * self.scale, axis=1).mean()))
        self.coef, self.shift = fit_logistic((x - self.mean) * self.scale, y, weight, l2=l2, steps=steps)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) * self.scale @ self.coef + self.shift


@dataclass
class Model:
    text: View | None = None
    meta: View | None = None
    mix: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])  # text, meta, intercept
    calibrated: list[list[float]] = field(default_factory=lambda: [[1.0, 0.0], [1.0, 0.0]])
    constant: float | None = None

    def scores(self, x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(combined, text view, metadata view), each a calibrated probability."""
        if self.constant is not None:
            return (np.full(len(x), self.constant),) * 3
        t = self.calibrated[0][0] * self.text.logit(x) + self.calibrated[0][1]
        m = self.calibrated[1][0] * self.meta.logit(z) + self.calibrated[1][1]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (self.mix[0] * t + self.mix[1] * m + self.mix[2], t, m))


def co_train(x, z, y, aside, weight, pool_x, pool_z, rounds: int = 3, per_round: int = 200, sure: float = 0.95) -> Model:
    """Both views on labelled rows (``aside``: kept for calibration) and a pool."""
    use = ~aside
    free = [np.arange(len(pool_x)), np.arange(len(pool_x))]
    gained: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, int), np.empty(0)), (np.empty(0, int), np.empty(0))]
    own, pools = (x, z), (pool_x, pool_z)
    views = [View(), View()]
    for k in range(rounds + 1):
        for v in (0, 1):
            rows, labels = gained[v]
            views[v] = View().fit(np.concatenate([own[v][use], pools[v][rows]]), np.concatenate([y[use], labels]),
                                  np.concatenate([weight[use], np.full(len(rows), 0.5)]), l2=0.05, steps=250)
        if k == rounds:
            break
        for v in (0, 1):  # what view v is sure of becomes training data of the other
            other = 1 - v
            p = 1 / (1 + np.exp(-np.clip(views[v].logit(pools[v][free[other]]), -30, 30)))
            order = np.argsort(-p, kind="stable")
            good = order[:per_round][p[order[:per_round]] >= sure]
            low = order[::-1][:per_round]
            bad = low[p[low] <= 1 - sure]
            if not len(good) or not len(bad):
                continue  # one class alone would only shift the intercept
            some = np.concatenate([good, bad])
            gained[other] = (np.concatenate([gained[other][0], free[other][some]]),
                             np.concatenate([gained[other][1], np.repeat([1.0, 0.0], [len(good), len(bad)])]))
            free[other] = np.delete(free[other], some)
    model = Model(text=views[0], meta=views[1])
    logits = np.stack([views[0].logit(x[aside]), views[1].logit(z[aside])], axis=1)
    ya, wa = y[aside], weight[aside]
    for v in (0, 1):
        slope, shift = fit_logistic(logits[:, v:v + 1], ya, wa, l2=0.1, steps=800)
        model.calibrated[v] = [float(slope[0]), shift]
    both = logits * [model.calibrated[0][0], model.calibrated[1][0]] + [model.calibrated[0][1], model.calibrated[1][1]]
    mix, shift = fit_logistic(both, ya, wa, l2=0.1, steps=800)
    model.mix = [float(mix[0]), float(mix[1]), shift]
    return model


def _featured(df: DataFrame) -> DataFrame:
    """(text, source, lang, n_chars) -> both views as bytes of float16."""
    def make():
        def run(texts, sources, langs, sizes):
            rows = list(zip(texts, sources, langs, sizes))
            return [[text_view(r[0]).astype(np.float16).tobytes() for r in rows],
                    [meta_view(*r).astype(np.float16).tobytes() for r in rows]]
        return run
    return with_python(df, ["text", "source", "lang", "n_chars"], make, [("x", T.BinaryType()), ("z", T.BinaryType())])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", max_rows: int = 3000,
          pool_rows: int = 3000, rounds: int = 3, columns: dict[str, str] | None = None) -> Model:
    """Co-train on the bounded sample; ``columns`` names text, source, lang, n_chars."""
    columns = columns or {c: c for c in ("text", "source", "lang", "n_chars")}
    sample, n = labelled_sample(docs, labels, doc_id, label, columns, max_rows)
    if not n[0] or not n[1]:
        return Model(constant=0.0 if n[0] else 1.0)
    got = _featured(sample).select("key", "y", "x", "z").dropDuplicates(["key"]).collect()
    total = docs.count()
    bare = docs.select(F.col(doc_id).alias("key"), *[F.col(o).alias(c) for c, o in columns.items()])
    pool = bare.where(hash_share(F.col("key"), min(1.0, pool_rows / max(1, total)), 11) & (F.crc32(F.col("key").cast("string")) % 5 != 0))
    free = _featured(pool).select("x", "z", "key").dropDuplicates(["key"]).collect()
    unpack = lambda rows, c, d: np.array([np.frombuffer(r[c], np.float16) for r in rows], dtype=np.float64).reshape(-1, d)
    got.sort(key=lambda r: r["key"])
    free.sort(key=lambda r: r["key"])
    y = np.array([r["y"] for r in got], dtype=float)
    seen = max(1, len(got))
    rate = {c: (n[c] / (n[0] + n[1])) / max(1e-9, (y == c).sum() / seen) for c in (0, 1)}
    weight = np.where(y == 1, rate[1], rate[0])  # the classes are sampled apart: restores their shares
    aside = np.array([xxhash.xxh32_intdigest(f"aside{r['key']}") % 4 == 0 for r in got], dtype=bool)
    if min(((y == c) & part).sum() for c in (0, 1) for part in (aside, ~aside)) == 0:
        aside = np.ones(seen, dtype=bool)  # too few rows to keep any aside: calibrate on the fitted ones
        return _tiny(got, unpack, y, weight)
    return co_train(unpack(got, "x", TEXT_DIM + 2), unpack(got, "z", META_DIM), y, aside, weight,
                    unpack(free, "x", TEXT_DIM + 2), unpack(free, "z", META_DIM), rounds)


def _tiny(got, unpack, y, weight) -> Model:
    if len(set(y.tolist())) < 2:
        return Model(constant=float(y[0]) if len(y) else 1.0)
    x, z = unpack(got, "x", TEXT_DIM + 2), unpack(got, "z", META_DIM)
    both = co_train(np.concatenate([x, x]), np.concatenate([z, z]), np.concatenate([y, y]),
                    np.repeat([False, True], len(y)), np.concatenate([weight, weight]), x[:0], z[:0], 0)
    return both


def score(docs: DataFrame, model: Model, columns: dict[str, str] | None = None, names: tuple[str, str, str] = (
        "score", "text_score", "meta_score")) -> DataFrame:
    """``docs`` with the combined score and the two calibrated views."""
    c = columns or {k: k for k in ("text", "source", "lang", "n_chars")}

    def make():
        def run(texts, sources, langs, sizes):
            if not texts:
                return [[], [], []]
            x = np.stack([text_view(t) for t in texts])
            z = np.stack([meta_view(*r) for r in zip(texts, sources, langs, sizes)])
            return list(model.scores(x, z))
        return run
    return with_python(docs, [c["text"], c["source"], c["lang"], c["n_chars"]], make, [(n, T.DoubleType()) for n in names])


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """The rows whose combined score reaches ``threshold``, with all their columns."""
    names = tuple(fresh(docs, "_quality", "_quality_text", "_quality_meta"))
    model = learn(docs, labels, doc_id)
    return score(docs, model, names=names).where(F.col(names[0]) >= threshold).drop(*names)
