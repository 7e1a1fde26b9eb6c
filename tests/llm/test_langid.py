"""Language by pieces: segmentations enumerated, expected counts, held-out rows."""
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from potluck.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")
MARK = langid.MARK


def segmentations(text, pieces):
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        if text[:k] in pieces:
            for rest in segmentations(text[k:], pieces):
                yield [pieces[text[:k]], *rest]


@pytest.fixture(scope="module")
def small():
    names = [MARK, "a", "b", "ab", "ba", MARK + "a", MARK + "ab", "aba", "x" + MARK] + [""] * 256
    return langid.Pieces(names, list(range(9, 265)))


def test_values_are_sums_over_all_segmentations(small):
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(265), size=3).T
    words = ["a", "ab", "abab", "bbaab", "aba" * 5, "", "c", "aéb", "b🙂"]
    known = {t: i for i, t in enumerate([MARK, "a", "b", "ab", "ba", MARK + "a", MARK + "ab", "aba"])}
    got = langid.Lattice(small, words).values(np.log(p))
    for w, row in zip(words, got):
        strange = {c: k for k, c in enumerate(c for c in dict.fromkeys(w) if c not in "ab")}
        pieces = {**known, **{c: 1000 + k for c, k in strange.items()}}
        of = lambda i, l: p[i, l] if i < 1000 else math.prod(p[9 + b, l] for b in [c for c, k in strange.items() if k == i - 1000][0].encode())
        for l in range(3):
            want = sum(math.prod(of(i, l) for i in s) for s in segmentations(MARK + w, pieces))
            assert row[l] == pytest.approx(math.log(want), abs=1e-9)


def test_expected_counts_are_posteriors(small):
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(265), size=2).T
    words, column, times = ["abab", "ba", "aé", "abab"], np.array([0, 1, 1, 1]), np.array([3.0, 1.0, 2.0, 5.0])
    got = langid.Lattice(small, words).expected(np.log(p), column, times)
    want = np.zeros_like(p)
    known = {t: i for i, t in enumerate([MARK, "a", "b", "ab", "ba", MARK + "a", MARK + "ab", "aba"])}
    for w, l, n in zip(words, column, times):
        ways = []
        for s in segmentations(MARK + w, {**known, "é": -1}):
            ids = [k for i in s for k in ([9 + b for b in "é".encode()] if i < 0 else [i])]
            ways.append((math.prod(p[i, l] for i in ids), ids))
        total = sum(x for x, _ in ways)
        for x, ids in ways:
            for i in ids:
                want[i, l] += n * x / total
    assert got == pytest.approx(want, abs=1e-9)


def test_very_long_words_keep_their_value(small):
    p = np.full((265, 1), 1 / 265)
    got = langid.Lattice(small, ["ab" * 3000, "é" * 500]).values(np.log(p))
    assert np.isfinite(got).all() and got[0, 0] < -3000


def test_lookup_finds_the_pieces_of_the_file():
    pieces = langid.load(PATH)
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=PATH)
    text = MARK + "nation,étranger42"
    codes = np.array([ord(c) for c in text], dtype=np.uint32)
    got = {(int(s), n, int(i)) for n, at, ids in pieces.windows(codes, len(text) - np.arange(len(text))) for s, i in zip(at, ids)}
    want = set()
    for s in range(len(text)):
        for n in range(1, len(text) - s + 1):
            i = sp.piece_to_id(text[s:s + n])
            if not sp.is_unknown(i):
                want.add((s, n, i))
    assert got == want


def test_slices_give_the_same_words(monkeypatch):
    text = "One  two\tthree\n" * 200 + "x" * 300 + " end"
    whole = text.lower().split()
    monkeypatch.setattr(langid, "SLICE", 50)
    assert [w for some in langid.words(text) for w in some] == whole


def held_out(c="doc_id"):
    return F.crc32(F.col(c).cast("string")) % 4 == 2


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs, ~held_out(), PATH)
    assert model.languages == ["de", "en", "es", "fr"]
    assert np.exp(model.log_p).sum(axis=0) == pytest.approx(1.0)
    got = langid.predict(docs.withColumnRenamed("lang", "true"), model).where(held_out())
    row = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang_pred") == F.col("true")).alias("ok"),
                  F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert row["n"] > 200 and row["ok"] >= 0.99 * row["n"]
    assert 0 <= row["lo"] <= row["hi"] <= 1
    # full values table started anew all the time: same answers
    few = docs.limit(60)
    a = {r["doc_id"]: r["lang_pred"] for r in langid.predict(few, model).collect()}
    keep = langid.Values.__init__.__defaults__
    langid.Values.__init__.__defaults__ = (1,)
    try:
        assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(few, model).collect()} == a
    finally:
        langid.Values.__init__.__defaults__ = keep


def test_counts_cover_every_learned_row(spark, make_docs):
    """Repeated rows count each time; held-out rows and null languages not at all."""
    rows = [(1, "aaa bbb", "xx", "s", 1), (1, "aaa bbb", "xx", "s", 1), (2, "ccc", "yy", "s", 1), (3, "ddd", None, "s", 1), (4, None, "zz", "s", 1), (5, "12 34", "ww", "s", 1)]
    model = langid.learn(make_docs(rows), F.col("doc_id") < 10, PATH, rounds=1)
    assert model.languages == ["xx", "yy"]  # neither null, nor only null texts, nor texts without letters
    assert np.exp(model.log_prior) == pytest.approx([2 / 3, 1 / 3])
    assert langid.learn(make_docs(rows), F.lit(None).cast("boolean"), PATH).languages == []


def test_edge_cases(spark, edge_docs, no_docs, make_docs):
    train = make_docs([(k, t, l, "s", 1) for k, (t, l) in enumerate([("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr")] * 3)])
    model = langid.learn(train, F.lit(True), PATH)
    extra = edge_docs.withColumn("lang_pred", F.lit("clash")).withColumn("LANG_PRED2", F.lit("x"))
    got = langid.predict(extra, model).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(got) == edge_docs.count()
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters)
        assert (0 < r["score"] <= 1) if letters else r["score"] == 0
    assert langid.predict(no_docs, model).count() == 0
    none = langid.learn(no_docs, F.lit(True), PATH)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(train, none).collect()} == {("und", 0.0)}
    probe = langid.predict(make_docs([(1, "THE DOG"), (2, "la maison")]), model)
    assert {r["doc_id"]: r["lang_pred"] for r in probe.collect()} == {1: "en", 2: "fr"}
