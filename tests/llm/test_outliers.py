"""Quality rules by brute force; the estimate against a direct numpy version."""
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from potluck.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def random_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        vocab = ["a", "b|", "c#", "dé", "🙂"][:rng.randint(1, 5)] + [f"w{i}" for i in range(rng.choice([0, 3, 30, 500]))]
        out.append("".join(rng.choice(vocab) + rng.choice([" ", " ", "  ", "\n", "\t", "\x0b", " \n\n", "\xa0", "\x85"]) for _ in range(rng.randint(0, 120))))
    return out


def test_statistics(make_docs):
    texts = random_texts(250, 1) + ["", None, "\n\n", "x", "x y", "x y z", "x y z x y z", "a a a a", " a\nb\r\nb\r\n"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
           for r in outliers.statistics(make_docs(rows, extra=("w", "n"))).collect()}
    for i, t in rows:
        assert got[i] == slow(t), repr(t)


def numpy_mcd(z, share=0.75, steps=3):
    floors = np.diag(np.square(outliers.FLOORS))

    def moments(x):
        return x.mean(axis=0), np.cov(x.T, bias=True) + floors
    med = np.array([np.sort(c)[math.ceil(len(c) / 2) - 1] for c in z.T])
    dev = np.array([np.sort(np.abs(c - m))[math.ceil(len(c) / 2) - 1] for c, m in zip(z.T, med)])
    best = None
    for m, c in ((med, np.diag((dev * 1.4826) ** 2) + floors), moments(z)):
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(c), z - m)
            cls = np.floor(np.log2(d + 1e-6) * 16)
            order = np.sort(cls)
            top = order[min(len(z) - 1, math.ceil(share * len(z)) - 1)]
            m, c = moments(z[cls <= top])
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0]:
            best = (det, m, c)
    return np.einsum("ij,jk,ik->i", z - best[1], np.linalg.inv(best[2]), z - best[1])


def english(rng, n):
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_estimate_and_verdicts(make_docs):
    rng = random.Random(3)
    rows = [(i, english(rng, rng.randint(60, 400)), "en" if i % 2 else None, "s1" if i % 3 else "s2") for i in range(240)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in english(rng, 120).split()), "en", "s1") for i in range(12)]
    rows = [(*r, len(r[1])) for r in rows + junk]
    got = {r["doc_id"]: r for r in outliers.judge(make_docs(rows)).collect()}
    assert all(got[r[0]]["kept"] for r in rows[:240]) and not any(got[r[0]]["kept"] for r in rows[240:])
    wide = 0.75 / outliers.chi2_cdf(outliers.chi2_quantile(0.75, 5), 7)
    for group in (("en", "s1"), (None, "s2")):
        mine = [r for r in rows if (r[2], r[3]) == group]
        z = []
        for r in mine:
            n, c, s, d, p, _ = slow(r[1])
            z.append([math.log(n), 2 * math.log(c / n), math.log1p(100 * s / c), math.log1p(d) / math.log1p(math.sqrt(n)), math.sqrt(p / (n + 150))])
        want = numpy_mcd(np.array(z)) / wide
        assert np.allclose([got[r[0]]["distance2"] for r in mine], want, rtol=1e-6)


def test_small_groups_are_judged_by_language_then_all_rows(make_docs):
    rng = random.Random(5)
    rows = [(i, english(rng, rng.randint(60, 400)), "en", f"s{i % 20}") for i in range(60)]     # 3 rows a group
    rows += [(100 + i, english(rng, rng.randint(60, 400)), "fi", "t") for i in range(5)]        # a small language
    junk = [(1000 + i, " ".join(w + "%%%" for w in english(rng, 120).split()), lang, "s1") for i, lang in enumerate(("en", "en", "fi", None))]
    got = {r["doc_id"]: r for r in outliers.judge(make_docs([(*r, len(r[1])) for r in rows + junk])).collect()}
    assert len(got) == 69 and all(r["distance2"] is not None for r in got.values())
    assert all(got[r[0]]["kept"] for r in rows) and not any(got[r[0]]["kept"] for r in junk)


def test_half_repeated_texts_go_and_clean_ones_stay(make_docs):
    """Long texts that repeat a passage or lines are outliers; one line said twice in a short text is not."""
    rng = random.Random(11)
    rows = [(i, english(rng, rng.randint(60, 500)), "en", f"s{i % 4}") for i in range(400)]
    for i in range(400, 440):  # short, one line of 13 words twice
        line = english(rng, 13)
        rows.append((i, "\n".join([english(rng, 20), line, english(rng, 20), line, english(rng, rng.randint(0, 60))]), "en", f"s{i % 4}"))
    bad = []
    for i in range(10):
        passage = english(rng, 40)
        bad.append((1000 + i, " ".join([english(rng, 42), *[f"{passage} {english(rng, 42)}" for _ in range(4)], passage]), "en", f"s{i % 4}"))
    for i in range(10):
        lines = [english(rng, 7) for _ in range(20)]
        bad.append((2000 + i, "\n".join(lines + lines[:19] + [english(rng, 30)]), "en", f"s{i % 4}"))
    got = {r["doc_id"]: r for r in outliers.judge(make_docs([(*r, len(r[1])) for r in rows + bad])).collect()}
    assert not any(got[r[0]]["base_failed"] for r in bad[:10])
    assert all(got[r[0]]["kept"] for r in rows)
    assert not any(got[r[0]]["kept"] for r in bad)


def test_every_row_is_dealt_to_the_groups_it_counts_for(spark):
    keys = ["g_lang", "g_source"]
    rows = [("=en", "=a")] * 25 + [("=en", "=b")] * 3 + [("=fr", "=a")] * 30 + [("=fi", "=a")] * 2
    got = {(r["g_lang"], r["g_source"]): (r["groups"], r["judge"]) for r in outliers._levels(spark.createDataFrame(rows, keys), keys, 20).collect()}
    assert got["=fr", "=a"][0] == ['source {"g_lang":"=fr","g_source":"=a"}', "all"]  # no small group in its language
    assert got["=en", "=a"][0] == ['source {"g_lang":"=en","g_source":"=a"}', "language =en", "all"]
    assert got["=en", "=b"] == (["language =en", "all"], "language =en")
    assert got["=fi", "=a"] == (["all"], "all")
    few = outliers._levels(spark.createDataFrame(rows[-2:], keys), keys, 20).first()
    assert few["groups"] == [] and few["judge"] is None


def test_chi_square_values():
    assert abs(outliers.chi2_quantile(0.95, 5) - 11.0705) < 1e-3
    assert abs(outliers.chi2_quantile(0.5, 2) - 2 * math.log(2)) < 1e-6


def test_edge_cases(edge_docs, no_docs):
    got = outliers.judge(edge_docs).collect()
    assert len(got) == 11 and not any(r["kept"] for r in got if (r["n_words"] or 0) < 50)
    assert outliers.judge(no_docs).count() == 0


def test_no_python_in_the_plan(edge_docs):
    plan = outliers.judge(edge_docs.select("doc_id", "text", F.col("lang"), "source"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan
