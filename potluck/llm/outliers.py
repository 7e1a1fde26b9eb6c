"""Quality rules with robust multivariate outliers; DataFrame functions only.

Each text gets word, symbol, duplicate-line and repetition counts and two base
rules.  Texts that pass them have a vector of five transformed statistics, and
per language and source a minimum-covariance-determinant estimate says what is
usual there: the mean and covariance of the tightest share of the rows.  A
document is rejected if its Mahalanobis distance from them is too great.

The estimate follows the concentration steps of the published algorithm, from
two starts (medians with absolute deviations; plain moments):

* one pass gives, per group and start, the moments of the rows in fine
  classes of their distance (partial aggregation: a hot source is one partial
  row per task and class);
* the classes up to the wanted share form the subset, its moments the next
  estimate; steps repeat a fixed number of times;
* the start with the smaller determinant wins, scaled for consistency with
  the normal distribution.

Groups with fewer than ``least_rows`` documents that pass the base rules are
held against the estimate of all such documents of their language, and if
these are too few, of the whole table.  Each row is dealt once to all groups
it counts for (its own, its language if that has a small group, the table if
that has a small language), so the same steps serve all levels at once.

Repetition is measured against the length plus ``SHORT`` words: one line said
twice is usual in a short text, half of a long one repeated is not.

Defined cases: a null text is one without words; null language or source is a
group value of its own; a table with fewer than ``least_rows`` documents that
pass the base rules rejects nothing more; repeated rows count as often as they
occur; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from potluck.llm.common import written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Rows of a group are dealt to so many tasks wherever they meet their group's estimate.
SALTS = 64
#: Smallest standard deviations of the statistics: finer differences are not outlying.
FLOORS = (0.35, 0.15, 0.25, 0.2, 0.075)
#: Words without repetition that every text is credited with.
SHORT = 150
P = len(FLOORS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once and bound to a name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text holds twice or more."""
    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(places, k - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))

    def places(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def from_windows(h: Column) -> Column:
        some = let(F.array_sort(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i")))), lambda o: let(places(o), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(some)

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(hashes, from_windows))

    return let(words, windows)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
               least_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """Counts and base rules of every row, and its group."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
        let(words_of(body), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(body).alias("n_dup_lines"))
    n, r = F.col("w.n"), F.col("w.r")
    return counted.select("doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                          r.alias("n_repeat_words"), ((n < least_words) | (100 * r > repeat_percent * n)).alias("base_failed"))


def vector() -> list[Column]:
    """The transformed statistics of a row that passed the base rules."""
    n, c = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [F.log(n), F.log(c / n) * 2, F.log1p(100 * F.col("n_symbols") / c), F.log1p(F.col("n_dup_lines")) / F.log1p(F.sqrt(n)),
            F.sqrt(F.col("n_repeat_words") / (n + SHORT))]


# ------------------------------------------------------- chi-square values --
def chi2_cdf(x: float, df: int) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    a, h = df / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= h / k
        total += term
    return min(1.0, total * math.exp(-h + a * math.log(h) - math.lgamma(a)))


def chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 10.0 * df + 200
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < p else (lo, mid)
    return hi


# ------------------------------------------------------------ the estimate --
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _cholesky(estimates: DataFrame, keep: list[str]) -> DataFrame:
    """m0.. and lower-triangular l00.. from means m* and covariances c*."""
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
        estimates = estimates.withColumn(f"l{i}{j}", value)
    det = F.lit(0.0)
    for i in range(P):
        det = det + F.log(F.col(f"l{i}{i}"))
    return estimates.select(*keep, *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS], det.alias("det"))


def _distance(rows: DataFrame, out: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    total = F.lit(0.0)
    for i in range(P):
        rest = F.col(f"z{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return rows.withColumn(out, total)


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"z{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}{j}") for i, j in PAIRS]]


def _means(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Means and floored covariances from summed moments."""
    means = sums.select(*keys, "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS])
    return means.select(*keys, *[f"m{i}" for i in range(P)],
                        *[(F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
                          for i, j in PAIRS])


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` (with a salt) joined with their group's columns.  The group table
    is repeated once a salt, so that no task has to take a whole group."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, [*keys, "salt"], how)


def salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int").alias("salt")


def estimate(rows: DataFrame, keys: list[str], share: float = 0.75, steps: int = 3, least_rows: int = 20) -> DataFrame:
    """keys, means, Cholesky factor of each group's covariance estimate, for
    groups of ``least_rows`` rows or more.

    ``rows``: a written table of keys (not null), salt and z0, z1, ...
    """
    # start 0: medians and absolute deviations; start 1: plain moments
    mid = written(rows.groupBy(*keys).agg(*[F.percentile_approx(f"z{i}", 0.5, 1000).alias(f"m{i}") for i in range(P)]), "mcd-medians")
    spread = with_group(rows, mid, keys).groupBy(*keys).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(f"z{i}") - F.col(f"m{i}")), 0.5, 1000).alias(f"a{i}") for i in range(P)])
    robust = spread.select(*keys, F.lit(0).alias("start"), *[f"m{i}" for i in range(P)],
                           *[(F.pow(F.col(f"a{i}") * 1.4826, 2) + F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    plain = _means(rows.groupBy(*keys).agg(*_moments()), keys).select(
        *keys, F.lit(1).alias("start"), *[f"m{i}" for i in range(P)], *[f"c{i}{j}" for i, j in PAIRS])
    now = written(_cholesky(robust.unionByName(plain), [*keys, "start"]), "mcd-start")
    own = [*keys, "start"]
    for step in range(steps):
        far = _distance(with_group(rows, now, keys), "d2")
        classes = (far.withColumn("class", F.floor(F.log2(F.col("d2") + F.lit(1e-6)) * 16).cast("int"))
                   .groupBy(*own, "class").agg(*_moments()))
        upto = Window.partitionBy(*own).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
        inner = (classes.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
                 .withColumn("all", F.sum("n").over(Window.partitionBy(*own)))
                 .where(F.col("before") < F.lit(share) * F.col("all")))
        sums = inner.groupBy(*own).agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(P)],
                                       *[F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i, j in PAIRS])
        now = written(_cholesky(_means(sums, own), own), f"mcd-{step}")
    best = Window.partitionBy(*keys).orderBy("det", "start")
    enough = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least_rows)
    return (now.withColumn("_best", F.row_number().over(best)).where("_best = 1").drop("_best", "start", "det")
            .join(enough, keys).drop("_rows"))


def _levels(passed: DataFrame, keys: list[str], least_rows: int) -> DataFrame:
    """A written table: per language and source the groups its rows count for,
    and the group that judges them (null: none is large enough)."""
    lang = keys[0]
    own = passed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    langs = own.groupBy(F.col(lang).alias("l")).agg(F.sum("n").alias("ln"), F.min("n").alias("least"))
    table = langs.agg(F.sum("ln").alias("tn"), F.min(F.when(F.col("least") < least_rows, F.col("ln"))).alias("few"))
    name = F.concat(F.lit("source "), F.to_json(F.struct(*keys)))
    in_lang, in_all = F.concat(F.lit("language "), F.col(lang)), F.lit("all")
    large, large_lang, large_all = F.col("n") >= least_rows, F.col("ln") >= least_rows, F.col("tn") >= least_rows
    facts = own.join(langs, F.col(lang) == F.col("l")).select("*", table.select(F.struct("tn", "few")).scalar().alias("t")).select("*", "t.*")
    return written(facts.select(
        *keys,
        F.array_compact(F.array(F.when(large, name), F.when(large_lang & (F.col("least") < least_rows), in_lang),
                                F.when(large_all & (F.col("few") < least_rows), in_all))).alias("groups"),
        F.when(large, name).when(large_lang, in_lang).when(large_all, in_all).alias("judge")), "quality-levels")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          share: float = 0.75, steps: int = 3, tail: float = 1e-6, least_rows: int = 20) -> DataFrame:
    """The statistics of every row with base_failed, distance2 and kept.

    ``share``: part of a group that the estimate rests on; ``tail``: chance of
    a normal row to be rejected.
    """
    stats = written(statistics(docs, doc_id, text, lang, source), "quality-statistics")
    keys = ["g_lang", "g_source"]
    group = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")).alias(k) for c, k in zip(("lang", "source"), keys)]
    spread = salt("doc_id", "n_words", "word_chars", "n_symbols")
    wide = share / chi2_cdf(chi2_quantile(share, P), P + 2)  # makes the tight share's covariance that of all
    limit = chi2_quantile(1 - tail, P) * wide
    marked = stats.select(*stats.columns, *group, spread, *[F.when(~F.col("base_failed"), z).alias(f"z{i}") for i, z in enumerate(vector())])
    passed = marked.where("not base_failed")
    levels = _levels(passed, keys, least_rows)
    dealt = with_group(passed.select(*keys, "salt", *[f"z{i}" for i in range(P)]), levels.drop("judge"), keys)
    usual = estimate(written(dealt.select(F.explode("groups").alias("g"), "salt", *[f"z{i}" for i in range(P)]), "quality-groups"),
                     ["g"], share, steps, least_rows)
    marked = with_group(marked, levels.select(*keys, F.col("judge").alias("g")), keys, "left")
    marked = with_group(marked, usual, ["g"], "left")
    far = _distance(marked, "d2")
    return far.select(*stats.columns, (F.col("d2") / F.lit(wide)).alias("distance2"),
                      (~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= F.lit(limit)))).alias("kept"))
