"""Distributions: equal-width and fixed-edge histograms, Gaussian KDE, top
counts, vocabularies and duration bands (Q8-Q12, C5).

Scalars such as min/max are computed by one aggregate and attached to the
rows as a scalar subquery (evaluated once, its single row inlined into the
projection), so every value stays on its executor and no join is planned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potluck.operators.common import exact_quantiles, quantiles_wide, with_index


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The row is a scalar subquery (one struct value; null when the aggregate
    has no row), so the plan holds no join at all.
    """
    sub = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()
    return df.select("*", *[sub[c].alias(c) for c in one_row.columns])


def _values(df: DataFrame, col: str) -> DataFrame:
    v = F.col(col).cast("double")
    return df.select(v.alias("v")).where(v.isNotNull() & ~F.isnan(v))


# ---------------------------------------------------------------- Q8 --------
def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram over [min, max] with numpy's rule: bin i holds
    edge_i <= v < edge_{i+1}, the last bin is closed, empty bins are kept;
    edge_i = lo + i * (hi - lo) / bins.  If min == max the range is widened by
    0.5 on both sides.  Columns: bin, left, right, count.
    """
    vals = _values(df, col)
    rng = vals.agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"), F.count(F.lit(1)).alias("_n"))
    rng = rng.where(F.col("_n") > 0).select(
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"),
    ).withColumn("step", (F.col("hi") - F.col("lo")) / bins)

    def edge(k: Column) -> Column:
        return F.when(k == bins, F.col("hi")).otherwise(k * F.col("step") + F.col("lo"))

    j = attach_row(vals, rng)
    i0 = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    j = j.withColumn("_i0", i0)
    j = j.withColumn("_i1", F.when(F.col("v") < edge(F.col("_i0")), F.col("_i0") - 1).otherwise(F.col("_i0")))
    j = j.withColumn("bin", F.when((F.col("v") >= edge(F.col("_i1") + 1)) & (F.col("_i1") != bins - 1),
                                   F.col("_i1") + 1).otherwise(F.col("_i1")))
    counts = j.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select("lo", "hi", "step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    spine = spine.select("bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"))
    return (spine.join(counts, "bin", "left")
            .select("bin", "left", "right", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


# ---------------------------------------------------------------- Q9 --------
RATING_EDGES = [0.5, 1.5, 2.5, 3.5, 4.5, 5.5]


def histogram_edges(df: DataFrame, col: str, edges: Sequence[float] = RATING_EDGES) -> DataFrame:
    """Histogram with given increasing edges; values outside are dropped, the
    last bin is closed.  Columns: bin, left, right, count."""
    edges = [float(e) for e in edges]
    n = len(edges) - 1
    vals = _values(df, col).where(F.col("v").between(edges[0], edges[-1]))
    inner = F.array(*[F.lit(e) for e in edges[1:-1]])
    b = F.aggregate(inner, F.lit(0), lambda acc, e: acc + F.when(e <= F.col("v"), 1).otherwise(0))
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    spine = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(n)], "bin int, left double, right double")
    return (spine.join(F.broadcast(counts), "bin", "left")
            .select("bin", "left", "right", F.coalesce("count", F.lit(0)).cast("long").alias("count")).orderBy("bin"))


def hist_rating(df: DataFrame, col: str = "rating") -> DataFrame:
    return histogram_edges(df, col, RATING_EDGES)


# ---------------------------------------------------------------- Q10 -------
def kde(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian KDE (Scott bandwidth n^(-1/5) * sample std) evaluated at
    ``points`` equally spaced x between min and max.  Columns: i, x, density.

    Values are reduced to (value, count) first; each distinct value emits its
    ``points`` contributions through a generator and the per-point sums are
    combined map-side, so only ``points`` rows per task are shuffled.
    """
    vals = _values(df, col)
    vc = vals.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    st = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"),
                  F.var_samp("v").alias("var"))
    st = st.where(F.col("n") > 1).select(
        "lo", "hi", "n", (F.col("var") * F.pow(F.col("n").cast("double"), F.lit(-2.0 / 5.0))).alias("bw2"),
        ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"))
    xj = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(F.col("i") * F.col("step") + F.col("lo"))
    j = attach_row(vc, st)
    contrib = j.select("c", "bw2", "n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), "lo", "hi", "step", "v")
    contrib = contrib.select("i", (F.col("c") * F.exp(-F.pow(xj - F.col("v"), 2) / (2 * F.col("bw2")))).alias("k"),
                             "bw2", "n")
    dens = contrib.groupBy("i").agg(
        (F.sum("k") / (F.first("n") * F.sqrt(2 * math.pi * F.first("bw2")))).alias("density"))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), "lo", "hi", "step")
    grid = grid.select("i", xj.alias("x"))
    return grid.join(dens, "i").select("i", "x", "density").orderBy("i")


# ---------------------------------------------------------------- Q11 -------
def top_counts(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """Most frequent values (nulls dropped); ties by value.  Columns: value, count."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value").limit(k))


# ---------------------------------------------------------------- Q12 -------
def distinct_values(df: DataFrame, col: str, *, index: bool = True) -> DataFrame:
    """Sorted distinct items of a list column (or values of a scalar column),
    with their 0-based position: the vocabulary and its item->index map."""
    from pyspark.sql import types as T

    dt = df.schema[col].dataType
    items = df.select(F.explode(col).alias("value")) if isinstance(dt, T.ArrayType) else df.select(F.col(col).alias("value"))
    items = items.where(F.col("value").isNotNull()).distinct()
    if not index:
        return items.orderBy("value")
    return with_index(items, ["value"], "index").select("index", "value")


# ---------------------------------------------------------------- C5 --------
# Minutes per year, month, day and hour used by the period label.
MINUTES_IN_YEAR = 525600
MINUTES_IN_MONTH = 43800
MINUTES_IN_DAY = 1440
MINUTES_IN_HOUR = 60


def minutes_to_period(m: Column) -> Column:
    """Minutes as text "1y 2mo 3d 4h 5m"; zero parts omitted, minutes kept if alone."""
    m = m.cast("long")
    y = F.floor(m / MINUTES_IN_YEAR)
    r1 = F.pmod(m, F.lit(MINUTES_IN_YEAR))
    mo = F.floor(r1 / MINUTES_IN_MONTH)
    r2 = F.pmod(r1, F.lit(MINUTES_IN_MONTH))
    d = F.floor(r2 / MINUTES_IN_DAY)
    r3 = F.pmod(r2, F.lit(MINUTES_IN_DAY))
    h = F.floor(r3 / MINUTES_IN_HOUR)
    mi = F.pmod(r3, F.lit(MINUTES_IN_HOUR))
    part = lambda v, s: F.when(v != 0, F.concat(v.cast("string"), F.lit(s)))
    head = F.concat_ws(" ", part(y, "y"), part(mo, "mo"), part(d, "d"), part(h, "h"))
    return F.when((mi != 0) | (head == ""), F.concat_ws(" ", F.when(head != "", head), F.concat(mi.cast("string"), F.lit("m")))).otherwise(head)


BAND_NAMES = ["All", "Very short", "Short", "Medium", "Long", "Very long", "Extra long"]
BAND_PROBS = [0.25, 0.75, 0.8, 0.9, 0.95]


def duration_bands(df: DataFrame, col: str = "minutes") -> DataFrame:
    """Seven named bands cut at min, p25, p75, p80, p90, p95, max (percentiles
    truncated to integers).  Columns: band_id, band, lo, hi, label."""
    names = ["p25", "p75", "p80", "p90", "p95"]
    q = quantiles_wide(exact_quantiles(df, col, BAND_PROBS), [], BAND_PROBS, names)
    mm = df.agg(F.min(col).cast("long").alias("mn"), F.max(col).cast("long").alias("mx"))
    one = attach_row(q, mm).select("mn", "mx", *[F.col(n).cast("long").alias(n) for n in names])
    cuts = [("mn", "mx"), ("mn", "p25"), ("p25", "p75"), ("p75", "p80"), ("p80", "p90"), ("p90", "p95"), ("p95", "mx")]
    rows = F.array(*[
        F.struct(F.lit(i).alias("band_id"), F.lit(BAND_NAMES[i]).alias("band"), F.col(a).alias("lo"), F.col(b).alias("hi"))
        for i, (a, b) in enumerate(cuts)])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    label = F.when(F.col("band_id") == 6, F.concat(F.lit("> "), minutes_to_period(F.col("lo")))).otherwise(
        F.concat(minutes_to_period(F.col("lo")), F.lit(" - "), minutes_to_period(F.col("hi"))))
    return out.withColumn("label", label)


def assign_duration_band(df: DataFrame, col: str = "minutes") -> DataFrame:
    """Each row with its band (first band wins on shared edges; "All" excluded)."""
    bands = duration_bands(df, col).where(F.col("band_id") > 0)
    arr = bands.agg(F.sort_array(F.collect_list(F.struct("band_id", "band", "lo", "hi"))).alias("_bands"))  # 6 rows
    j = attach_row(df, arr)
    hit = F.filter("_bands", lambda b: (F.col(col) >= b["lo"]) & (F.col(col) <= b["hi"]))
    return j.withColumn("band", F.element_at(hit, 1)["band"]).drop("_bands")
