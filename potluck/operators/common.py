"""Building blocks that keep every operator distributed and skew-proof.

* ``topk_per_group``: exact top-k per group in two phases.  Rows are first
  ranked inside (group, salt) where the salt is a hash of the ranked item, so a
  group holding a third of the data is split over ``salt`` tasks; the global
  top-k of a group is contained in the union of its per-salt top-k lists.
* ``exact_quantiles``: exact (linear interpolation) quantiles by radix selection:
  counts per magnitude prefix, then per even slice, only inside the parts that
  hold a wanted rank.
* ``with_index``: consecutive 0-based index in a total order (distributed,
  after a reliable checkpoint of the sorted rows).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def topk_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    k: int,
    item_cols: Sequence[str],
    salt: int = 64,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order`` (a total order).

    ``item_cols`` identify a row inside its group; they feed the salt.
    """
    group_cols = list(group_cols)
    s = df.withColumn("_salt", F.pmod(F.xxhash64(*cols(item_cols)), F.lit(salt)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    pre = s.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    out = pre.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= k)
    if rank_col:
        return out.withColumnRenamed("_r2", rank_col)
    return out.drop("_r2")


def with_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "index") -> DataFrame:
    """Append a consecutive 0-based index following ``order_cols``.

    The range-partitioned sort is cut from its lineage with a reliable
    checkpoint (into ``spark.checkpoint.dir``), so partition contents are
    fixed; the index is then the partition's offset (prefix sum over one row
    per partition) plus the row's position inside its partition.  All work
    stays in the JVM; nothing but per-partition counts is ordered globally.
    """
    from potluck.session import cut_lineage

    srt = cut_lineage(df.sort(*order_cols))
    part = srt.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wpre = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(wpre), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return part.join(F.broadcast(offs), "_pid").select(*[F.col(c) for c in df.columns],
                                                       (F.col("_off") + local).cast("long").alias(index_col))


OCTAVE_PARTS = 15  # parts of an octave in the first pass: about 2 ** 16 prefixes
SLICES = 1 << 17   # even slices of a prefix in the following passes


def magnitude_prefix(value: Column) -> Column:
    """A long that never falls as the double grows: its sign and the whole part
    of its logarithm in fifteenths of an octave (1 or more, also for the least
    double); 0 for both zeros."""
    size = F.floor((F.log2(F.abs(value)) + 1075) * OCTAVE_PARTS)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("long"))


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles (numpy/pandas "linear" rule) of ``value_col``.

    Returns long rows ``(*by, p, q)``.  ``by`` must have few groups (e.g. one
    per column of a describe); per-entity medians should use the built-in
    ``percentile``, whose per-group state is a value->count map.

    Radix selection: the first pass counts rows per magnitude prefix with the
    least and greatest value of each; every following pass counts even slices
    between these two values, only inside the parts that hold a wanted rank.
    Tasks combine their counts, at most ``SLICES`` a group and part.  A part
    with one distinct value is final.  Doubles of one prefix differ by less
    than a twentieth, so after three passes of slices every part is one double:
    four passes at most, one or two where values are few.  The driver keeps
    two ranks a probability and group.
    """
    by = list(by)
    spark = df.sparkSession
    keys = [f"_g{i}" for i in range(len(by))]
    types = [df.schema[c].dataType.simpleString() for c in by]
    value = F.col("_v")
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value_col).cast("double").alias("_v"))
    rows = rows.where(value.isNotNull() & ~F.isnan(value))
    sign = F.signum(value).cast("int")
    total: dict[tuple, int] = {}
    found: dict[tuple, float] = {}  # (group, rank) -> value
    parts: list[tuple] = []  # (group, sign, least, greatest, number, ranks inside, rows before)
    while not total or parts:
        if not total:
            counted = rows.groupBy(*keys, F.lit(0).alias("_up"), magnitude_prefix(value).alias("_p")).agg(
                F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        else:
            schema = ", ".join([*(f"_w{i} {t}" for i, t in enumerate(types)), "_sign int, _from double, _to double, _up int, _ranks array<long>"])
            wanted = spark.createDataFrame([(*g, *part) for g, *part, _ in parts], schema)
            same = (sign == F.col("_sign")) & value.between(F.col("_from"), F.col("_to"))
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_w{i}"))
            piece = F.floor((value - F.col("_from")) / (F.col("_to") - F.col("_from")) * SLICES)
            counted = rows.join(F.broadcast(wanted), same).groupBy(*keys, "_up", piece.alias("_p")).agg(  # two parts a probability and group
                F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.first("_ranks").alias("_ranks"))
        inside = Window.partitionBy(*keys, "_up")
        placed = counted.withColumn("_all", F.sum("_n").over(inside)).withColumn(
            "_end", F.sum("_n").over(inside.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        if not total:
            last = F.col("_all") - 1
            ranks = F.array(*[f(last * F.lit(float(p))) for p in probs for f in (F.floor, F.ceil)])
        else:
            ranks = F.col("_ranks")
        mine = F.filter(ranks, lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))
        hits = placed.select(*keys, "_up", "_lo", "_hi", "_all", (F.col("_end") - F.col("_n")).alias("_before"),
                             F.array_sort(F.array_distinct(mine)).alias("_r")).where(F.size("_r") > 0).collect()
        before = {(g, up): n for g, _, _, _, up, _, n in parts}
        if not hits:
            break
        parts = []
        for h in hits:
            group = tuple(h[k] for k in keys)
            base = before.get((group, h["_up"]), 0)
            total.setdefault(group, h["_all"])
            if h["_lo"] == h["_hi"]:
                found.update({(group, base + r): h["_lo"] for r in h["_r"]})
            else:
                parts.append((group, 1 if h["_lo"] > 0 else -1, h["_lo"], h["_hi"], len(parts), [r - h["_before"] for r in h["_r"]], base + h["_before"]))
    out = []
    for group, n in total.items():
        for p in probs:
            place = (n - 1) * float(p)
            lo, hi = found[group, math.floor(place)], found[group, math.ceil(place)]
            out.append((*group, float(p), lo if lo == hi else lo + (place - math.floor(place)) * (hi - lo)))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in zip(by, types)), "p double, q double"])
    return spark.createDataFrame(out, schema)


def quantiles_wide(qlong: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Pivot ``exact_quantiles`` output to one column per probability."""
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(n) for p, n in zip(probs, names)]
    if by:
        return qlong.groupBy(*by).agg(*aggs)
    return qlong.agg(*aggs)
