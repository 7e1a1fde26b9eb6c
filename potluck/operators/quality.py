"""Data quality reports: missing values, duplicates, descriptive statistics,
cardinalities, value ranges, KPIs and list-length checks (Q1-Q7, Q13, Q14).

All reports are one aggregation pass (map-side combined) followed by a reshape
of a handful of rows; none collects data on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.operators.common import exact_quantiles, quantiles_wide
from potluck.operators.stats import attach_row

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _is_numeric(dt) -> bool:
    return isinstance(dt, NUMERIC)


def _missing(c: str, dt) -> Column:
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


# ---------------------------------------------------------------- Q1 --------
def na_counts(df: DataFrame, columns: Sequence[str] | None = None, *, only_missing: bool = False) -> DataFrame:
    """Per column: missing count, rate in percent and fraction; most missing first.

    One aggregation computes every count; the result has one row per column.
    """
    columns = list(columns or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(_missing(c, types[c])).alias(f"_na_{i}") for i, c in enumerate(columns)
    ]
    one = df.agg(*aggs)
    long = one.select(
        "_rows",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_na_{i}").alias("na_count")) for i, c in enumerate(columns)
        ])).alias("kv"),
    ).select("kv.column_name", "kv.na_count", "_rows")
    out = long.select(
        "column_name", "na_count",
        (F.col("na_count") * 100.0 / F.nullif(F.col("_rows"), F.lit(0))).alias("na_rate"),
        (F.col("na_count") / F.nullif(F.col("_rows").cast("double"), F.lit(0.0))).alias("na_frac"),
    )
    if only_missing:
        out = out.where(F.col("na_count") > 0)
    return out.orderBy(F.desc("na_count"), "column_name")


# ---------------------------------------------------------------- Q2/Q3 -----
def _dup_levels(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Duplicate counts (rows minus distinct keys) for nested key levels.

    Levels go from coarse to fine; the finest (usually all columns) is grouped
    once over the data, and each coarser level is grouped from the finer
    level's distinct keys, so only the first aggregation sees every row.
    Null keys compare equal (as pandas ``duplicated`` does).
    """
    from potluck.operators.cleaning import canonical_columns

    finest = levels[-1][1]
    base = canonical_columns(df.select(*finest))
    g = base.groupBy(*finest).agg(F.count(F.lit(1)).alias("_c"))
    parts = []
    cur, cur_keys = g, finest
    for name, keys in reversed(levels):
        if list(keys) != list(cur_keys):
            cur = cur.groupBy(*keys).agg(F.sum("_c").alias("_c"))
            cur_keys = keys
        parts.append(cur.agg(F.lit(name).alias("kind"), (F.sum("_c") - F.count(F.lit(1))).alias("n_duplicates")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _gated(counts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Reference gating: a level is reported only when every coarser level has
    duplicates, and (except for the finest level) only when it has some itself."""
    from pyspark.sql import Window

    names = F.array(*[F.lit(k) for k in order])
    last = len(order)
    c = counts.withColumn("_pos", F.array_position(names, F.col("kind")))
    first_zero = F.min(F.when(F.col("n_duplicates") == 0, F.col("_pos"))).over(Window.partitionBy())
    c = c.withColumn("_z", first_zero)
    keep = F.col("_z").isNull() | (F.col("_pos") < F.col("_z")) | ((F.col("_pos") == last) & (F.col("_z") == last))
    return c.where(keep).orderBy("_pos").select("kind", "n_duplicates")


def duplicates_recipes(df: DataFrame, *, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """Duplicates by id; if any, by (id, name); if any, over all columns."""
    levels = [("id", [id_col]), ("id_name", [id_col, name_col]), ("full", list(df.columns))]
    return _gated(_dup_levels(df, levels), [n for n, _ in levels])


def duplicates_interactions(df: DataFrame, *, keys: Sequence[str] = ("user_id", "recipe_id", "date")) -> DataFrame:
    """Duplicates by (user, recipe, date); if any, also over all columns."""
    levels = [("user_recipe_date", list(keys)), ("full", list(df.columns))]
    return _gated(_dup_levels(df, levels), [n for n, _ in levels])


# ---------------------------------------------------------------- Q4/Q7 -----
DESCRIBE_PROBS = [0.25, 0.5, 0.75]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     probs: Sequence[float] = DESCRIBE_PROBS, *, approx: bool = False,
                     accuracy: int = 10000) -> DataFrame:
    """count, mean, std (ddof 1), min, percentiles, max per numeric column.

    Percentiles are exact (linear interpolation, distributed) by default;
    ``approx=True`` uses the mergeable ``percentile_approx`` sketch instead
    (one map-side combined pass, relative rank error 1/accuracy).
    """
    columns = [c for c in (columns or [f.name for f in df.schema.fields if _is_numeric(f.dataType)])]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("kv")).select("kv.column_name", "kv.v")
    long = long.withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    basic = long.groupBy("column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    names = [f"p{int(round(p * 100))}" for p in probs]
    if approx:
        pa = F.percentile_approx("v", F.array(*[F.lit(float(p)) for p in probs]), accuracy)
        qs = long.groupBy("column_name").agg(pa.alias("_q")).select(
            "column_name", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        qs = quantiles_wide(exact_quantiles(long, "v", probs, by=["column_name"]), ["column_name"], probs, names)
    return basic.join(qs, "column_name", "left").select("column_name", "count", "mean", "std", "min", *names, "max").orderBy("column_name")


MINUTES_PROBS = [0.25, 0.5, 0.75, 0.8, 0.9, 0.95]


def minutes_stats(df: DataFrame, col: str = "minutes", *, approx: bool = False) -> DataFrame:
    """Describe of one column with percentiles 25, 50, 75, 80, 90, 95 (one row)."""
    return describe_numeric(df, [col], MINUTES_PROBS, approx=approx).drop("column_name")


# ---------------------------------------------------------------- Q5 --------
def cardinalities(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """Distinct non-null values per non-numeric column (lists compared by value).

    Values of all columns are unpivoted to (column, canonical text) and
    de-duplicated by a map-side combined aggregate, then counted per column.
    """
    from potluck.operators.cleaning import canonical_text

    types = dict((f.name, f.dataType) for f in df.schema.fields)
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType))])
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), canonical_text(F.col(c), types[c]).alias("v")) for c in columns
    ])).alias("kv")).select("kv.column_name", "kv.v").where(F.col("v").isNotNull())
    if approx:
        out = long.groupBy("column_name").agg(F.approx_count_distinct("v").alias("cardinality"))
    else:
        out = long.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("cardinality"))
    return out.orderBy(F.desc("cardinality"), "column_name")


# ---------------------------------------------------------------- Q6 --------
def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max) as doubles; an empty input gives min = max = null."""
    aggs = []
    for c in columns:
        aggs += [F.min(F.col(c).cast("double")).alias(f"_mn_{c}"), F.max(F.col(c).cast("double")).alias(f"_mx_{c}")]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_mn_{c}").alias("min"), F.col(f"_mx_{c}").alias("max")) for c in columns
    ])).alias("kv")).select("kv.column_name", "kv.min", "kv.max")


def date_span(df: DataFrame, col: str = "date") -> DataFrame:
    """First and last date, days between, and the span in whole years + months."""
    one = df.agg(F.min(col).alias("date_from"), F.max(col).alias("date_to"))
    f, t = F.col("date_from"), F.col("date_to")
    # whole calendar months: a month counts once its day (and time) is reached
    short = F.date_format(t, "ddHHmmss") < F.date_format(f, "ddHHmmss")
    months = ((F.year(t) - F.year(f)) * 12 + (F.month(t) - F.month(f)) - F.when(short, 1).otherwise(0)).cast("int")
    return one.select(
        "date_from", "date_to",
        F.datediff(t, f).alias("days"),
        F.floor(months / 12).cast("int").alias("years"),
        F.pmod(months, F.lit(12)).alias("months"),
    )


# ---------------------------------------------------------------- Q13 -------
def kpis(df: DataFrame, *, distinct_cols: Sequence[str] = (), list_cols: Sequence[str] = ()) -> DataFrame:
    """Long (metric, value): rows, columns, distinct values of scalar and list columns."""
    # one scan: every value becomes a (metric, value text) row, reduced to
    # distinct ones by a partial aggregate; the row count rides along as a sum
    from potluck.operators.cleaning import canonical_text

    types = dict((f.name, f.dataType) for f in df.schema.fields)
    rows = F.array(F.struct(F.lit("rows").alias("m"), F.lit(None).cast("string").alias("v")))
    scalars = [F.array(F.struct(F.lit(f"unique_{c}").alias("m"), canonical_text(F.col(c), types[c]).alias("v"))) for c in distinct_cols]

    def items(c: str) -> Column:
        kind = types[c].elementType
        return F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.struct(F.lit(f"unique_{c}").alias("m"), canonical_text(x, kind).alias("v")))

    lists = [items(c) for c in list_cols]
    long = df.select(F.explode(F.concat(rows, *scalars, *lists)).alias("kv")).select("kv.m", "kv.v")
    seen = long.groupBy("m", "v").agg(F.count(F.lit(1)).alias("n"))
    got = seen.groupBy(F.col("m").alias("metric")).agg(
        F.sum(F.when(F.col("m") == "rows", F.col("n")).when(F.col("v").isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias("value"))
    names = ["rows", "columns"] + [f"unique_{c}" for c in [*distinct_cols, *list_cols]]
    all_names = df.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "_i int, metric string")
    columns = F.when(F.col("metric") == "columns", F.lit(len(df.columns)).cast("long"))
    return all_names.join(got, "metric", "left").select("metric", F.coalesce("value", columns, F.lit(0)).cast("long").alias("value"))


# ---------------------------------------------------------------- Q14 -------
def list_length_check(df: DataFrame, *, list_col: str = "ingredients", n_col: str = "n_ingredients") -> DataFrame:
    """One row: rows, whether every declared count matches, mismatches, min/max length."""
    ln = F.size(F.coalesce(F.col(list_col), F.array()))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(n_col) != ln).alias("n_mismatch"),
        F.min(ln).alias("min_len"),
        F.max(ln).alias("max_len"),
    ).withColumn("all_match", F.col("n_mismatch") == 0)


def list_length_distribution(df: DataFrame, *, list_col: str = "ingredients") -> DataFrame:
    """Percent of rows per list length."""
    ln = F.size(F.coalesce(F.col(list_col), F.array())).alias("length")
    g = df.groupBy(ln).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_total"))
    return attach_row(g, total).select("length", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct")).orderBy("length")
