"""Monthly series, rolling means, year-over-year change, anomalies, seasonal
decomposition, weekday profiles and user cohorts (T1-T11).

Scale notes
-----------
* Every series is first reduced by a partial (map-side combined) aggregate to
  one row per month (or per key and month).  Windows without a partition key
  run only on those reduced rows, whose number is bounded by the calendar
  (a few hundred months), never by the data volume.
* Cohorts never put a user's raw rows into one task: rows are first counted
  per (user, month), so a user holding a third of all rows contributes at most
  one row per active month to the per-user window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_start(c: str | Column) -> Column:
    """First instant of the month, as a timestamp without time zone."""
    return F.date_trunc("month", F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _spark(df: DataFrame):
    return df.sparkSession


# ---------------------------------------------------------------- T1 --------
def by_month(df: DataFrame, *, date_col: str = "date", rating_col: str | None = "rating") -> DataFrame:
    """Rows per month and mean rating; rows without a date are dropped."""
    work = df.where(F.col(date_col).isNotNull())
    n = F.count(F.lit(1)).alias("n")
    if rating_col and rating_col in df.columns:
        mean = F.avg(rating_col).alias("mean_rating")
    else:  # without ratings the reference reports the row count twice
        mean = F.count(F.lit(1)).cast("double").alias("mean_rating")
    return work.groupBy(month_start(date_col).alias("month")).agg(n, mean).orderBy("month")


monthly_series = by_month


# ---------------------------------------------------------------- T2 --------
def monthly_rolling(df: DataFrame, *, window: int = 3, date_col: str = "date", rating_col: str = "rating") -> DataFrame:
    """Trailing mean over ``window`` months (min periods 1) of n and mean rating.

    Column names keep the fixed ``*_roll3`` suffix of the original API.
    """
    bm = by_month(df, date_col=date_col, rating_col=rating_col)
    w = Window.orderBy("month").rowsBetween(-(window - 1), Window.currentRow)
    return bm.select(
        "month", "n", "mean_rating",
        F.avg("n").over(w).alias("n_roll3"),
        F.avg("mean_rating").over(w).alias("mean_rating_roll3"),
    )


# ---------------------------------------------------------------- T3 --------
def monthly_yoy(df: DataFrame, *, date_col: str = "date", rating_col: str = "rating", calendar: bool = False) -> DataFrame:
    """Growth of n against 12 rows earlier (or 12 calendar months with ``calendar``)."""
    bm = by_month(df, date_col=date_col, rating_col=rating_col)
    if calendar:
        prev = bm.select(F.add_months("month", 12).cast("timestamp_ntz").alias("month"), F.col("n").alias("n_prev12"))
        j = bm.join(prev, "month", "left")
    else:
        j = bm.withColumn("n_prev12", F.lag("n", 12).over(Window.orderBy("month")))
    return j.select(
        "month", "n", "mean_rating",
        (F.col("n") / F.nullif(F.col("n_prev12").cast("double"), F.lit(0.0)) - 1).alias("n_yoy"),
    ).orderBy("month")


# ---------------------------------------------------------------- T4 --------
def monthly_anomalies(df: DataFrame, *, z_thresh: float = 2.5, date_col: str = "date", rating_col: str = "rating") -> DataFrame:
    """z-score of monthly n with the population deviation; 0 when it is 0."""
    bm = by_month(df, date_col=date_col, rating_col=rating_col)
    w = Window.partitionBy()  # whole (monthly, bounded) series
    mu = F.avg("n").over(w)
    sigma = F.stddev_pop("n").over(w)
    z = F.when((sigma == 0) | sigma.isNull() | F.isnan(sigma), F.lit(0.0)).otherwise((F.col("n") - mu) / sigma)
    return bm.withColumn("z_n", z).withColumn("is_anomaly", F.abs("z_n") >= F.lit(z_thresh)).orderBy("month")


# ---------------------------------------------------------------- T5 --------
def seasonal_profile(df: DataFrame, *, date_col: str = "date", rating_col: str = "rating") -> DataFrame:
    """Mean monthly n per calendar month; 12 rows, months without data null."""
    bm = by_month(df, date_col=date_col, rating_col=rating_col)
    prof = bm.groupBy(F.month("month").alias("month")).agg(F.avg("n").alias("n_mean"))
    spine = _spark(df).range(1, 13).select(F.col("id").cast("int").alias("month"))
    return spine.join(F.broadcast(prof), "month", "left").orderBy("month")


# ---------------------------------------------------------------- T6 --------
def one_year(df: DataFrame, year: int, *, date_col: str = "date", rating_col: str = "rating") -> DataFrame:
    """Monthly rows of one calendar year."""
    return by_month(df, date_col=date_col, rating_col=rating_col).where(F.year("month") == F.lit(year))


def year_range(df: DataFrame, *, date_col: str = "date") -> DataFrame:
    """First and last year with data (one row)."""
    y = F.year(F.col(date_col))
    return df.where(F.col(date_col).isNotNull()).agg(F.min(y).alias("min_year"), F.max(y).alias("max_year"))


# ---------------------------------------------------------------- T8/T9 -----
def weekday_profile(df: DataFrame, *, date_col: str = "date") -> DataFrame:
    """Rows per weekday, 0 = Monday."""
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(F.weekday(date_col).alias("wk")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("label", F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("wk") + 1))
            .orderBy("wk"))


# Weekday labels, Monday first.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def weekday_hour_heat(df: DataFrame, *, date_col: str = "date") -> DataFrame:
    """Rows per (weekday, hour)."""
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(F.weekday(date_col).alias("wk"), F.hour(date_col).alias("h"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("wk", "h"))


# ---------------------------------------------------------------- T10 -------
def cohorts(df: DataFrame, *, user_col: str = "user_id", date_col: str = "date") -> DataFrame:
    """Rows per (cohort month, months since the user's first month).

    Plan: count per (user, month) with a map-side combined aggregate, take the
    per-user first month over those few rows with a window, then sum counts
    per (cohort, age).  Two shuffles, both on pre-aggregated rows.
    """
    um = (df.where(F.col(date_col).isNotNull() & F.col(user_col).isNotNull())
          .groupBy(F.col(user_col).alias("_u"), month_start(date_col).alias("month"))
          .agg(F.count(F.lit(1)).alias("_c")))
    um = um.withColumn("cohort", F.min("month").over(Window.partitionBy("_u")))
    age = ((F.year("month") - F.year("cohort")) * 12 + (F.month("month") - F.month("cohort"))).alias("age")
    return (um.groupBy("cohort", age).agg(F.sum("_c").alias("n"))
            .orderBy("cohort", "age"))


# ---------------------------------------------------------------- T11 -------
def cohort_matrix(df: DataFrame, *, max_age: int = 12, user_col: str = "user_id", date_col: str = "date") -> DataFrame:
    """Cohort grid: one row per cohort, columns ``age_0..age_{max_age}``, missing 0."""
    c = cohorts(df, user_col=user_col, date_col=date_col).where(F.col("age").between(0, max_age))
    ages = list(range(max_age + 1))
    p = c.groupBy("cohort").pivot("age", ages).agg(F.sum("n"))
    return p.select("cohort", *[F.coalesce(F.col(str(a)), F.lit(0)).cast("bigint").alias(f"age_{a}") for a in ages]).orderBy("cohort")


# ---------------------------------------------------------------- T7 --------
def seasonal_decompose(df: DataFrame, *, date_col: str = "date", series_col: str | None = None,
                       period: int = 12, min_months: int = 24, rating_col: str = "rating") -> DataFrame:
    """Additive decomposition of monthly n: long ``(month, part, value)``, or
    ``(series_col, month, part, value)`` with one decomposition per series.

    observed: monthly n on a gap-free month spine, gaps linearly interpolated;
    trend: centred 2x12 moving average, the first and last half-period filled by
    a least-squares line over the nearest ``period`` defined trend values;
    seasonal: per-phase mean of (observed - trend), centred to mean 0;
    resid: observed - trend - seasonal.  Series of fewer than ``min_months``
    months give no rows.  All windows run on the monthly rows only.
    """
    keys = [series_col] if series_col else []
    dated = df.where(F.col(date_col).isNotNull())
    bm = dated.groupBy(*keys, month_start(date_col).alias("month")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    bounds = bm.groupBy(*keys).agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.count(F.lit(1)).alias("cnt"))
    spine = bounds.where(F.col("cnt") >= min_months).select(*keys, F.explode(
        F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"), F.expr("interval 1 month"))).alias("d"))
    spine = spine.select(*keys, F.col("d").cast("timestamp_ntz").alias("month"))
    s = spine.join(bm, [*keys, "month"], "left")
    wall = Window.partitionBy(*keys)
    w = wall.orderBy("month")
    s = s.withColumn("t", F.row_number().over(w) - 1)
    wb = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wf = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    prev_v = F.last("n", ignorenulls=True).over(wb)
    prev_t = F.last(F.when(F.col("n").isNotNull(), F.col("t")), ignorenulls=True).over(wb)
    next_v = F.first("n", ignorenulls=True).over(wf)
    next_t = F.first(F.when(F.col("n").isNotNull(), F.col("t")), ignorenulls=True).over(wf)
    s = s.select(*keys, "month", "t", "n", prev_v.alias("pv"), prev_t.alias("pt"), next_v.alias("nv"), next_t.alias("nt"))
    interp = (F.when(F.col("n").isNotNull(), F.col("n"))
              .when(F.col("pv").isNull(), F.col("nv"))
              .when(F.col("nv").isNull(), F.col("pv"))
              .otherwise(F.col("pv") + (F.col("nv") - F.col("pv")) * (F.col("t") - F.col("pt")) / (F.col("nt") - F.col("pt"))))
    s = s.select(*keys, "month", "t", interp.alias("x"))
    half = period // 2
    cnt = F.count(F.lit(1)).over(wall)
    s = s.withColumn("N", cnt)
    # centred moving average with half weights at both ends (even period)
    terms = [F.lag("x", k).over(w) for k in range(1, half)] + [F.col("x")] + [F.lead("x", k).over(w) for k in range(1, half)]
    full = sum(terms[1:], terms[0])
    ends = 0.5 * F.lag("x", half).over(w) + 0.5 * F.lead("x", half).over(w)
    s = s.withColumn("ma", F.when((F.col("t") >= half) & (F.col("t") < F.col("N") - half), (full + ends) / period))
    # least-squares end extrapolation: front line fitted on trend indices
    # [a, a+period), back line on [b-period, b) with a, b the first/last defined
    a, b = F.lit(half), F.col("N") - half - 1
    in_front = (F.col("t") >= a) & (F.col("t") < F.least(a + period, b))
    in_back = (F.col("t") >= F.greatest(a, b - period)) & (F.col("t") < b)
    fs = F.regr_slope(F.when(in_front, F.col("ma")), F.when(in_front, F.col("t"))).over(wall)
    fi = F.regr_intercept(F.when(in_front, F.col("ma")), F.when(in_front, F.col("t"))).over(wall)
    bs = F.regr_slope(F.when(in_back, F.col("ma")), F.when(in_back, F.col("t"))).over(wall)
    bi = F.regr_intercept(F.when(in_back, F.col("ma")), F.when(in_back, F.col("t"))).over(wall)
    trend = (F.when(F.col("ma").isNotNull(), F.col("ma"))
             .when(F.col("t") < half, fi + fs * F.col("t"))
             .otherwise(bi + bs * F.col("t")))
    s = s.withColumn("trend", trend)
    s = s.withColumn("phase", F.col("t") % period)
    s = s.withColumn("pm", F.avg(F.col("x") - F.col("trend")).over(Window.partitionBy(*keys, "phase")))
    # phases 0..period-1 each occur exactly once among the first `period`
    # rows, so this is the mean of the phase means
    mean_pm = F.avg(F.when(F.col("t") < period, F.col("pm"))).over(wall)
    s = s.select(*keys, "month", "x", "trend", (F.col("pm") - mean_pm).alias("seasonal"))
    s = s.withColumn("resid", F.col("x") - F.col("trend") - F.col("seasonal"))
    long = s.select(
        *keys, "month",
        F.explode(F.array(
            F.struct(F.lit("observed").alias("part"), F.col("x").alias("value")),
            F.struct(F.lit("trend").alias("part"), F.col("trend").alias("value")),
            F.struct(F.lit("seasonal").alias("part"), F.col("seasonal").alias("value")),
            F.struct(F.lit("resid").alias("part"), F.col("resid").alias("value")),
        )).alias("kv"))
    return long.select(*keys, "month", "kv.part", "kv.value").where(F.col("value").isNotNull())
