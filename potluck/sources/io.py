"""Sources and sinks (A1-A7): table loading with format probing, JDBC,
country reference JSON, contract enforcement, schema validation, export.

Reads always go through ``spark.read`` with an explicit schema when one is
known (no inference pass over 100 TB); Parquet is preferred over CSV.
Paths are probed through the Hadoop file system of the session, so the same
code works on HDFS, object stores and local disks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.operators.cleaning import clean_date, clean_numeric

# ----------------------------------------------------------------------------
# The table contracts
# ----------------------------------------------------------------------------
RECIPES_REQUIRED = ["id", "name", "minutes", "n_steps", "n_ingredients", "tags", "ingredients", "description", "submitted"]
RECIPES_OPTIONAL = ["calories", "total_fat", "sugar", "sodium", "protein", "saturated_fat", "carbohydrates", "nutrition"]
RECIPES_NUMERIC = ["minutes", "n_steps", "n_ingredients"]
INTERACTIONS_COLUMNS = ["user_id", "recipe_id", "date", "rating", "review"]

RECIPES_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("minutes", T.LongType()), T.StructField("contributor_id", T.LongType()),
    T.StructField("submitted", T.StringType()), T.StructField("tags", T.StringType()),
    T.StructField("nutrition", T.StringType()), T.StructField("n_steps", T.LongType()),
    T.StructField("steps", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("ingredients", T.StringType()), T.StructField("n_ingredients", T.LongType()),
])
INTERACTIONS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("recipe_id", T.LongType()),
    T.StructField("date", T.StringType()), T.StructField("rating", T.DoubleType()),
    T.StructField("review", T.StringType()),
])
COUNTRIES_SCHEMA = T.StructType([
    T.StructField("name", T.StructType([T.StructField("common", T.StringType()), T.StructField("official", T.StringType())])),
    T.StructField("region", T.StringType()),
    T.StructField("subregion", T.StringType()),
    T.StructField("demonyms", T.StructType([T.StructField("eng", T.StructType([
        T.StructField("f", T.StringType()), T.StructField("m", T.StringType())]))])),
    T.StructField("flag", T.StringType()),
])


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# ---------------------------------------------------------------- A1 --------
def load_table(spark: SparkSession, name: str, data_dir: str, *, schema: T.StructType | None = None,
               candidates: Sequence[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Parquet ``<dir>/<name>.parquet`` if present, else CSV ``<dir>/<name>.csv``
    (header, quoted text), else the first existing candidate path (dispatch on
    suffix); FileNotFoundError otherwise.  ``multi_line=False`` reads CSV files
    without line breaks inside fields in splits instead of one task a file."""
    base = data_dir.rstrip("/")
    paths = [f"{base}/{name}.parquet", f"{base}/{name}.csv"] + list(candidates or [])
    for p in paths:
        if _fs_exists(spark, p):
            return read_path(spark, p, schema=schema, multi_line=multi_line)
    raise FileNotFoundError(f"no parquet or csv for {name!r} under {data_dir!r}")


def read_path(spark: SparkSession, path: str, *, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Read by suffix: .parquet, .csv, .json; a directory is read as Parquet."""
    low = path.lower()
    if low.endswith(".csv"):
        r = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    if low.endswith(".json"):
        r = spark.read.option("multiLine", True)
        return (r.schema(schema) if schema else r).json(path)
    r = spark.read
    return (r.schema(schema) if schema else r).parquet(path)


# ---------------------------------------------------------------- A2 --------
def load_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 64,
              properties: dict | None = None) -> DataFrame:
    """``SELECT * FROM table`` over JDBC, read in parallel ranges of
    ``partition_column`` when bounds are given.  The driver jar for the URL
    must be on the classpath (none ships here)."""
    props = dict(properties or {})
    if partition_column and lower_bound is not None and upper_bound is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound, upperBound=upper_bound,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


# ---------------------------------------------------------------- A3 --------
def flatten_countries(raw: DataFrame) -> DataFrame:
    """Nested country records -> name (lower common), common_name,
    official_name, region, subregion (region when missing), demonym, flag."""
    region = F.coalesce(F.col("region"), F.lit(""))
    return raw.select(
        F.lower(F.coalesce(F.col("name.common"), F.lit(""))).alias("name"),
        F.coalesce(F.col("name.common"), F.lit("")).alias("common_name"),
        F.coalesce(F.col("name.official"), F.lit("")).alias("official_name"),
        region.alias("region"),
        F.coalesce(F.col("subregion"), region).alias("subregion"),
        F.coalesce(F.col("demonyms.eng.f"), F.lit("")).alias("demonym"),
        F.col("flag"),
    )


def load_countries(spark: SparkSession, path: str) -> DataFrame:
    """Countries JSON (an array of records) -> flat rows with a country id
    (position in name order)."""
    raw = spark.read.schema(COUNTRIES_SCHEMA).option("multiLine", True).json(path)
    flat = flatten_countries(raw)
    from pyspark.sql import Window

    return flat.withColumn("country_id", (F.row_number().over(Window.orderBy("name", "official_name")) - 1).cast("long"))


# ---------------------------------------------------------------- A4/A5 -----
def enforce_contract(df: DataFrame, required: Sequence[str] = RECIPES_REQUIRED,
                     numeric: Sequence[str] = RECIPES_NUMERIC, date_cols: Sequence[str] = ("submitted",)) -> DataFrame:
    """Add missing required columns as null; soft-cast numerics and dates."""
    out = df
    for c in required:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    for c in numeric:
        if c in out.columns:
            out = out.withColumn(c, clean_numeric(c))
    for c in date_cols:
        if c in out.columns and not isinstance(out.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)):
            out = out.withColumn(c, clean_date(c))
    return out


def validate_schema(df: DataFrame, required: Sequence[str] = RECIPES_REQUIRED,
                    optional: Sequence[str] = RECIPES_OPTIONAL) -> DataFrame:
    """One row: ok, missing columns, optional columns present, rows, columns."""
    missing = [c for c in required if c not in df.columns]
    present = [c for c in optional if c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(not missing).alias("ok"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing"),
        F.array(*[F.lit(c) for c in present]).cast("array<string>").alias("optional_present"),
        "rows", F.lit(len(df.columns)).alias("cols"))


# ---------------------------------------------------------------- A6/A7 -----
def export(df: DataFrame, path: str, fmt: str | None = "parquet", *, mode: str = "overwrite",
           jdbc_url: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Write as parquet (default), csv (arrays/maps/structs as JSON text) or a
    JDBC table (replace).  Each task writes its own files: nothing passes
    through the driver."""
    fmt = (fmt or "parquet").lower()
    if fmt == "parquet":
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    elif fmt == "csv":
        flat = df.select(*[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
            for f in df.schema.fields])
        flat.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    elif fmt in ("sql", "jdbc"):
        if not jdbc_url:
            raise ValueError("jdbc_url is required for sql export")
        df.write.mode("overwrite").jdbc(jdbc_url, path)
    else:
        raise ValueError(f"Unsupported export format: {fmt}")


def export_clean_min(df: DataFrame, *, review_col: str = "review") -> DataFrame:
    """Minimal clean interactions: ids, date, rating, review and three text
    features, with nullable types."""
    t = F.coalesce(F.col(review_col), F.lit(""))
    cols = [c for c in INTERACTIONS_COLUMNS if c in df.columns]
    return df.select(
        *cols,
        F.length(t).cast("long").alias("review_len"),
        F.size(F.filter(F.split(t, r"\s+"), lambda w: w != "")).cast("long").alias("review_words"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("review_exclamations"),
    )
