"""Adapters from the driver tables to the operator input shapes.

The operators are written for a catalogue (``recipes``) and its user
interactions.  The test tables are TPC-H-like, so each adapter derives an
input of the right shape from them, once as a Spark DataFrame and once as a
DuckDB common table expression (for the oracle SQL).  Both sides must stay
expression-for-expression identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- P1 --------
def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, recipe_id, date, rating, review from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderkey") % 500).alias("recipe_id"),
        F.col("o_orderdate").alias("date"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("rating"),
        F.col("o_orderpriority").alias("review"),
    )


SQL_INTERACTIONS = """interactions AS (
  SELECT o_custkey AS user_id, o_orderkey % 500 AS recipe_id, o_orderdate AS date,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rating,
         o_orderpriority AS review
  FROM orders)"""


def interactions_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 (hourly form) from ``events``: timestamps carry hours and minutes."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id"),
        F.col("event_id").alias("recipe_id"),
        F.col("ts").alias("date"),
        (F.lit(1) + F.least(F.lit(4), F.floor(F.col("value") / 30))).cast("double").alias("rating"),
        F.col("event_type").alias("review"),
    )


SQL_INTERACTIONS_HOURLY = """interactions_h AS (
  SELECT user_id, event_id AS recipe_id, ts AS date,
         CAST(1 + least(4, floor(value / 30)) AS DOUBLE) AS rating,
         event_type AS review
  FROM events)"""


# ---------------------------------------------------------------- P2 --------
def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text reviews = documents left-joined to labels."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id"),
        F.col("source").alias("user_id"),
        F.col("lang").alias("recipe_id"),
        F.col("text").alias("review"),
        F.col("quality").cast("double").alias("rating"),
    )


SQL_REVIEWS = """reviews AS (
  SELECT d.doc_id, d.source AS user_id, d.lang AS recipe_id, d.text AS review,
         CAST(l.quality AS DOUBLE) AS rating
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# ---------------------------------------------------------------- P3 --------
# Fixed words injected into the proxy recipes so that season/event operators
# have something to find (the generated names hold none).
TAG_WORDS = ["winter", "spring", "summer", "fall", "christmas", "easter", "halloween", "weeknight"]
DESC_WORDS = ["summer", "winter", "picnic", "spring", "new-years", "brunch"]


def _arr_lit(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows (id, name, minutes, n_steps, lists, dates) from ``part``."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        (F.col("p_size") * 5).cast("bigint").alias("minutes"),
        F.col("p_size").cast("bigint").alias("n_steps"),
        F.when(F.col("p_size") % 10 == 0, F.lit(3)).otherwise(F.lit(2)).cast("bigint").alias("n_ingredients"),
        F.split("p_name", " ").alias("ingredients"),
        F.array(
            F.lower("p_type"),
            F.lower("p_brand"),
            F.concat(F.col("p_size").cast("string"), F.lit("-minutes")),
            F.get(_arr_lit(TAG_WORDS), (F.col("p_size") % len(TAG_WORDS)).cast("int")),
        ).alias("tags"),
        F.concat(
            F.lit("a "), F.col("p_name"), F.lit(" for "),
            F.get(_arr_lit(DESC_WORDS), (F.col("p_partkey") % len(DESC_WORDS)).cast("int")),
        ).alias("description"),
        F.date_add(F.to_date(F.lit("2000-01-01")), (F.col("p_partkey") % 1500).cast("int"))
        .cast("timestamp_ntz").alias("submitted"),
        F.col("p_brand").alias("contributor_id"),
        F.col("p_retailprice").alias("price"),
    )


SQL_RECIPES = f"""recipes AS (
  SELECT p_partkey AS id, p_name AS name, CAST(p_size * 5 AS BIGINT) AS minutes,
         CAST(p_size AS BIGINT) AS n_steps,
         CAST(CASE WHEN p_size % 10 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_ingredients,
         string_split(p_name, ' ') AS ingredients,
         [lower(p_type), lower(p_brand), CAST(p_size AS VARCHAR) || '-minutes',
          {_sql_list(TAG_WORDS)}[p_size % {len(TAG_WORDS)} + 1]] AS tags,
         'a ' || p_name || ' for ' || {_sql_list(DESC_WORDS)}[p_partkey % {len(DESC_WORDS)} + 1] AS description,
         CAST(DATE '2000-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS TIMESTAMP) AS submitted,
         p_brand AS contributor_id, p_retailprice AS price
  FROM part)"""


def recipes_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with tags that only resemble a season, and some dates missing."""
    r = recipes(spark, sf_dir)
    odd = F.array(F.lit("summer-squash"), F.lit("waterfall"), F.lit("christmas-eve"))
    return r.withColumn("tags", F.when(F.col("id") % 4 == 0, F.concat(F.slice("tags", 1, 3), odd)).otherwise(F.col("tags"))).withColumn(
        "submitted", F.when(F.col("id") % 9 != 0, F.col("submitted")))


SQL_RECIPES_SEASONAL = """recipes_seasonal AS (
  SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN list_concat(tags[1:3], ['summer-squash', 'waterfall', 'christmas-eve']) ELSE tags END AS tags,
                    CASE WHEN id % 9 <> 0 THEN submitted END AS submitted) FROM recipes)"""


def recipes_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with a country and a season; the lists of one country and of one
    season are all empty."""
    r = recipes(spark, sf_dir)
    return r.select(
        "id", F.concat(F.lit("country "), (F.col("id") % 7).cast("string")).alias("country"),
        F.get(F.array(*[F.lit(x) for x in ("winter", "spring", "summer", "fall", "all year")]), (F.floor(F.col("id") / 7) % 5).cast("int")).alias("season"),
        F.when((F.col("id") % 7 == 3) | (F.floor(F.col("id") / 7) % 5 == 4), F.array().cast("array<string>"))
        .otherwise(F.transform("ingredients", lambda t: F.concat(t, F.lit(" "), (F.col("id") % 3 + F.col("id") % 7).cast("string")))).alias("ingredients"))


SQL_RECIPES_LOCATED = """recipes_located AS (
  SELECT id, 'country ' || (id % 7) AS country, ['winter', 'spring', 'summer', 'fall', 'all year'][CAST(floor(id / 7) AS BIGINT) % 5 + 1] AS season,
         CASE WHEN id % 7 = 3 OR CAST(floor(id / 7) AS BIGINT) % 5 = 4 THEN [] ELSE
           list_transform(ingredients, lambda t: t || ' ' || (id % 3 + id % 7)) END AS ingredients FROM recipes)"""


def recipes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 as raw CSV-like text: list columns as Python-literal strings."""
    r = recipes(spark, sf_dir)
    lit_list = lambda c: F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))
    return r.select(
        "id", "name", "minutes", "n_steps", "n_ingredients",
        lit_list(F.col("ingredients")).alias("ingredients"),
        lit_list(F.col("tags")).alias("tags"),
        "description", "submitted",
    )


SQL_RECIPES_TEXT = """recipes_text AS (
  SELECT id, name, minutes, n_steps, n_ingredients,
         '[''' || array_to_string(ingredients, ''', ''') || ''']' AS ingredients,
         '[''' || array_to_string(tags, ''', ''') || ''']' AS tags,
         description, submitted
  FROM recipes)"""


# ---------------------------------------------------------------- P4 --------
def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with country, region and free tokens (every third lacks the country)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("c_custkey").alias("id"),
        F.lower("n_name").alias("country"),
        F.lower("r_name").alias("region"),
        F.when(F.col("c_custkey") % 3 == 0, F.array(F.lower("c_mktsegment")))
        .otherwise(F.array(F.lower("c_mktsegment"), F.lower("n_name"))).alias("tokens"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("long").alias("country_id"),
        # names in every form the exact lookup knows (common, official, demonym, region)
        F.when(F.col("c_custkey") % 4 == 0, F.array(F.lower("c_mktsegment"), F.lower("r_name")))
        .when(F.col("c_custkey") % 4 == 1, F.array(F.lower("c_mktsegment"), F.concat(F.lower("n_name"), F.lit("ese"))))
        .when(F.col("c_custkey") % 4 == 2, F.array(F.lower("r_name"), F.concat(F.lit("republic of "), F.lower("n_name"))))
        .otherwise(F.array(F.lower("n_name"), F.lower("r_name"))).alias("tags"),
    )


SQL_GEO = """geo AS (
  SELECT c_custkey AS id, lower(n_name) AS country, lower(r_name) AS region,
         CASE WHEN c_custkey % 3 = 0 THEN [lower(c_mktsegment)]
              ELSE [lower(c_mktsegment), lower(n_name)] END AS tokens,
         c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS country_id,
         CASE WHEN c_custkey % 4 = 0 THEN [lower(c_mktsegment), lower(r_name)]
              WHEN c_custkey % 4 = 1 THEN [lower(c_mktsegment), lower(n_name) || 'ese']
              WHEN c_custkey % 4 = 2 THEN [lower(r_name), 'republic of ' || lower(n_name)]
              ELSE [lower(n_name), lower(r_name)] END AS tags
  FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""


def country_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference countries derived from nation/region: the shape of the countries file."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lower("n_name").alias("name"),
        F.lower("n_name").alias("common_name"),
        F.concat(F.lit("republic of "), F.lower("n_name")).alias("official_name"),
        F.lower("r_name").alias("region"),
        F.lower("r_name").alias("subregion"),
        F.concat(F.lower("n_name"), F.lit("ese")).alias("demonym"),
        F.col("n_nationkey").alias("country_id"),
    )


SQL_COUNTRY_REF = """country_ref AS (
  SELECT lower(n_name) AS name, lower(n_name) AS common_name,
         'republic of ' || lower(n_name) AS official_name,
         lower(r_name) AS region, lower(r_name) AS subregion,
         lower(n_name) || 'ese' AS demonym, n_nationkey AS country_id
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# ---------------------------------------------------------------- P6 --------
NUTRITION_COLS = ["calories", "total_fat", "sugar", "sodium", "protein", "saturated_fat", "carbohydrates"]


def nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id + 7 numeric columns from the first 7 embedding components."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(NUTRITION_COLS)],
    )


SQL_NUTRITION = "nutrition AS (SELECT vec_id AS id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(NUTRITION_COLS)
) + " FROM embeddings)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
