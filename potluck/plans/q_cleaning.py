"""Registered cleaning (B1-B18) and source/sink (A1, A3-A7) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import cleaning as B
from potluck.operators import text as TX
from potluck.operators.similarity import ingredient_tokens
from potluck.plans import proxies as P
from potluck.plans.registry import register, rounded
from potluck.sources import io as A

_R = P.with_ctes(P.SQL_RECIPES)
_RT = P.with_ctes(P.SQL_RECIPES, P.SQL_RECIPES_TEXT)
_SW = ["of", "the", "and", "a", "for", "with"]
_SW_SQL = "[" + ", ".join(f"'{w}'" for w in _SW) + "]"


# ---------------------------------------------------------------- B3/B10 ----
@register("clean_string", r"""SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '^\s+|\s+$', '', 'g') AS text_clean FROM documents""")
def q_clean_string(spark, sf):
    d = P.table(spark, sf, "documents")
    return d.select("doc_id", B.clean_string("text").alias("text_clean"))


@register("squeeze_whitespace", r"""SELECT doc_id, regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g') AS text_squeezed FROM documents""")
def q_squeeze(spark, sf):
    d = P.table(spark, sf, "documents")
    return d.select("doc_id", B.squeeze_whitespace("text").alias("text_squeezed"))


# ---------------------------------------------------------------- B4/B5 -----
@register("clean_numeric", """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS p_num,
  TRY_CAST(o_orderpriority AS DOUBLE) AS p_bad, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price FROM orders""")
def q_clean_numeric(spark, sf):
    o = P.table(spark, sf, "orders")
    return o.select("o_orderkey", B.clean_numeric(F.substring("o_orderpriority", 1, 1)).alias("p_num"),
                    B.clean_numeric("o_orderpriority").alias("p_bad"),
                    B.clean_numeric(F.col("o_totalprice").cast("string")).alias("price"))


@register("clean_date", """SELECT o_orderkey, o_orderdate AS d1, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d2, CAST(NULL AS TIMESTAMP) AS d3,
  o_orderdate + INTERVAL 123 MILLISECOND AS d4, CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS d5,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR + INTERVAL 5 MINUTE AS d6 FROM orders""")
def q_clean_date(spark, sf):
    o = P.table(spark, sf, "orders")
    day = lambda f: F.date_format("o_orderdate", f)
    shape = F.col("o_orderkey") % 8
    mixed = (F.when(shape == 0, day("dd MMM yyyy")).when(shape == 1, day("MMMM d, yyyy")).when(shape == 2, day("ddMMMyyyy"))
             .when(shape == 3, day("yyyy.M.d")).when(shape == 4, day("M-d-yy")).when(shape == 5, day("d MMM, yyyy"))
             .when(shape == 6, day("yyyy/MM/dd")).otherwise(day("d MMM")))
    return o.select("o_orderkey", B.clean_date(F.col("o_orderdate").cast("string")).alias("d1"), B.clean_date(day("MM/dd/yyyy")).alias("d2"),
                    B.clean_date("o_orderpriority").alias("d3"), B.clean_date(F.col("o_orderdate") + F.expr("INTERVAL '0.123' SECOND")).alias("d4"),
                    B.clean_date(mixed).alias("d5"), B.clean_date(F.concat(day("yyyy-MM-dd"), F.lit("T10:05Z"))).alias("d6"))


# ---------------------------------------------------------------- B6 --------
def _messy_tags(col_text: str = "tags"):
    return (F.when(F.col("id") % 10 == 0, F.lit(None).cast("string"))
            .when(F.col("id") % 10 == 1, F.lit("not a list"))
            .when(F.col("id") % 10 == 2, F.concat(F.col(col_text), F.lit(" sql")))
            .otherwise(F.col(col_text)))


@register("parse_string_list", _R + """SELECT id, CASE WHEN id % 10 IN (0, 1, 2) THEN '' ELSE
  array_to_string(list_transform(tags, lambda t: replace(lower(t), '#', '')), '|') END AS tags FROM recipes""")
def q_parse_string_list(spark, sf):
    r = P.recipes_text(spark, sf)
    return r.select("id", F.array_join(B.parse_string_list(_messy_tags()), "|").alias("tags"))


# ---------------------------------------------------------------- B7/B8 -----
@register("parse_float_list", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 1 THEN NULL ELSE l_quantity END AS v1,
  CASE WHEN l_linenumber % 4 = 1 THEN NULL ELSE l_discount END AS v2,
  CASE l_linenumber % 4 WHEN 0 THEN l_tax WHEN 2 THEN 1.0 WHEN 3 THEN 0.5 END AS v3,
  CASE l_linenumber % 4 WHEN 1 THEN 0 ELSE 3 END AS n FROM lineitem""")
def q_parse_float_list(spark, sf):
    li = P.table(spark, sf, "lineitem")
    head = F.concat(F.lit("["), F.col("l_quantity").cast("string"), F.lit(", "), F.col("l_discount").cast("string"))
    shape = F.col("l_linenumber") % 4
    txt = (F.when(shape == 0, F.concat(head, F.lit(", None, 'x', "), F.col("l_tax").cast("string"), F.lit("]")))
           .when(shape == 1, F.concat(head, F.lit("] junk"))).when(shape == 2, F.concat(head, F.lit(", True, None,]")))
           .otherwise(F.concat(head, F.lit(", .5]"))))
    read = li.select("l_orderkey", "l_linenumber", B.parse_float_list(txt).alias("arr"))
    return read.select("l_orderkey", "l_linenumber", F.get("arr", F.lit(0)).alias("v1"), F.get("arr", F.lit(1)).alias("v2"),
                       F.get("arr", F.lit(2)).alias("v3"), F.size("arr").alias("n"))


@register("parse_loose_list", _R + """SELECT id, array_to_string(CASE WHEN id % 6 = 4 THEN [array_to_string(ingredients, '|')]
  ELSE list_transform(ingredients, lambda t: lower(trim(t))) END, ';') AS tokens FROM recipes""")
def q_parse_loose_list(spark, sf):
    r = P.recipes(spark, sf)
    text = P.recipes_text(spark, sf).select(F.col("id").alias("_id"), F.col("ingredients").alias("_text"))
    j = r.join(text, r["id"] == F.col("_id"))
    shape = F.col("id") % 6
    txt = (F.when(shape == 0, F.col("_text")).when(shape == 1, F.replace("_text", F.lit("', '"), F.lit("']['")))
           .when(shape == 2, F.array_join("ingredients", ", ")).when(shape == 3, F.substring("_text", F.lit(2), F.length("_text") - 2))
           .when(shape == 4, F.array_join("ingredients", "|")).otherwise(F.concat(F.lit("["), F.array_join("ingredients", ","), F.lit("]"))))
    return j.select("id", F.array_join(B.parse_loose_list(txt), ";").alias("tokens"))


@register("parse_nested_list", _R + """SELECT id, array_to_string(CASE id % 4
  WHEN 0 THEN [lower(ingredients[1]), '[''x y'', "it''s", [' || id || ', none]]', 'z']
  WHEN 1 THEN list_transform(ingredients, lambda t: 'o''' || lower(trim(t)))
  WHEN 2 THEN list_transform(ingredients, lambda t: 'a "' || lower(trim(t)) || '"')
  ELSE [lower(array_to_string(ingredients, '')), '[]'] END, ';') AS tokens FROM recipes""")
def q_parse_nested_list(spark, sf):
    """Lists inside lists, escaped quotes, both kinds of quotes, strings side by side."""
    r = P.recipes(spark, sf)
    shape = F.col("id") % 4
    first = F.get("ingredients", F.lit(0))
    nested = F.concat(F.lit("['"), first, F.lit("', ['x y' , \"it's\",["), F.col("id").cast("string"), F.lit(",None]], 'Z']"))
    quoted = F.transform("ingredients", lambda t, k: F.when(k % 2 == 0, F.concat(F.lit("'a \""), t, F.lit("\"'")))
                         .otherwise(F.concat(F.lit('"a \\"'), t, F.lit('\\""'))))
    txt = (F.when(shape == 0, nested)
           .when(shape == 1, F.concat(F.lit("['O\\'"), F.array_join("ingredients", "', 'O\\'"), F.lit("']")))
           .when(shape == 2, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))
           .otherwise(F.concat(F.lit("['"), F.array_join("ingredients", "' '"), F.lit("', []]"))))
    return r.select("id", F.array_join(B.parse_loose_list(txt), ";").alias("tokens"))


@register("parse_tag_text", _R + """SELECT id, array_to_string(CASE WHEN id % 4 = 3 THEN list_transform(range(len(tags)), lambda i:
  CASE WHEN i = 0 THEN '[' ELSE '' END || tags[i + 1] || CASE WHEN i = len(tags) - 1 THEN ']' ELSE '' END) ELSE tags END, ';') AS tokens FROM recipes""")
def q_parse_tag_text(spark, sf):
    """Tag text with commas, pipes or as a literal (a broken literal is split as it is)."""
    r = P.recipes(spark, sf)
    shape = F.col("id") % 4
    txt = (F.when(shape == 0, F.concat(F.lit("['"), F.array_join("tags", "', '"), F.lit("']"))).when(shape == 1, F.array_join("tags", " | "))
           .when(shape == 2, F.array_join("tags", ", ")).otherwise(F.concat(F.lit("["), F.array_join("tags", ","), F.lit("]"))))
    return r.select("id", F.array_join(B.parse_loose_list(txt, delimiters=",|"), ";").alias("tokens"))


# ---------------------------------------------------------------- B9 --------
@register("normalize_columns", "SELECT n_nationkey, n_name, n_regionkey AS continent FROM nation")
def q_normalize_columns(spark, sf):
    n = P.table(spark, sf, "nation")
    messy = n.select(F.col("n_nationkey").alias(" N_NationKey"), F.col("n_name").alias("N_NAME "),
                     F.col("n_regionkey").alias("Region"))
    return B.normalize_columns(messy)


# ---------------------------------------------------------------- B11/B12 ---
_TAGS2 = "[p_name || ' of the ' || lower(p_type), lower(p_brand), '']"


@register("clean_tags", f"""SELECT p_partkey AS id, array_to_string(list_filter(list_transform({_TAGS2}, lambda t:
  CASE WHEN instr(t, ' ') > 0 THEN array_to_string(list_filter(regexp_split_to_array(trim(t), '\\s+'), lambda w: NOT list_contains({_SW_SQL}, w)), '-') ELSE t END),
  lambda t: t IS NOT NULL AND t <> ''), '|') AS tags FROM part""")
def q_clean_tags(spark, sf):
    p = P.table(spark, sf, "part")
    tags = F.array(F.concat(F.col("p_name"), F.lit(" of the "), F.lower("p_type")), F.lower("p_brand"), F.lit(""))
    return p.select(F.col("p_partkey").alias("id"), F.array_join(B.clean_tags(tags, _SW), "|").alias("tags"))


# Words that are not main ingredients.
_BLACKLIST = ("inch inches deep low fat fresh large small medium thin diced sliced chopped piece pieces").split()


def _norm_sql(x: str) -> str:
    pre = f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z\\s-]', ' ', 'g'), '\\s+', ' ', 'g'))"
    bl = "[" + ", ".join(f"'{w}'" for w in _SW + _BLACKLIST) + "]"
    toks = f"list_filter(string_split({pre}, ' '), lambda t: length(t) > 1 AND NOT list_contains({bl}, t))"
    dist = f"list_filter({toks}, lambda t, i: list_position({toks}, t) = i)"
    return f"(CASE WHEN array_to_string({dist}, '-') = '' THEN {pre} ELSE array_to_string({dist}, '-') END)"


@register("normalize_ingredient_text", f"""SELECT p_partkey AS id, {_norm_sql("p_name || ' 2 large ' || p_type || ' of the ' || p_name")} AS norm FROM part""")
def q_normalize_ingredient_text(spark, sf):
    p = P.table(spark, sf, "part")
    txt = F.concat(F.col("p_name"), F.lit(" 2 large "), F.col("p_type"), F.lit(" of the "), F.col("p_name"))
    return p.select(F.col("p_partkey").alias("id"), B.normalize_ingredient_text(txt, _SW).alias("norm"))


@register("normalize_ingredients", _R + f"""SELECT id, array_to_string(list_transform(ingredients, lambda x: {_norm_sql('x')}), '|') AS ingredients FROM recipes""")
def q_normalize_ingredients(spark, sf):
    r = P.recipes(spark, sf).select("id", "ingredients")
    out, _ = B.normalize_ingredients(r, "ingredients", _SW)
    return out.select("id", F.array_join("ingredients", "|").alias("ingredients"))


@register("normalize_ingredients_report", _R + f""", v AS (SELECT DISTINCT unnest(ingredients) AS x FROM recipes),
n AS (SELECT x, {_norm_sql('x')} AS nx FROM v)
SELECT count(*) AS distinct_before, count(DISTINCT CASE WHEN nx <> '' THEN nx END) AS distinct_after,
  round((count(*) - count(DISTINCT CASE WHEN nx <> '' THEN nx END)) * 100.0 / count(*), 6) AS reduction_pct FROM n""")
def q_normalize_ingredients_report(spark, sf):
    r = P.recipes(spark, sf).select("id", "ingredients")
    return rounded(B.normalize_ingredients(r, "ingredients", _SW)[1])


# ---------------------------------------------------------------- B13 -------
@register("canonical_distinct", _R + "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT tags, ingredients FROM recipes)")
def q_canonical_distinct(spark, sf):
    r = B.canonical_key(P.recipes(spark, sf), ["tags", "ingredients"])
    return r.select("row_key").distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


@register("duplicates_lists", _R + """, t AS (SELECT id, tags, ingredients FROM recipes),
c AS (SELECT (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT tags, ingredients FROM t)) AS f)
SELECT 'full' AS kind, f AS n_duplicates FROM c""")
def q_duplicates_lists(spark, sf):
    from potluck.operators.quality import _dup_levels

    r = P.recipes(spark, sf).select("tags", "ingredients")
    return _dup_levels(r, [("full", ["tags", "ingredients"])])


# ---------------------------------------------------------------- B14 -------
@register("expand_nutrition", P.with_ctes(P.SQL_NUTRITION) + "SELECT id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in B.NUTRITION_COLS) + " FROM nutrition")
def q_expand_nutrition(spark, sf):
    e = P.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("nutrition"))
    out, _ = B.expand_nutrition(e, "nutrition")
    return rounded(out.select("id", *B.NUTRITION_COLS))


# ---------------------------------------------------------------- B15 -------
@register("text_features", r"""SELECT doc_id, CAST(length(coalesce(text, '')) AS INTEGER) AS review_len,
  CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '')) AS INTEGER) AS review_words,
  CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '!', '')) AS INTEGER) AS review_exclamations,
  CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '?', '')) AS INTEGER) AS review_question_marks,
  regexp_matches(coalesce(text, ''), '[A-Z]{3,}') AS review_has_caps,
  regexp_matches(coalesce(text, ''), '(?i)\bthank(s| you)?\b') AS review_mentions_thanks
FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text || ' Thanks!' WHEN 1 THEN text || ' thankful?' ELSE text END AS text FROM documents)""")
def q_text_features(spark, sf):
    d = P.table(spark, sf, "documents")
    more = F.when(F.col("doc_id") % 5 == 0, " Thanks!").when(F.col("doc_id") % 5 == 1, " thankful?").otherwise("")
    return B.text_features(d.select("doc_id", F.concat("text", more).alias("review")), "review").drop("review")


# ---------------------------------------------------------------- B16/B17 ---
@register("build_corpus", _R + """SELECT id, lower(coalesce(name, '') || ' ' || CASE WHEN ingredients IS NULL THEN 'nan' ELSE
  '[' || array_to_string(list_transform(ingredients, lambda t: CASE WHEN instr(t, '''') > 0 THEN '"' || t || '"' ELSE '''' || t || '''' END), ', ') || ']' END
  || ' ' || coalesce(description, '')) AS text FROM recipes""")
def q_build_corpus(spark, sf):
    return P.recipes(spark, sf).select("id", B.build_corpus().alias("text"))


@register("merge_features", _R + """SELECT id, n_steps || '-minutes ' || array_to_string(ingredients, ' ') AS features FROM recipes""")
def q_merge_features(spark, sf):
    r = P.recipes(spark, sf)
    return r.select("id", B.merge_features(TX.time_tags("tags"), ingredient_tokens("ingredients")).alias("features"))


# ---------------------------------------------------------------- B18 -------
@register("schema_report", """SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS dtype
FROM (DESCRIBE orders)""")
def q_schema_report(spark, sf):
    return B.schema_report(P.table(spark, sf, "orders"))


# ---------------------------------------------------------------- B1/B2 -----
def _mixed(spark, sf):
    o = P.table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
        F.concat(F.lit("["), F.col("o_totalprice").cast("string"), F.lit(", None]")).alias("fl"),
        F.concat(F.lit("['"), F.lower("o_orderpriority"), F.lit("', '"), F.col("o_orderstatus"), F.lit("']")).alias("sl"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("s"),
    )


_MIXED_SQL = """WITH mixed AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority, o_orderstatus,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
  '[' || CAST(o_totalprice AS VARCHAR) || ', None]' AS fl,
  '[''' || lower(o_orderpriority) || ''', ''' || o_orderstatus || ''']' AS sl,
  '  ' || o_orderpriority || ' ' AS s FROM orders)"""


_KINDS_SQL = "SELECT * FROM (VALUES ('d', 'datetime'), ('fl', 'list_float'), ('sl', 'list_string'), ('s', 'string')) t(column_name, kind)"


@register("infer_column_kinds", _KINDS_SQL)
def q_infer_column_kinds(spark, sf):
    return B.infer_column_kinds(_mixed(spark, sf).drop("o_orderkey"), by="share")


@register("infer_column_kinds_first", _KINDS_SQL)
def q_infer_column_kinds_first(spark, sf):
    return B.infer_column_kinds(_mixed(spark, sf), by="first", order_col="o_orderkey")


@register("preprocess_first", _MIXED_SQL + """ SELECT o_orderkey, CASE WHEN d IS NULL THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS d,
  o_totalprice AS fl_first, 1 AS fl_size, lower(o_orderpriority) || '|' || lower(o_orderstatus) AS sl, lower(o_orderpriority) AS s FROM mixed""")
def q_preprocess_first(spark, sf):
    clean, _ = B.preprocess(_mixed(spark, sf), by="first", order_col="o_orderkey")
    return clean.select("o_orderkey", "d", F.element_at("fl", 1).alias("fl_first"), F.size("fl").alias("fl_size"),
                        F.array_join("sl", "|").alias("sl"), "s")


@register("preprocess", _MIXED_SQL + """ SELECT o_orderkey, CASE WHEN d IS NULL THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS d,
  o_totalprice AS fl_first, 1 AS fl_size, lower(o_orderpriority) || '|' || lower(o_orderstatus) AS sl, lower(o_orderpriority) AS s FROM mixed""")
def q_preprocess(spark, sf):
    clean, _ = B.preprocess(_mixed(spark, sf), by="share")
    return clean.select("o_orderkey", "d", F.element_at("fl", 1).alias("fl_first"), F.size("fl").alias("fl_size"),
                        F.array_join("sl", "|").alias("sl"), "s")


@register("preprocess_issues", _MIXED_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS na_count FROM mixed" for c in ["o_orderkey", "d", "fl", "sl", "s"]))
def q_preprocess_issues(spark, sf):
    return B.preprocess(_mixed(spark, sf), by="share")[1]


# ---------------------------------------------------------------- A1 --------
@register("load_table", "SELECT * FROM orders")
def q_load_table(spark, sf):
    return A.load_table(spark, "orders", sf)


@register("load_table_csv", P.with_ctes(P.SQL_INTERACTIONS) + "SELECT user_id, recipe_id, strftime(date, '%Y-%m-%d') AS date, rating, review FROM interactions")
def q_load_table_csv(spark, sf):
    """Interactions written as CSV and loaded with the declared schema."""
    from potluck.session import scratch_path

    base = scratch_path(spark, "csv-tables")
    A.export(P.interactions(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd")), f"{base}/interactions.csv", "csv")
    return A.load_table(spark, "interactions", base, schema=A.INTERACTIONS_SCHEMA, multi_line=False)


@register("load_recipes_csv", _RT + """SELECT name, id, minutes, id % 9 AS contributor_id, strftime(submitted, '%Y-%m-%d') AS submitted, tags,
  CAST(NULL AS VARCHAR) AS nutrition, n_steps, CAST(NULL AS VARCHAR) AS steps, description || chr(10) || name AS description, ingredients, n_ingredients FROM recipes_text""")
def q_load_recipes_csv(spark, sf):
    """Recipes with line breaks inside a field, by a candidate path."""
    from potluck.session import scratch_path

    base = scratch_path(spark, "csv-tables")
    r = P.recipes_text(spark, sf)
    raw = r.select("name", "id", "minutes", (F.col("id") % 9).alias("contributor_id"), F.date_format("submitted", "yyyy-MM-dd").alias("submitted"),
                   "tags", F.lit(None).cast("string").alias("nutrition"), "n_steps", F.lit(None).cast("string").alias("steps"),
                   F.concat("description", F.lit("\n"), "name").alias("description"), "ingredients", "n_ingredients")
    A.export(raw, f"{base}/elsewhere.csv", "csv")
    return A.load_table(spark, "recipes", base, schema=A.RECIPES_SCHEMA, candidates=[f"{base}/elsewhere.csv"])


# ---------------------------------------------------------------- A3 --------
_COUNTRY_JSON_SQL = """SELECT lower(n_name) AS name, n_name AS common_name, 'Republic of ' || n_name AS official_name,
  r_name AS region, CASE WHEN n_nationkey % 3 = 0 THEN r_name ELSE r_name || ' north' END AS subregion,
  n_name || 'ese' AS demonym, CAST(row_number() OVER (ORDER BY lower(n_name), 'Republic of ' || n_name) - 1 AS BIGINT) AS country_id
FROM nation JOIN region ON n_regionkey = r_regionkey"""


@register("load_countries", _COUNTRY_JSON_SQL)
def q_load_countries(spark, sf):
    from potluck.session import scratch_path

    n, r = P.table(spark, sf, "nation"), P.table(spark, sf, "region")
    nested = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.struct(F.col("n_name").alias("common"), F.concat(F.lit("Republic of "), F.col("n_name")).alias("official")).alias("name"),
        F.col("r_name").alias("region"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit(None)).otherwise(F.concat(F.col("r_name"), F.lit(" north"))).alias("subregion"),
        F.struct(F.struct(F.concat(F.col("n_name"), F.lit("ese")).alias("f"), F.lit("x").alias("m")).alias("eng")).alias("demonyms"),
        F.lit(None).cast("string").alias("flag"))
    path = scratch_path(spark, "countries-json")
    # the countries file is one JSON array of records (reference-sized: 25 rows)
    nested.agg(F.to_json(F.collect_list(F.struct(*nested.columns))).alias("value")) \
        .coalesce(1).write.mode("overwrite").text(path)
    return A.load_countries(spark, path).drop("flag")


# ---------------------------------------------------------------- A4/A5 -----
@register("enforce_contract", _RT + """SELECT id, name, TRY_CAST(CASE WHEN id % 5 = 0 THEN 'n/a' ELSE CAST(minutes AS VARCHAR) END AS DOUBLE) AS minutes,
  CAST(n_steps AS DOUBLE) AS n_steps, CAST(n_ingredients AS DOUBLE) AS n_ingredients, tags, ingredients,
  CAST(NULL AS VARCHAR) AS description, submitted FROM recipes_text""")
def q_enforce_contract(spark, sf):
    r = P.recipes_text(spark, sf).drop("description")
    r = r.withColumn("minutes", F.when(F.col("id") % 5 == 0, F.lit("n/a")).otherwise(F.col("minutes").cast("string")))
    out = A.enforce_contract(r)
    return out.select(*A.RECIPES_REQUIRED)


@register("validate_schema", _R + """SELECT false AS ok, 'description' AS missing, '' AS optional_present, count(*) AS rows, 10 AS cols FROM recipes""")
def q_validate_schema(spark, sf):
    r = P.recipes(spark, sf).drop("description")
    v = A.validate_schema(r)
    return v.select("ok", F.array_join("missing", ",").alias("missing"), F.array_join("optional_present", ",").alias("optional_present"),
                    "rows", "cols")


# ---------------------------------------------------------------- A6/A7 -----
@register("export_parquet_roundtrip", P.with_ctes(P.SQL_INTERACTIONS) + "SELECT * FROM interactions")
def q_export_parquet(spark, sf):
    from potluck.session import scratch_path

    path = scratch_path(spark, "export-parquet")
    A.export(P.interactions(spark, sf), path, "parquet")
    return spark.read.parquet(path)


@register("export_csv_roundtrip", _R + "SELECT id, name, to_json(tags) AS tags, minutes FROM recipes")
def q_export_csv(spark, sf):
    from potluck.session import scratch_path

    path = scratch_path(spark, "export-csv")
    A.export(P.recipes(spark, sf).select("id", "name", "tags", "minutes"), path, "csv")
    return spark.read.schema("id long, name string, tags string, minutes long").option("header", True) \
        .option("escape", '"').csv(path)


@register("export_clean_min", P.with_ctes(P.SQL_INTERACTIONS) + r"""SELECT user_id, recipe_id, date, rating, review,
  CAST(length(coalesce(review, '')) AS BIGINT) AS review_len,
  CAST(len(list_filter(regexp_split_to_array(coalesce(review, ''), '\s+'), lambda w: w <> '')) AS BIGINT) AS review_words,
  CAST(length(coalesce(review, '')) - length(replace(coalesce(review, ''), '!', '')) AS BIGINT) AS review_exclamations FROM interactions""")
def q_export_clean_min(spark, sf):
    return A.export_clean_min(P.interactions(spark, sf))

