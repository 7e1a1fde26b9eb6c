"""Registered enrichment, text, similarity, clustering and log queries
(F1-F18, G1-G8, H1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from potluck.operators import enrich as EN
from potluck.operators import similarity as SIM
from potluck.operators import text as TX
from potluck.plans import proxies as P
from potluck.plans import sql_clusters as SC
from potluck.plans import sql_fuzzy as SF
from potluck.plans.registry import register, rounded
from potluck.streaming import logs as LG

STOP_WORDS = ["the", "and", "of", "that", "with", "for"]

_R = P.with_ctes(P.SQL_RECIPES)
_GC = P.with_ctes(P.SQL_GEO, P.SQL_COUNTRY_REF)


def _names(spark, sf):
    return EN.reference_names(P.country_reference(spark, sf))


# ---------------------------------------------------------------- F1/F2 -----
@register("fuzzy_match", SF.FUZZY_MATCH)
def q_fuzzy_match(spark, sf):
    g = P.geo(spark, sf).select(F.explode("tokens").alias("token"))
    return rounded(EN.fuzzy_match(g, "token", _names(spark, sf).where("kind = 'country'")))


@register("fetch_reference", SF.FETCH_REFERENCE)
def q_fetch_reference(spark, sf):
    g = P.geo(spark, sf).select("id", "tokens", "segment")
    return EN.fetch_reference(g, ["tokens", "segment"], _names(spark, sf), countries=P.country_reference(spark, sf))


@register("fetch_country", SF.FETCH_COUNTRY)
def q_fetch_country(spark, sf):
    g = P.geo(spark, sf).select("id", F.col("tokens").alias("tags"))
    return EN.fetch_country(g, _names(spark, sf), P.country_reference(spark, sf))


@register("fetch_country_season", SF.FETCH_COUNTRY_SEASON)
def q_fetch_country_season(spark, sf):
    g = P.geo(spark, sf).select("id", F.array_union("tokens", F.array(F.lower("segment"))).alias("tags"),
                                F.col("segment").alias("name"),
                                F.concat(F.lit("a "), F.lower("segment"), F.lit(" dish for winter")).alias("description"))
    return EN.fetch_country_season(g, _names(spark, sf), P.country_reference(spark, sf))


@register("lookup_staged_fuzzy", SF.LOOKUP_STAGED)
def q_lookup_staged_fuzzy(spark, sf):
    return EN.lookup_staged_fuzzy(P.geo(spark, sf), "tags", P.country_reference(spark, sf))


# ---------------------------------------------------------------- F3 --------
@register("infer_parent", """SELECT s_suppkey AS id, lower(n_name) AS country, lower(r_name) AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_infer_parent(spark, sf):
    s, n, r = P.table(spark, sf, "supplier"), P.table(spark, sf, "nation"), P.table(spark, sf, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    d = j.select(F.col("s_suppkey").alias("id"), F.lower("n_name").alias("country"),
                 F.when(F.col("s_suppkey") % 2 == 0, F.lit("")).otherwise(F.lower("r_name")).alias("region"))
    return EN.infer_parent(d, P.country_reference(spark, sf))


# ---------------------------------------------------------------- F4/F6 -----
def _f4_sql(col: str, sfx: str) -> str:
    return f"""ex{sfx} AS (SELECT id, lower(unnest({col})) AS name, unnest(range(len({col}))) AS pos FROM geo),
m{sfx} AS (SELECT ex{sfx}.id, ex{sfx}.pos, dict.stage, dict.target_id FROM ex{sfx} JOIN dict ON ex{sfx}.name = dict.name),
c{sfx} AS (SELECT id, arg_min(target_id, pos * 10 + stage) FILTER (WHERE stage < 3) AS cid,
              coalesce(min(pos) FILTER (WHERE stage < 3), 1073741824) AS cpos FROM m{sfx} GROUP BY id),
r{sfx} AS (SELECT m{sfx}.id, arg_max(m{sfx}.target_id, m{sfx}.pos) AS rid FROM m{sfx} JOIN c{sfx} ON m{sfx}.id = c{sfx}.id
              WHERE m{sfx}.stage = 3 AND m{sfx}.pos < c{sfx}.cpos GROUP BY m{sfx}.id),
f{sfx} AS (SELECT geo.id, CAST(coalesce(c{sfx}.cid, -1) AS BIGINT) AS country_id, CAST(coalesce(r{sfx}.rid, -1) AS BIGINT) AS region_id
              FROM geo LEFT JOIN c{sfx} ON geo.id = c{sfx}.id LEFT JOIN r{sfx} ON geo.id = r{sfx}.id)"""


_DICT_SQL = """dict0 AS (SELECT lower(common_name) AS name, 0 AS stage, CAST(country_id AS BIGINT) AS target_id FROM country_ref
  UNION ALL SELECT lower(official_name), 1, country_id FROM country_ref
  UNION ALL SELECT lower(demonym), 2, country_id FROM country_ref
  UNION ALL SELECT name, 3, CAST(dense_rank() OVER (ORDER BY name) - 1 AS BIGINT) FROM (SELECT DISTINCT lower(region) AS name FROM country_ref)),
dict AS (SELECT name, stage, max(target_id) AS target_id FROM dict0 WHERE name IS NOT NULL AND name <> '' GROUP BY name, stage)"""


@register("lookup_exact", P.with_ctes(P.SQL_GEO, P.SQL_COUNTRY_REF, _DICT_SQL, _f4_sql("tags", "1")) + "SELECT * FROM f1")
def q_lookup_exact(spark, sf):
    return EN.lookup_exact(P.geo(spark, sf), "tags", P.country_reference(spark, sf))


@register("cascade_columns", P.with_ctes(P.SQL_GEO, P.SQL_COUNTRY_REF, _DICT_SQL, _f4_sql("tokens", "1"), _f4_sql("tags", "2"))
          + """SELECT f1.id, CASE WHEN f1.country_id <> -1 THEN f1.country_id ELSE f2.country_id END AS country_id,
  CASE WHEN f1.region_id <> -1 THEN f1.region_id ELSE f2.region_id END AS region_id FROM f1 JOIN f2 ON f1.id = f2.id""")
def q_cascade_columns(spark, sf):
    return EN.cascade_columns(P.geo(spark, sf), ["tokens", "tags"], P.country_reference(spark, sf))


# ---------------------------------------------------------------- F8 --------
@register("attach_dimension", _GC + """SELECT geo.country_id, geo.id, country_ref.name AS country_name,
  country_ref.region AS country_region, country_ref.subregion AS country_subregion
FROM geo LEFT JOIN country_ref ON geo.country_id = country_ref.country_id""")
def q_attach_dimension(spark, sf):
    return EN.attach_dimension(P.geo(spark, sf).select("country_id", "id"), P.country_reference(spark, sf))


# ---------------------------------------------------------------- F9-F13 ----
# The proxy's tags and descriptions each hold one known word; what must come
# out of it is stated here word by word.
_WORDS_SQL = f"""WITH w AS (SELECT p_partkey AS id, {P._sql_list(P.TAG_WORDS)}[p_size % {len(P.TAG_WORDS)} + 1] AS tw,
  {P._sql_list(P.DESC_WORDS)}[p_partkey % {len(P.DESC_WORDS)} + 1] AS dw FROM part),
l AS (SELECT id, CASE WHEN tw IN ('winter', 'spring', 'summer', 'fall') THEN tw WHEN dw IN ('winter', 'spring', 'summer', 'fall') THEN dw ELSE '' END AS se,
  CASE WHEN tw IN ('christmas', 'easter', 'halloween') THEN tw WHEN dw = 'new-years' THEN dw ELSE '' END AS ev FROM w)"""
_LABEL_SQL = _WORDS_SQL + """, lab AS (SELECT id, ev AS event, CASE WHEN se <> '' THEN se WHEN ev IN ('christmas', 'new-years') THEN 'winter'
  WHEN ev = 'easter' THEN 'spring' WHEN ev = 'halloween' THEN 'fall' ELSE '' END AS season FROM l)"""


@register("extract_periods", _WORDS_SQL + """ SELECT id, CASE WHEN dw IN ('summer', 'winter', 'spring', 'new-years') THEN dw ELSE '' END AS found FROM w""")
def q_extract_periods(spark, sf):
    r = P.recipes(spark, sf)
    return r.select("id", F.array_join(EN.extract_periods(r, "description", EN.SEASONS + EN.EVENTS), ",").alias("found"))


@register("label_periods", _LABEL_SQL + " SELECT id, season, event FROM lab")
def q_label_periods(spark, sf):
    return EN.label_periods(P.recipes(spark, sf)).select("id", "season", "event")


@register("fetch_period", _LABEL_SQL + " SELECT id, season, event FROM lab WHERE season <> '' OR event <> ''")
def q_fetch_period(spark, sf):
    return EN.fetch_period(P.recipes(spark, sf)).select("id", "season", "event")


@register("label_periods_least_ambiguous", _WORDS_SQL + " SELECT id, se AS season, ev AS event FROM l")
def q_least_ambiguous(spark, sf):
    return EN.label_periods_least_ambiguous(P.recipes(spark, sf)).select("id", "season", "event")


# ---------------------------------------------------------------- F14/F15 ---
_MONTH_SEASON = ("CASE WHEN month({0}) IS NULL THEN NULL WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) IN (3, 4, 5) THEN 'spring' "
                 "WHEN month({0}) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END")


@register("season_masks", P.with_ctes(P.SQL_RECIPES, P.SQL_RECIPES_SEASONAL) + """, f AS (SELECT
  list_contains(tags, 'winter') AS w, list_contains(tags, 'spring') AS sp, list_contains(tags, 'summer') AS su, list_contains(tags, 'fall') AS fa,
  list_contains(tags, 'christmas') AS ch,
  regexp_matches(coalesce(name, ''), 'winter|spring|summer|fall') OR regexp_matches(coalesce(description, ''), 'winter|spring|summer|fall') AS txt
  FROM recipes_seasonal),
m AS (SELECT count(*) AS rows, count(*) FILTER (WHERE w) AS n_winter, count(*) FILTER (WHERE sp) AS n_spring,
  count(*) FILTER (WHERE su) AS n_summer, count(*) FILTER (WHERE fa) AS n_fall, count(*) FILTER (WHERE ch) AS n_christmas,
  count(*) FILTER (WHERE w OR sp OR su OR fa) AS n_any_season_tags, count(*) FILTER (WHERE w OR sp OR su OR fa OR txt) AS n_any_season_text,
  count(*) FILTER (WHERE w AND ch) AS n_winter_christmas FROM f)
SELECT *, round(n_any_season_tags / rows, 6) AS share_tags, round(n_any_season_text / rows, 6) AS share_text FROM m""")
def q_season_masks(spark, sf):
    return rounded(EN.season_masks(P.recipes_seasonal(spark, sf)))


@register("season_agreement", P.with_ctes(P.SQL_RECIPES, P.SQL_RECIPES_SEASONAL) + f""", f AS (SELECT {_MONTH_SEASON.format('submitted')} AS season,
  [t FOR t IN tags IF t IN ('winter', 'spring', 'summer', 'fall')] AS found FROM recipes_seasonal),
a AS (SELECT count(*) FILTER (WHERE len(found) > 0) AS tagged, count(*) FILTER (WHERE list_contains(found, season)) AS correct FROM f)
SELECT tagged, correct, round(correct / nullif(CAST(tagged AS DOUBLE), 0), 6) AS share FROM a""")
def q_season_agreement(spark, sf):
    return rounded(EN.season_agreement(P.recipes_seasonal(spark, sf)))


@register("season_from_date", "SELECT o_orderkey, " + _MONTH_SEASON.format("(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END)")
          + " AS season FROM orders")
def q_season_from_date(spark, sf):
    o = P.table(spark, sf, "orders")
    return o.select("o_orderkey", EN.season_from_date(F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate"))).alias("season"))


# ---------------------------------------------------------------- F16 -------
def _holiday_names(spark, sf):
    n, r, p = P.table(spark, sf, "nation"), P.table(spark, sf, "region"), P.table(spark, sf, "part")
    return (n.select(F.col("n_name").alias("name")).unionByName(r.select(F.col("r_name").alias("name")))
            .unionByName(p.select(F.concat(F.lower("p_type"), F.lit(" festival")).alias("name")).distinct()))


_HOL_SQL = _R + """, hol AS (SELECT lower(n_name) AS n FROM nation UNION ALL SELECT lower(r_name) FROM region
  UNION ALL SELECT DISTINCT lower(p_type) || ' festival' FROM part),
joined AS (SELECT array_to_string(list_sort(list(n)), ' ') AS j FROM hol),
tg AS (SELECT DISTINCT unnest(tags) AS tag FROM recipes)"""


@register("vocabulary_overlap_tags", _HOL_SQL + " SELECT tag FROM tg, joined WHERE tag IS NOT NULL AND instr(j, tag) > 0")
def q_vocab_tags(spark, sf):
    return EN.vocabulary_overlap(P.recipes(spark, sf), _holiday_names(spark, sf))[0]


@register("vocabulary_overlap_count", _HOL_SQL + " SELECT count(*) AS n_names_that_are_tags FROM (SELECT DISTINCT n FROM hol) WHERE n IN (SELECT tag FROM tg)")
def q_vocab_count(spark, sf):
    return EN.vocabulary_overlap(P.recipes(spark, sf), _holiday_names(spark, sf))[1]


# ---------------------------------------------------------------- F17 -------
def _centroids(spark, sf):
    n = P.table(spark, sf, "nation")
    return n.select(F.when(F.col("n_nationkey") % 7 == 0, F.concat(F.lit("atlantis_"), F.col("n_nationkey").cast("string")))
                    .otherwise(F.concat(F.upper("n_name"), F.lit(" "))).alias("country"),
                    ((F.col("n_nationkey") % 5) * 10.0 + 5).alias("lat"), (F.col("n_regionkey") * 30.0 - 60).alias("lon"))


@register("map_bubbles", P.with_ctes(P.SQL_GEO) + """, cnt AS (SELECT country, count(*) AS count_recipes FROM geo GROUP BY country),
cen AS (SELECT CASE WHEN n_nationkey % 7 = 0 THEN 'atlantis_' || CAST(n_nationkey AS VARCHAR) ELSE upper(n_name) || ' ' END AS country,
               (n_nationkey % 5) * 10.0 + 5 AS lat, n_regionkey * 30.0 - 60 AS lon FROM nation),
j AS (SELECT cnt.country, cnt.count_recipes, cen.lat, cen.lon, sqrt(cnt.count_recipes) AS x
      FROM cnt JOIN cen ON lower(trim(cnt.country)) = lower(trim(cen.country))),
st AS (SELECT min(x) AS mn, max(x) AS mx, avg(lat) AS clat, avg(lon) AS clon FROM j)
SELECT country, count_recipes, round(lat, 6) AS lat, round(lon, 6) AS lon,
  round(CASE WHEN abs(mx - mn) <= 1e-8 + 1e-5 * abs(mn) THEN 23.0 ELSE 6.0 + (x - mn) / (mx - mn) * 34.0 END, 6) AS radius,
  CASE WHEN count_recipes < 10 THEN 'red' WHEN count_recipes < 30 THEN 'yellow' WHEN count_recipes <= 50 THEN 'blue' ELSE 'green' END AS color_class,
  round(clat, 6) AS center_lat, round(clon, 6) AS center_lon FROM j, st""")
def q_map_bubbles(spark, sf):
    from potluck.operators.aggregates import count_by_dimension

    counts = count_by_dimension(P.geo(spark, sf), "country").select("country", F.col("n").alias("count_recipes"))
    return rounded(EN.map_bubbles(counts, _centroids(spark, sf)))


# ---------------------------------------------------------------- G7 --------
@register("extract_time_tags", _R + " SELECT id, n_steps || '-minutes' AS time_tags_str FROM recipes")
def q_extract_time_tags(spark, sf):
    return TX.extract_time_tags(P.recipes(spark, sf)).select("id", "time_tags_str")


# ---------------------------------------------------------------- G1 --------
def _tfidf_sql(items_sql: str, top_n: int = 10, groups: str = "SELECT DISTINCT name AS g FROM recipes") -> str:
    return items_sql + f""",
c AS (SELECT g, term, count(*) AS cnt FROM items WHERE g IS NOT NULL AND term IS NOT NULL GROUP BY g, term),
ng AS (SELECT count(g) AS n FROM ({groups})),
dfc AS (SELECT term, count(*) AS df, sum(cnt) AS total FROM c GROUP BY term),
vocab AS (SELECT term, df, n FROM dfc, ng WHERE df <= 0.5 * n ORDER BY total DESC, term LIMIT 14000),
w AS (SELECT c.g, c.term, c.cnt, c.cnt * (ln((1 + n) / (1 + vocab.df)) + 1) AS raw FROM c JOIN vocab ON c.term = vocab.term),
nr AS (SELECT g, sqrt(sum(raw * raw)) AS l2, sum(cnt) AS l1 FROM w GROUP BY g),
s AS (SELECT w.g, w.term, raw / l2 AS tfidf, cnt / l1 AS tf FROM w JOIN nr ON w.g = nr.g WHERE raw / l2 > 0)
SELECT g AS grp, term, round(tfidf, 6) AS tfidf, round(tf, 6) AS tf, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY tfidf DESC, term) AS rank FROM s) WHERE rank <= {top_n}"""


@register("signature_tfidf", _tfidf_sql(_R + ", items AS (SELECT name AS g, unnest(tags) AS term FROM recipes)"))
def q_signature_tfidf(spark, sf):
    r = P.recipes(spark, sf).select(F.col("name").alias("grp"), "tags")
    return rounded(TX.signature_tfidf(r, "grp", "tags", top_n=10))


@register("signature_tfidf_docs", _tfidf_sql("""WITH items AS (SELECT g, term FROM (
  SELECT source AS g, unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM documents) WHERE term <> '')""", groups="SELECT DISTINCT source AS g FROM documents"))
def q_signature_tfidf_docs(spark, sf):
    d = P.table(spark, sf, "documents").select(
        F.col("source").alias("grp"), F.filter(F.split(F.lower("text"), r"\s+"), lambda t: t != "").alias("words"))
    return rounded(TX.signature_tfidf(d, "grp", "words", top_n=10))


_LOCATED_SQL = P.with_ctes(P.SQL_RECIPES, P.SQL_RECIPES_LOCATED)


@register("signature_by_country", _tfidf_sql(_LOCATED_SQL + ", items AS (SELECT country AS g, unnest(ingredients) AS term FROM recipes_located)",
                                             groups="SELECT DISTINCT country AS g FROM recipes_located"))
def q_signature_by_country(spark, sf):
    r = P.recipes_located(spark, sf).select(F.col("country").alias("grp"), "ingredients")
    return rounded(TX.signature_tfidf(r, "grp", "ingredients", top_n=10))


@register("signature_by_season", _tfidf_sql(_LOCATED_SQL + ", items AS (SELECT season AS g, unnest(ingredients) AS term FROM recipes_located)",
                                            groups="SELECT DISTINCT season AS g FROM recipes_located"))
def q_signature_by_season(spark, sf):
    r = P.recipes_located(spark, sf).select(F.col("season").alias("grp"), "ingredients")
    return rounded(TX.signature_tfidf(r, "grp", "ingredients", top_n=10))


# ---------------------------------------------------------------- G6/F18 ----
def _cos_sql(tokens_sql: str, top_n: int) -> str:
    return f""", toks AS (SELECT id, unnest({tokens_sql}) AS term FROM recipes),
tf AS (SELECT id, term, count(*) AS tf FROM toks WHERE term IS NOT NULL AND term <> '' GROUP BY id, term),
n2 AS (SELECT id, sum(tf * tf) AS n2 FROM tf GROUP BY id),
dot AS (SELECT a.id, b.id AS neighbor_id, sum(a.tf * b.tf) AS dot FROM tf a JOIN tf b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2),
s AS (SELECT dot.id, dot.neighbor_id, dot / sqrt(CAST(na.n2 AS DOUBLE) * nb.n2) AS score
      FROM dot JOIN n2 na ON na.id = dot.id JOIN n2 nb ON nb.id = dot.neighbor_id WHERE dot > 0),
top AS (SELECT id, neighbor_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, neighbor_id) AS rank FROM s) WHERE rank <= {top_n})"""


_ING_TOK = ("list_filter(string_split(array_to_string(list_filter(list_transform(ingredients, lambda t: lower(trim(t))), "
            "lambda t: t IS NOT NULL AND t <> ''), ' '), ' '), lambda t: t <> '')")
_TIME_TOK = "[n_steps || '-minutes']"


@register("cosine_topk_ingredients", _R + _cos_sql(_ING_TOK, 25) + " SELECT id, neighbor_id, round(score, 6) AS score, rank FROM top")
def q_cos_ingredients(spark, sf):
    r = P.recipes(spark, sf).select("id", SIM.ingredient_tokens("ingredients").alias("tokens"))
    return rounded(SIM.cosine_topk_tokens(r, top_n=25))


@register("cosine_topk_time_tags", _R + _cos_sql(_TIME_TOK, 10) + " SELECT id, neighbor_id, round(score, 6) AS score, rank FROM top")
def q_cos_time(spark, sf):
    r = P.recipes(spark, sf)
    r = r.select("id", SIM.hyphen_tokens(F.array_join(TX.time_tags("tags"), " ")).alias("tokens"))
    return rounded(SIM.cosine_topk_tokens(r, top_n=10))


@register("cosine_topk_combined", _R + _cos_sql(f"list_concat({_TIME_TOK}, {_ING_TOK})", 10)
          + " SELECT id, neighbor_id, round(score, 6) AS score, rank FROM top")
def q_cos_combined(spark, sf):
    from potluck.operators.cleaning import merge_features

    r = P.recipes(spark, sf)
    feat = merge_features(TX.time_tags("tags"), SIM.ingredient_tokens("ingredients"))
    r = r.select("id", F.filter(F.split(F.lower(feat), " "), lambda t: t != "").alias("tokens"))
    return rounded(SIM.cosine_topk_tokens(r, top_n=10))


def _asked(spark, sf):
    """The items whose neighbours are looked up: every 100th."""
    return P.table(spark, sf, "part").where(F.col("p_partkey") % 100 == 0).select(F.col("p_partkey").alias("id"))


@register("cosine_query_ingredients", _R + _cos_sql(_ING_TOK, 25) + " SELECT id, neighbor_id, round(score, 6) AS score, rank FROM top WHERE id % 100 = 0")
def q_cos_query_ingredients(spark, sf):
    r = P.recipes(spark, sf).select("id", SIM.ingredient_tokens("ingredients").alias("tokens"))
    return rounded(SIM.cosine_topk_tokens(r, top_n=25, query_ids=_asked(spark, sf)))


@register("cosine_query_time_tags", _R + _cos_sql(_TIME_TOK, 5) + " SELECT id, neighbor_id, round(score, 6) AS score, rank FROM top WHERE id % 100 = 0")
def q_cos_query_time(spark, sf):
    r = P.recipes(spark, sf)
    r = r.select("id", SIM.hyphen_tokens(F.array_join(TX.time_tags("tags"), " ")).alias("tokens"))
    return rounded(SIM.cosine_topk_tokens(r, top_n=5, query_ids=_asked(spark, sf)))


@register("neighbors_with_metadata", _R + _cos_sql(_ING_TOK, 5) + """ SELECT top.id, top.neighbor_id, round(top.score, 6) AS score, top.rank,
  r.name AS neighbor_name, r.minutes AS neighbor_minutes FROM top LEFT JOIN recipes r ON r.id = top.neighbor_id WHERE top.id % 100 = 0""")
def q_neighbors_meta(spark, sf):
    items = P.recipes(spark, sf)
    r = items.select("id", SIM.ingredient_tokens("ingredients").alias("tokens"))
    nb = SIM.cosine_topk_tokens(r, top_n=5, query_ids=_asked(spark, sf))
    return rounded(EN.neighbors_with_metadata(nb, items))


# ---------------------------------------------------------------- G8 --------
_NC = P.NUTRITION_COLS


def _cos_numeric_sql(asked: str) -> str:
    """The 10 nearest by standardised nutrition, of the rows that ``asked`` marks."""
    return (P.with_ctes(P.SQL_NUTRITION) + ", keep AS (SELECT * FROM nutrition WHERE "
            + " OR ".join(f"{c} IS NOT NULL" for c in _NC) + "),\nf AS (SELECT id, "
            + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _NC) + " FROM keep),\nst AS (SELECT "
            + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NC) + " FROM f),\nz AS (SELECT id, "
            + ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" for c in _NC) + " FROM f, st),\n"
            + "nz AS (SELECT *, sqrt(" + " + ".join(f"{c} * {c}" for c in _NC) + ") AS nrm FROM z),\n"
            + "s AS (SELECT a.id, b.id AS neighbor_id, (" + " + ".join(f"a.{c} * b.{c}" for c in _NC)
            + ") / ((CASE WHEN a.nrm = 0 THEN 1.0 ELSE a.nrm END) * (CASE WHEN b.nrm = 0 THEN 1.0 ELSE b.nrm END)) AS score "
            + f"FROM nz a JOIN nz b ON a.id <> b.id AND {asked})\n"
            + """SELECT id, neighbor_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, neighbor_id) AS rank FROM s) WHERE rank <= 10""")


@register("cosine_topk_numeric", _cos_numeric_sql("a.id % 50 = 0"))
def q_cos_numeric(spark, sf):
    asked = P.table(spark, sf, "embeddings").where(F.col("vec_id") % 50 == 0).select("vec_id")
    return rounded(SIM.cosine_topk_numeric(P.nutrition(spark, sf), _NC, top_n=10, query_ids=asked))


@register("cosine_topk_numeric_all", _cos_numeric_sql("true"))
def q_cos_numeric_all(spark, sf):
    """The neighbours of every item (a tree of cells)."""
    return rounded(SIM.cosine_topk_numeric(P.nutrition(spark, sf), _NC, top_n=10, block_rows=1024))


# ---------------------------------------------------------------- G2-G5 -----
def _docs_text(spark, sf):
    return P.table(spark, sf, "documents").select("doc_id", "text")


def _model(spark, sf):
    """TF-IDF and k-means over all documents."""
    from potluck.operators import clustering as CL

    docs = _docs_text(spark, sf)
    return docs, *CL.kmeans_text(docs, "text", k=6, id_col="doc_id")


@register("tfidf_weights", """WITH t AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
c AS (SELECT id, term, count(*) AS cnt FROM t WHERE NOT list_contains(%s, term) GROUP BY 1, 2),
v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf, sum(cnt) AS total FROM c GROUP BY term
      ORDER BY total DESC, term LIMIT 8000),
r AS (SELECT id, c.term, cnt * idf AS raw FROM c JOIN v ON c.term = v.term)
SELECT id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)), 6) AS weight FROM r""" % (
    "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"))
def q_tfidf_weights(spark, sf):
    from potluck.operators import clustering as CL

    return rounded(CL.tfidf_weights(_docs_text(spark, sf), "doc_id", "text", stop_words=STOP_WORDS))


@register("kmeans_text", "SELECT count(*) AS n_docs, CAST(0 AS BIGINT) AS n_not_nearest FROM documents")
def q_kmeans_text(spark, sf):
    """Documents of the model, and how many are not in their nearest cluster."""
    from potluck.operators import clustering as CL

    docs, tfidf, km = _model(spark, sf)
    return CL.not_nearest(docs, tfidf, km, "doc_id", "text")


def _clusters(spark, sf):
    """Lloyd steps in whole numbers over all documents; fitted once, then read."""
    from potluck.operators import text_clusters as TC

    return TC.fit_text_clusters(_docs_text(spark, sf), "doc_id", "text", k=6, stop_words=STOP_WORDS)


_CLUSTERS_SQL = SC.text_clusters(k=6, max_features=8000, steps=10, stop_words=STOP_WORDS)


@register("assign_clusters", _CLUSTERS_SQL + " SELECT id AS doc_id, CAST(cluster AS INTEGER) AS cluster FROM own")
def q_assign_clusters(spark, sf):
    from potluck.operators import text_clusters as TC

    return TC.assign_text_clusters(_docs_text(spark, sf), _clusters(spark, sf), "doc_id", "text").select("doc_id", "cluster")


@register("cluster_sizes", _CLUSTERS_SQL + """ SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n_docs,
  round(CAST(sum(d) AS DOUBLE) / 1099511627776.0, 6) AS inertia FROM own GROUP BY 1""")
def q_cluster_sizes(spark, sf):
    """Texts and squared distances of each cluster."""
    from potluck.operators import text_clusters as TC

    own = TC.assign_text_clusters(_docs_text(spark, sf), _clusters(spark, sf), "doc_id", "text")
    return rounded(own.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("distance").alias("inertia")))


@register("top_terms_per_cluster", _CLUSTERS_SQL + """ SELECT CAST(cluster AS INTEGER) AS cluster, string_agg(term, ', ' ORDER BY r) AS top_terms FROM (
  SELECT c.cluster, v.term, row_number() OVER (PARTITION BY c.cluster ORDER BY c.c DESC, v.term) AS r
  FROM centers c JOIN v ON v.t = c.t WHERE c.c > 0) WHERE r <= 10 GROUP BY 1""")
def q_top_terms(spark, sf):
    from potluck.operators import text_clusters as TC

    return TC.center_terms(_clusters(spark, sf), n=10)


@register("project_2d")
def q_project_2d(spark, sf):
    from potluck.operators import clustering as CL

    return CL.project_2d(_docs_text(spark, sf), id_col="doc_id")


@register("singular_residuals", "SELECT 1 AS component, 0.0::DOUBLE AS residual UNION ALL SELECT 2, 0.0")
def q_singular_residuals(spark, sf):
    """How far the two components are from singular vectors of the TF-IDF rows."""
    from potluck.operators import clustering as CL

    return rounded(CL.singular_residuals(_docs_text(spark, sf), id_col="doc_id"), 5)


# ---------------------------------------------------------------- H1 --------
_LINES_SQL = """WITH lines AS (SELECT event_id, ts, event_id % 50 = 0 AS odd, event_type,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
    event_type || ' value=' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' ' || props AS message, user_id FROM events),
p AS (SELECT event_id, ts, odd, CASE WHEN odd THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S,%g') END AS time,
    CASE WHEN odd THEN '' ELSE level END AS level, CASE WHEN odd THEN '' ELSE 'user.' || user_id END AS logger,
    CASE WHEN odd THEN '  Traceback of ' || event_type ELSE message END AS message FROM lines)"""
_COUNTS_SQL = _LINES_SQL + """ SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
  CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, level, count(*) AS n
FROM p WHERE NOT odd GROUP BY 1, 2, 3"""


def _event_lines(spark, sf):
    """Numbered log lines of the events; every 50th is a traceback line without fields."""
    odd = F.concat(F.lit("  Traceback of "), F.col("event_type"))
    return P.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 50 == 0, odd).otherwise(LG.event_line()).alias("value"), F.col("event_id").alias("line_no"))


def _log_lines(spark, sf):
    return LG.parse_logs(_event_lines(spark, sf))


@register("parse_logs", _LINES_SQL + " SELECT time, level, logger, message FROM p")
def q_parse_logs(spark, sf):
    return _log_lines(spark, sf).select("time", "level", "logger", "message")


@register("filter_logs", _LINES_SQL + """ SELECT time, level, logger, message FROM p
WHERE level IN ('ERROR', 'WARNING') AND instr(lower(concat_ws(' ', time, level, logger, message)), 'user.1') > 0""")
def q_filter_logs(spark, sf):
    return LG.filter_logs(_log_lines(spark, sf), levels=["ERROR", "WARNING"], query="USER.1").select(
        "time", "level", "logger", "message")


@register("log_tail", _LINES_SQL + """ SELECT event_id, time, level, logger, message FROM
  (SELECT * FROM p ORDER BY event_id DESC LIMIT 2000) WHERE instr(lower(concat_ws(' ', time, level, logger, message)), 'trace') > 0 OR level = 'ERROR'""")
def q_log_tail(spark, sf):
    """The last 2000 lines; of these the errors and the traceback lines."""
    tail = LG.filter_logs(_log_lines(spark, sf), last_n=2000)
    both = LG.filter_logs(tail, levels=["ERROR"]).unionByName(LG.filter_logs(tail, query="Trace"))
    return both.select(F.col("line_no").alias("event_id"), "time", "level", "logger", "message")


@register("log_level_counts", _COUNTS_SQL)
def q_log_level_counts(spark, sf):
    return LG.level_counts(_log_lines(spark, sf), window="1 day")


@register("stream_log_level_counts", _COUNTS_SQL)
def q_stream_log_level_counts(spark, sf):
    """The log stream: lines derived from events land as text files in a folder;
    a Structured Streaming query with a watermark counts them per level and day."""
    from potluck.session import scratch_path

    base = scratch_path(spark, "log-stream")
    _event_lines(spark, sf).select("value").write.text(f"{base}/in")
    LG.run_to_table(LG.stream_level_counts(spark, f"{base}/in", window="1 day", watermark="1 day"), f"{base}/out", f"{base}/ckpt")
    return LG.latest_counts(spark, f"{base}/out")


@register("stream_log_tail", _LINES_SQL + """ SELECT time, level, logger, message FROM
  (SELECT * FROM p ORDER BY event_id DESC LIMIT 2000) WHERE level = 'ERROR'""")
def q_stream_log_tail(spark, sf):
    """The errors of the last 2000 lines, carried on over micro-batches of three files."""
    from potluck.session import scratch_path

    base = scratch_path(spark, "log-tail")
    lines = _event_lines(spark, sf).repartitionByRange(8, "line_no").sortWithinPartitions("line_no")
    lines.select("value").write.text(f"{base}/in")
    LG.run_tail(LG.stream_lines(spark, f"{base}/in", files_per_batch=3), f"{base}/out", f"{base}/ckpt", last_n=2000)
    return LG.filter_logs(LG.latest_tail(spark, f"{base}/out"), levels=["ERROR"]).select("time", "level", "logger", "message")


@register("signature_top3", _tfidf_sql(_R + ", items AS (SELECT name AS g, unnest(tags) AS term FROM recipes)", 3).replace(
    "SELECT g AS grp, term, round(tfidf, 6) AS tfidf, round(tf, 6) AS tf, CAST(rank AS INTEGER) AS rank FROM (",
    "SELECT grp, string_agg(term, ', ' ORDER BY rank) AS top_terms FROM (SELECT g AS grp, term, rank FROM (") + ") GROUP BY grp")
def q_signature_top3(spark, sf):
    r = P.recipes(spark, sf).select(F.col("name").alias("grp"), "tags")
    return TX.signature_views(TX.signature_tfidf(r, "grp", "tags", top_n=3), "grp", k=3)
