"""Reference-data enrichment: fuzzy and exact country lookup, region
inference, season/event labelling, vocabulary overlap, map bubbles (F1-F18).

Plans
-----
* Fuzzy matching scores every *distinct* token once, in a map-side scan: tasks
  index the reference names (broadcast in chunks of a checked size) and score
  a token only with names that can win.  Matches are joined back on the token
  and reduced per row with ``min_by``.
* Exact lookups explode all columns at once, join the name dictionary and
  reduce once per row: one scan and one shuffle of the main table.
* Joins carry no broadcast hints: AQE measures the reference side.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potluck.functions.fuzzy import NameIndex
from potluck.operators.chunks import chunks
from potluck.operators.common import with_index

# ----------------------------------------------------------------------------
# Fixed values (must equal the original behaviour)
# ----------------------------------------------------------------------------
SEASONS = ["winter", "spring", "summer", "fall"]
# Events of the labelling service, with both spellings found in the original
# (its handler spells "new_years" and "independance-day").
EVENTS = ["christmas", "halloween", "thanksgiving", "valentines-day", "new_years", "new-years",
          "easter", "independance-day", "independence-day"]
EVENT_SEASON = {
    "christmas": "winter", "halloween": "fall", "thanksgiving": "fall", "valentines-day": "winter",
    "new_years": "winter", "new-years": "winter", "easter": "spring",
    "independance-day": "summer", "independence-day": "summer",
}
# The 26 events of the least-ambiguous rule, in their original order.
EVENTS_26 = [
    "april-fools-day", "birthday", "chinese-new-year", "christmas", "cinco-de-mayo", "easter",
    "fathers-day", "hanukkah", "halloween", "holiday-event", "independence-day",
    "irish-st-patricks-day", "kwanzaa", "labor-day", "mardi-gras-carnival", "memorial-day",
    "mothers-day", "new-years", "passover", "ramadan", "rosh-hashanah", "st-patricks-day",
    "super-bowl", "thanksgiving", "valentines-day", "wedding",
]
# Demonym whose best match maps to a different country name.
DEMONYM_OVERRIDES = {"american": "united states"}


# ---------------------------------------------------------------- F1 --------
REFERENCE = "kind string, grp int, pos long, ref string, name string"
MATCH = "token string, kind string, grp int, pos long, ref string, name string, score double, scored long"


def _reference_rows(spark, kind: str, groups: Sequence[Sequence[str]]) -> DataFrame:
    rows = [(kind, g, i, x, groups[0][i]) for g, names in enumerate(groups) for i, x in enumerate(names)]
    return spark.createDataFrame(rows, REFERENCE)


def reference_names(countries: DataFrame, order: str = "country_id") -> DataFrame:
    """Names to match, as rows (kind, grp, pos, ref, name): for countries their
    names (grp 0) and demonyms (grp 1), both standing for the name, in the
    order of ``order``; for regions their names in alphabetical order."""
    c = countries.select(F.col(order).cast("long").alias("pos"), F.lower(F.coalesce("name", F.lit(""))).alias("name"),
                         F.lower(F.coalesce("demonym", F.lit(""))).alias("demonym"), F.lower(F.coalesce("region", F.lit(""))).alias("region"))
    regions = c.select("region").distinct().select(
        F.lit("region").alias("kind"), F.lit(0).alias("grp"),
        F.row_number().over(Window.orderBy("region")).cast("long").alias("pos"), F.col("region").alias("ref"), F.col("region").alias("name"))
    return (c.select(F.lit("country").alias("kind"), F.lit(0).alias("grp"), "pos", F.col("name").alias("ref"), "name")
            .unionByName(c.select(F.lit("country").alias("kind"), F.lit(1).alias("grp"), "pos", F.col("demonym").alias("ref"), "name"))
            .unionByName(regions))


def best_matches(tokens: DataFrame, refs: DataFrame, *, scorer: str = "mean_token", clean_dash: bool = True,
                 max_bytes: int | None = None) -> DataFrame:
    """Best reference of each kind per distinct token (first column of
    ``tokens``): (token, kind, pos, ref, name, score, scored); of equal scores
    the first in (grp, pos) order wins.  Empty tokens have no row.  ``scored``:
    names of that kind the token was compared with.

    The references are collected in chunks of a checked size when this is
    called; every task of the distinct tokens indexes them once.
    """
    q = tokens.select(F.col(tokens.columns[0]).alias("token")).where("token is not null and token <> ''").distinct()
    found = None
    many = 0
    for names in chunks(refs, max_bytes):
        part = q.mapInArrow(_scan(names, scorer, clean_dash), MATCH)
        found = part if found is None else found.unionByName(part)
        many += 1
    if many > 1:  # the best over the chunks
        first = F.struct(-F.col("score"), F.col("grp"), F.col("pos"))
        found = found.groupBy("token", "kind").agg(*[F.min_by(c, first).alias(c) for c in ("grp", "pos", "ref", "name", "score")], F.sum("scored").alias("scored"))
    return found.drop("grp")


def _scan(names, scorer: str, clean_dash: bool):
    def run(batches):
        kinds = [(kind, list(part[["grp", "pos", "ref", "name"]].itertuples(index=False, name=None)), NameIndex(part["ref"].tolist(), scorer))
                 for kind, part in names.value.sort_values(["grp", "pos"], kind="stable").groupby("kind", sort=True)]
        for batch in batches:
            out = {f.split()[0]: [] for f in MATCH.split(", ")}
            for token in batch.column(0).to_pylist():
                for kind, part, index in kinds:
                    met = index.scored
                    i, score = index(token.replace("-", " ") if clean_dash else token)
                    row = (token, kind, *part[i], score, index.scored - met)
                    for column, v in zip(out.values(), row):
                        column.append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("token", pa.string()), ("kind", pa.string()), ("grp", pa.int32()), ("pos", pa.int64()), ("ref", pa.string()), ("name", pa.string()),
                ("score", pa.float64()), ("scored", pa.int64())]))
    return run


def _country_of(ref: Column, name: Column) -> Column:
    """The name a match stands for (a few demonyms stand for another one)."""
    for demonym, country in DEMONYM_OVERRIDES.items():
        name = F.when(ref == demonym, F.lit(country)).otherwise(name)
    return name


def fuzzy_match(df: DataFrame, col: str, refs: DataFrame | Sequence[Sequence[str]], *, threshold: float = 80,
                scorer: str = "mean_token") -> DataFrame:
    """Best reference per distinct value of ``col``: (col, match, score).

    ``refs``: rows of one kind as ``reference_names`` makes them, or parallel
    name lists (e.g. countries and demonyms).  The best match over all of them
    (first wins ties) gives its name; below ``threshold`` the match is "".
    """
    if not isinstance(refs, DataFrame):
        refs = _reference_rows(df.sparkSession, "x", refs)
    values = df.select(F.col(col).alias("value")).where(F.col(col).isNotNull()).distinct()
    m = best_matches(values, refs, scorer=scorer)
    j = values.join(m, F.col("value") == F.col("token"), "left")
    match = F.when(F.col("score") >= threshold, _country_of(F.col("ref"), F.col("name"))).otherwise(F.lit(""))
    return j.select(F.col("value").alias(col), match.alias("match"), F.coalesce("score", F.lit(0.0)).alias("score"))


# ---------------------------------------------------------------- F2 --------
def _tokens(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.ArrayType):
        return F.coalesce(F.col(col), F.array().cast(dt))
    return F.split(F.trim(F.coalesce(F.col(col), F.lit(""))), r"\s+")


def _exploded(df: DataFrame, columns: Sequence[str], id_col: str, outer: bool = False) -> DataFrame:
    """(_id, _ci, _pos, _tok): the tokens of all columns, from one scan."""
    def numbered(ci: int, c: str) -> Column:
        return F.transform(_tokens(df, c), lambda t, i: F.struct(F.lit(ci).alias("ci"), i.alias("pos"), t.alias("tok")))

    parts = [numbered(ci, c) for ci, c in enumerate(columns)]
    many = F.filter(F.concat(*parts), lambda x: x["tok"].isNotNull() & (x["tok"] != ""))
    ex = df.select(F.col(id_col).alias("_id"), (F.explode_outer(many) if outer else F.explode(many)).alias("_x"))
    return ex.select("_id", F.col("_x.ci").alias("_ci"), F.col("_x.pos").alias("_pos"), F.col("_x.tok").alias("_tok"))


def fetch_reference(df: DataFrame, columns: Sequence[str], names: DataFrame, *, id_col: str = "id",
                    countries: DataFrame | None = None, threshold: float = 80) -> DataFrame:
    """Add ``country`` and ``region`` found in the tokens of ``columns``.

    Per row and reference kind, the first token with score 100 (in column,
    then token order) wins, else the highest-scoring matched token (first
    wins).  Existing non-empty ``country``/``region`` values are kept.  Empty
    regions are then inferred from the country (F3) when ``countries`` is
    given.  ``id_col`` must identify rows.
    """
    ex = _exploded(df, columns, id_col)
    m = best_matches(ex.select("_tok"), names).where(F.col("score") >= threshold)
    j = ex.join(m, ex["_tok"] == m["token"]).withColumn("match", _country_of(F.col("ref"), F.col("name")))
    key = F.struct(F.col("_ci"), (F.col("score") < 100).alias("_n"),
                   F.when(F.col("score") < 100, -F.col("score")).otherwise(F.lit(0.0)).alias("_s"), F.col("_pos"))
    best = j.groupBy("_id").agg(*[F.min_by(F.when(F.col("kind") == k, F.col("match")), F.when(F.col("kind") == k, key)).alias(f"_{k}")
                                  for k in ("country", "region")])
    out = df.join(best, F.col(id_col) == best["_id"], "left").drop("_id")
    for kind in ("country", "region"):
        found = F.coalesce(F.col(f"_{kind}"), F.lit(""))
        if kind in df.columns:
            keep = F.col(kind).isNotNull() & (F.col(kind) != "")
            found = F.when(keep, F.col(kind)).otherwise(found)
        out = out.withColumn(kind, found).drop(f"_{kind}")
    if countries is not None:
        out = infer_parent(out, countries)
    return out


# ---------------------------------------------------------------- F3 --------
def infer_parent(df: DataFrame, countries: DataFrame, *, child: str = "country", parent: str = "region") -> DataFrame:
    """Empty ``parent`` -> the reference parent of ``child`` (lower case), else ""."""
    ref = countries.select(F.lower("name").alias("_cn"), F.lower(F.col("region")).alias("_pr")).dropDuplicates(["_cn"])
    j = df.join(ref, F.col(child) == F.col("_cn"), "left")
    empty = F.col(parent).isNull() | (F.col(parent) == "")
    return j.withColumn(parent, F.when(empty, F.coalesce(F.col("_pr"), F.lit(""))).otherwise(F.col(parent))).drop("_cn", "_pr")


# ---------------------------------------------------------------- F4 --------
def name_dictionary(countries: DataFrame) -> DataFrame:
    """(name, stage, target_id): common=0, official=1, demonym=2 -> country id;
    region=3 -> region id (dense rank of the sorted region names)."""
    c = countries
    parts = [
        c.select(F.lower("common_name").alias("name"), F.lit(0).alias("stage"), F.col("country_id").cast("long").alias("target_id")),
        c.select(F.lower("official_name").alias("name"), F.lit(1).alias("stage"), F.col("country_id").cast("long").alias("target_id")),
        c.select(F.lower("demonym").alias("name"), F.lit(2).alias("stage"), F.col("country_id").cast("long").alias("target_id")),
    ]
    regions = c.select(F.lower("region").alias("name")).distinct()
    regions = regions.select("name", F.lit(3).alias("stage"),
                             (F.dense_rank().over(Window.orderBy("name")) - 1).cast("long").alias("target_id"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(regions)
    # a name listed twice keeps one target (largest id, deterministic)
    return out.where(F.col("name").isNotNull() & (F.col("name") != "")).groupBy("name", "stage").agg(
        F.max("target_id").alias("target_id"))


def cascade_columns(df: DataFrame, columns: Sequence[str], countries: DataFrame, *, id_col: str = "id") -> DataFrame:
    """Per row: the first column whose tokens give a country, and the first
    that gives a region (see ``lookup_exact``).  All columns are exploded and
    looked up together: one scan, one dictionary, one shuffle on the id.
    Columns: id, country_id, region_id."""
    ex = _exploded(df, columns, id_col, outer=True)
    d = name_dictionary(countries)
    j = ex.join(d, F.lower(ex["_tok"]) == d["name"], "left")
    g = j.groupBy("_id").agg(F.collect_list(F.when(F.col("stage").isNotNull(), F.struct("_ci", "_pos", "stage", "target_id"))).alias("_m"))
    cid = rid = F.lit(-1).cast("long")

    def found(ci: int) -> tuple[Column, Column]:
        own = F.filter("_m", lambda x: x["_ci"] == ci)
        first = F.array_min(F.transform(F.filter(own, lambda x: x["stage"] < 3), lambda x: F.struct(x["_pos"], x["stage"], x["target_id"])))
        before = F.coalesce(first["_pos"], F.lit(1 << 30))
        regions = F.filter(own, lambda x: (x["stage"] == 3) & (x["_pos"] < before))
        return first["target_id"], F.array_max(F.transform(regions, lambda x: F.struct(x["_pos"], x["target_id"])))["target_id"]

    for ci in reversed(range(len(columns))):
        country, region = found(ci)
        cid, rid = F.coalesce(country, cid), F.coalesce(region, rid)
    return g.select(F.col("_id").alias(id_col), cid.cast("long").alias("country_id"), rid.cast("long").alias("region_id"))


def lookup_exact(df: DataFrame, tokens_col: str, countries: DataFrame, *, id_col: str = "id") -> DataFrame:
    """Per row: the first token (list order) equal to a common name, else an
    official name, else a demonym gives the country id; a region token seen
    before that (the latest one) gives the region id.  -1 when unknown.
    Columns: id, country_id, region_id."""
    return cascade_columns(df, [tokens_col], countries, id_col=id_col)


# ---------------------------------------------------------------- F5 --------
def lookup_staged_fuzzy(df: DataFrame, tokens_col: str, countries: DataFrame, *, id_col: str = "id",
                        threshold: float = 80) -> DataFrame:
    """Plain-ratio lookup in stages common -> official -> demonym: the best
    (token, name) pair of the first stage scoring >= threshold gives the
    country id; the region (numbered in alphabetical order) is the best region
    name >= threshold.  Equal scores: first token, then first name.  -1 when
    unknown.  Columns: id, country_id, region_id."""
    c = countries.select(F.col("country_id").cast("long").alias("pos"), *[
        F.lower(F.coalesce(F.col(x), F.lit(""))).alias(x) for x in ("common_name", "official_name", "demonym", "region")])
    stages = ["common_name", "official_name", "demonym"]
    refs = c.select(F.explode(F.array(*[F.struct(F.lit(x).alias("kind"), F.lit(0).alias("grp"), F.col("pos").alias("pos"), F.col(x).alias("ref"),
                                                 F.col(x).alias("name")) for x in stages])).alias("r")).select("r.*")
    regions = c.select("region").distinct().select(
        F.lit("region").alias("kind"), F.lit(0).alias("grp"),
        (F.row_number().over(Window.orderBy("region")) - 1).cast("long").alias("pos"), F.col("region").alias("ref"), F.col("region").alias("name"))
    lowered = df.select(F.col(id_col).alias("_id"), F.transform(tokens_col, lambda t: F.lower(t)).alias("_l"))
    ex = _exploded(lowered, ["_l"], "_id", outer=True)
    m = best_matches(ex.select("_tok"), refs.unionByName(regions), scorer="ratio", clean_dash=False).where(F.col("score") >= threshold)
    j = ex.join(m, ex["_tok"] == m["token"], "left")
    best = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.col("pos")),
                                 F.when(F.col("kind") == kind, F.struct(-F.col("score"), F.col("_pos"))))
    g = j.groupBy("_id").agg(*[best(k).alias(k) for k in [*stages, "region"]])
    unknown = F.lit(-1).cast("long")
    return g.select(F.col("_id").alias(id_col), F.coalesce(*stages, unknown).alias("country_id"), F.coalesce("region", unknown).alias("region_id"))


# ---------------------------------------------------------------- F7 --------
def fetch_country(df: DataFrame, names: DataFrame, countries: DataFrame, *, columns: Sequence[str] = ("tags",),
                  id_col: str = "id") -> DataFrame:
    """Rows whose tags name a country, with country and region."""
    out = fetch_reference(df, list(columns), names, id_col=id_col, countries=countries)
    return out.where(F.col("country") != "")


# ---------------------------------------------------------------- F8 --------
def attach_dimension(df: DataFrame, countries: DataFrame, *, key: str = "country_id") -> DataFrame:
    """country id -> country name, region and subregion."""
    ref = countries.select(F.col("country_id").alias(key), F.col("name").alias("country_name"),
                           F.col("region").alias("country_region"), F.col("subregion").alias("country_subregion"))
    return df.join(ref, key, "left")


# ---------------------------------------------------------------- F9-F11 ----
def _alternation(words: Sequence[str]) -> str:
    import re

    return "|".join(re.escape(w) for w in words)


def _text_of(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.ArrayType):
        return F.array_join(F.coalesce(F.col(col), F.array()), " ")
    return F.coalesce(F.col(col), F.lit(""))


def extract_periods(df: DataFrame, col: str, words: Sequence[str]) -> Column:
    """All occurrences of the words in the text (substring semantics), in order."""
    return F.regexp_extract_all(_text_of(df, col), F.lit(_alternation(words)), 0)


def prioritize_period(*matches: Column) -> Column:
    """First match of the first source that has one; "" if none."""
    return F.coalesce(*[F.try_element_at(m, F.lit(1)) for m in matches], F.lit(""))


def label_periods(df: DataFrame, *, sources: Sequence[str] = ("tags", "name", "description")) -> DataFrame:
    """Add ``season`` and ``event``: tags > name > description; a row without a
    season word takes the season of its event."""
    seasons = prioritize_period(*[extract_periods(df, s, SEASONS) for s in sources])
    events = prioritize_period(*[extract_periods(df, s, EVENTS) for s in sources])
    ev_map = F.create_map(*[x for kv in EVENT_SEASON.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = df.withColumn("event", events)
    from_event = F.coalesce(F.element_at(ev_map, F.col("event")), F.lit(""))
    return out.withColumn("season", F.when(seasons != "", seasons).otherwise(from_event))


# ---------------------------------------------------------------- F12 -------
def fetch_period(df: DataFrame, **kw) -> DataFrame:
    """Rows with a season or an event."""
    out = label_periods(df, **kw)
    return out.where((F.col("season") != "") | (F.col("event") != ""))


def fetch_country_season(df: DataFrame, names: DataFrame, countries: DataFrame, *, id_col: str = "id") -> DataFrame:
    """Rows with a country and a season or event."""
    return fetch_period(fetch_country(df, names, countries, id_col=id_col))


# ---------------------------------------------------------------- F13 -------
def _candidates(df: DataFrame, col: str, words: Sequence[str]) -> Column:
    """Words present in the source, in list order (element membership for
    lists, substring for text)."""
    dt = df.schema[col].dataType
    arr = F.array(*[F.lit(w) for w in words])
    if isinstance(dt, T.ArrayType):
        return F.filter(arr, lambda w: F.array_contains(F.coalesce(F.col(col), F.array()), w))
    return F.filter(arr, lambda w: F.instr(F.coalesce(F.col(col), F.lit("")), w) > 0)


def choose_least_ambiguous(df: DataFrame, words: Sequence[str], sources: Sequence[str] = ("tags", "name", "description")) -> Column:
    """The source with the fewest candidates wins (first on ties), but only if
    it has exactly one candidate; else ""."""
    cands = F.array(*[F.struct(F.size(_candidates(df, s, words)).alias("n"), F.lit(i).alias("i"),
                               F.try_element_at(_candidates(df, s, words), F.lit(1)).alias("first"))
                      for i, s in enumerate(sources)])
    best = F.array_min(F.filter(cands, lambda x: x["n"] > 0))
    return F.when(best.isNotNull() & (best["n"] == 1), best["first"]).otherwise(F.lit(""))


def label_periods_least_ambiguous(df: DataFrame, sources: Sequence[str] = ("tags", "name", "description")) -> DataFrame:
    return (df.withColumn("season", choose_least_ambiguous(df, SEASONS, sources))
              .withColumn("event", choose_least_ambiguous(df, EVENTS_26, sources)))


# ---------------------------------------------------------------- F14 -------
def season_masks(df: DataFrame, *, tags_col: str = "tags", text_cols: Sequence[str] = ("name", "description")) -> DataFrame:
    """One row: rows with each season / christmas among their tags, any season
    among the tags, any season among the tags or in the text (substring),
    winter and christmas, and shares."""
    tags = F.coalesce(F.col(tags_col), F.array().cast("array<string>"))
    tagged = lambda w: F.array_contains(tags, w)  # noqa: E731  a tag equals the word: "summer-squash" is no summer
    has = lambda t, w: F.instr(t, w) > 0
    any_tag = F.lit(False)
    for s in SEASONS:
        any_tag = any_tag | tagged(s)
    any_text = any_tag
    for c in text_cols:
        for s in SEASONS:
            any_text = any_text | has(_text_of(df, c), s)
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(tagged(s)).alias(f"n_{s}") for s in SEASONS]
    aggs += [F.count_if(tagged("christmas")).alias("n_christmas"),
             F.count_if(any_tag).alias("n_any_season_tags"), F.count_if(any_text).alias("n_any_season_text"),
             F.count_if(tagged("winter") & tagged("christmas")).alias("n_winter_christmas")]
    out = df.agg(*aggs)
    return out.select("*", (F.col("n_any_season_tags") / F.col("rows")).alias("share_tags"),
                      (F.col("n_any_season_text") / F.col("rows")).alias("share_text"))


# ---------------------------------------------------------------- F15 -------
def season_from_date(c: str | Column) -> Column:
    """Meteorological season of a date: Dec-Feb winter, Mar-May spring, ...; null: null."""
    m = F.month(F.col(c) if isinstance(c, str) else c)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").when(m.isNotNull(), "fall"))


def season_agreement(df: DataFrame, *, tags_col: str = "tags", date_col: str = "submitted") -> DataFrame:
    """Among rows with a season among their tags: how many have their date's
    season there.  One row: tagged, correct, share."""
    tags = F.coalesce(F.col(tags_col), F.array().cast("array<string>"))
    tagged = F.arrays_overlap(tags, F.array(*[F.lit(s) for s in SEASONS]))
    correct = F.coalesce(F.array_contains(tags, season_from_date(date_col)), F.lit(False))
    out = df.agg(F.count_if(tagged).alias("tagged"), F.count_if(correct).alias("correct"))
    return out.withColumn("share", F.col("correct") / F.nullif(F.col("tagged").cast("double"), F.lit(0.0)))


# ---------------------------------------------------------------- F16 -------
def vocabulary_overlap(tags_df: DataFrame, names_df: DataFrame, *, tags_col: str = "tags",
                       name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """(tags that are substrings of the space-joined sorted holiday names,
    one-row count of holiday names that are tags).

    A tag may span several names.  Names are numbered in their order and joined
    in blocks of as many names as the longest tag has characters, each with the
    following block as a border, so every place where a tag may begin has the
    whole tag in its block.  Each place is indexed by its next 1, 2, 4, ...
    characters; a tag is looked up by the longest of these that it fills (half
    its length at least) and then compared in full.  An empty tag is a
    substring of any names; null tags and names take no part.
    """
    names = names_df.select(F.lower(F.col(name_col)).alias("n")).where(F.col("n").isNotNull())
    tags = tags_df.select(F.explode(tags_col).alias("tag")).where(F.col("tag").isNotNull()).distinct()
    longest = max(1, tags.agg(F.max(F.length("tag"))).first()[0] or 0)
    sizes = [1 << i for i in range(longest.bit_length())]
    number = F.floor(F.col("i") / F.lit(longest))
    dealt = with_index(names, ["n"], "i").select("i", "n", F.explode(F.array(number, number - 1)).alias("b")).where("b >= 0")
    blocks = dealt.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", "n"))).alias("x"))  # at most 2 x longest names
    own = F.filter("x", lambda x: F.floor(x["i"] / F.lit(longest)) == F.col("b"))
    joined = lambda x: F.array_join(F.transform(x, lambda y: y["n"]), " ")
    places = (blocks.select(joined(F.col("x")).alias("text"), F.length(joined(own)).alias("upto")).where("upto > 0")
              .select("text", F.explode(F.sequence(F.lit(1), F.col("upto") + 1)).alias("at")))
    grams = (places.select(F.explode(F.array(*[F.struct(F.lit(p).alias("size"), F.substr("text", "at", F.lit(p)).alias("gram"),
                                                        F.substr("text", "at", F.lit(2 * p - 1)).alias("next")) for p in sizes])).alias("g"))
             .select("g.*").where(F.length("gram") == F.col("size")).distinct())
    size = F.array_max(F.filter(F.array(*[F.lit(p) for p in sizes]), lambda p: p <= F.length("tag")))
    asked = tags.select("tag", size.alias("size")).withColumn("gram", F.substr("tag", F.lit(1), F.col("size")))
    found = asked.join(grams, ["size", "gram"]).where(F.startswith("next", "tag")).select("tag").distinct()
    hits = found.unionByName(tags.where(F.col("tag") == "")).orderBy("tag")
    are_tags = names.distinct().join(tags, names["n"] == tags["tag"], "left_semi").agg(
        F.count(F.lit(1)).alias("n_names_that_are_tags"))
    return hits, are_tags


# ---------------------------------------------------------------- F17 -------
def map_bubbles(counts: DataFrame, centroids: DataFrame, *, key: str = "country", count_col: str = "count_recipes",
                min_px: float = 6.0, max_px: float = 40.0, use_sqrt: bool = True) -> DataFrame:
    """Counts joined to centroids on the trimmed, case-folded name (unmatched
    dropped); radius = min-max scaled sqrt(count) into [min_px, max_px]
    (midpoint when all equal); colour class by count; map centre = mean
    lat/lon of the bubbles."""
    c = centroids.select(F.lower(F.trim(F.col(key))).alias("_k"), F.col("lat").cast("double").alias("lat"),
                         F.col("lon").cast("double").alias("lon")).dropDuplicates(["_k"])
    j = counts.withColumn("_k", F.lower(F.trim(F.col(key).cast("string")))).join(c, "_k") \
        .where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).drop("_k")
    x = F.sqrt(F.col(count_col)) if use_sqrt else F.col(count_col).cast("double")
    w = Window.partitionBy()  # one row per place: bounded by the reference table
    j = j.withColumn("_x", x).withColumn("_mn", F.min("_x").over(w)).withColumn("_mx", F.max("_x").over(w))
    radius = F.when(F.abs(F.col("_mx") - F.col("_mn")) <= 1e-8 + 1e-5 * F.abs(F.col("_mn")), F.lit((min_px + max_px) / 2.0)) \
        .otherwise(F.lit(min_px) + (F.col("_x") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * (max_px - min_px))
    color = F.when(F.col(count_col) < 10, "red").when(F.col(count_col) < 30, "yellow") \
        .when(F.col(count_col) <= 50, "blue").otherwise("green")
    return j.select(key, count_col, "lat", "lon", radius.alias("radius"), color.alias("color_class"),
                    F.avg("lat").over(w).alias("center_lat"), F.avg("lon").over(w).alias("center_lon"))


# ---------------------------------------------------------------- F18 -------
def neighbors_with_metadata(neighbors: DataFrame, items: DataFrame, *, id_col: str = "id",
                            neighbor_col: str = "neighbor_id", attrs: Sequence[str] = ("name", "minutes")) -> DataFrame:
    """Neighbour ids joined to item attributes (left join on the neighbour id)."""
    a = items.select(F.col(id_col).alias(neighbor_col), *[F.col(x).alias(f"neighbor_{x}") for x in attrs])
    return neighbors.join(a, neighbor_col, "left")
