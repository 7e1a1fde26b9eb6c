"""Cleaning and projections (B1-B18): column kinds, string/number/date
coercion, list parsing from Python-literal text, tag and ingredient
normalisation, canonical keys, nutrition expansion, text features, corpora.

Everything is a Spark SQL expression (regex, JSON and higher-order array
functions), so cleaning runs inside whole-stage code generation; no Python
runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ----------------------------------------------------------------------------
# Fixed values (must equal the original behaviour)
# ----------------------------------------------------------------------------
# Characters kept by the list cleaner, and words that void a whole list value.
LIST_KEEP_CHARS = r"[^a-z0-9\s'\"\[\],-]"
LIST_BLOCK_WORDS = r"less_than|greater_than|sql"
# Strings that look like a date: ISO-like, day/month/year, or textual month.
DATETIME_PATTERN = (
    r"^(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}"
    r"|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"
    r"|(?:\d{1,2}\s*[A-Za-z]{3,9}|[A-Za-z]{3,9}\s*\d{1,2})(?:,?\s*\d{2,4})?)$"
)
# Nutrition vector layout and alternative column names.
NUTRITION_COLS = ["calories", "total_fat", "sugar", "sodium", "protein", "saturated_fat", "carbohydrates"]
NUTRITION_ALT_NAMES = {
    "nutrition_cal": "calories",
    "nutrition_fat": "total_fat",
    "nutrition_sugar": "sugar",
    "nutrition_protein": "protein",
    "nutrition_sodium": "sodium",
}
# Tokens that are not main ingredients (ingredient vocabulary cleaning).
INGREDIENT_BLACKLIST = [
    "inch", "inches", "deep", "low", "fat", "fresh", "large", "small",
    "medium", "thin", "diced", "sliced", "chopped", "piece", "pieces",
]
# Column renames applied by the country/season pages.
COLUMN_RENAMES = {"region": "continent"}


def english_stop_words() -> list[str]:
    """Spark's built-in English stop-word list (public, JVM side)."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once and bound to a name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ---------------------------------------------------------------- B3 --------
def clean_string(c: str | Column) -> Column:
    """null -> "", lower case, surrounding whitespace removed."""
    return F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), r"^\s+|\s+$", "")


# ---------------------------------------------------------------- B4 --------
def clean_numeric(c: str | Column) -> Column:
    """Coerce to double; unparsable text and NaN become null."""
    return F.nanvl(_c(c).try_cast("double"), F.lit(None).cast("double"))


# ---------------------------------------------------------------- B5 --------
_MONTHS = ("(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
           "|nov(?:ember)?|dec(?:ember)?)")
_YEAR = r"(\d{4}|\d{2})"
_ISO = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[ t](\d{1,2}:\d{1,2})(:\d{1,2}(?:\.\d{1,9})?)?\s*(?:z|[-+]\d{2}:?\d{2})?)?"
_NUMERIC_DATE = r"(\d{1,2})[-/](\d{1,2})[-/]" + _YEAR
_DAY_MONTH = r"(\d{1,2})\s*" + _MONTHS + r",?\s*" + _YEAR
_MONTH_FIRST = _MONTHS + r"\s*(?:(\d{1,2})[,\s]+" + _YEAR + r"|(\d{4}))"
#: Every accepted shape; groups: 1-5 ISO, 6-8 numeric, 9-11 day first, 12-15 month first.
_ANY_DATE = rf"^\s*(?:{_ISO}|{_NUMERIC_DATE}|{_DAY_MONTH}|{_MONTH_FIRST})\s*$"
_DATE_GROUPS = 15
#: Dates that Spark's own cast reads as they are.
_PLAIN_ISO = r"^\d{4}-\d\d-\d\d(?: \d\d:\d\d:\d\d(?:\.\d{1,6})?)?$"


def clean_date(c: str | Column) -> Column:
    """Coerce text (or timestamps) to a timestamp; unparsable -> null.

    ISO dates with -, / or . and an optional time (seconds, fraction and zone
    suffix may be missing; the wall clock is kept), numeric dates (month
    first, day first where that fails), textual months.  Two-digit years from
    69 on are 19xx.  A day and month without a year is null.  White space
    around the date does not count.  Plain ISO text goes straight to the cast;
    else one regex reads the value, its groups are bound once and the date is
    put together by the shape that matched.
    """
    text = F.lower(_c(c).cast("string"))
    marks = "\u001f".join(f"${k}" for k in range(1, _DATE_GROUPS + 1))
    groups = F.when(text.rlike(r"^\s*[0-9a-z]"), F.split(F.regexp_replace(text, _ANY_DATE, marks), "\u001f"))

    def year(y: Column) -> Column:
        return F.when(F.length(y) == 4, y).otherwise(F.concat(F.when(y >= "69", F.lit("19")).otherwise(F.lit("20")), y))

    def at(y: Column, m: Column, d: Column, *time: Column) -> Column:
        return F.concat(y, F.lit("-"), m, F.lit("-"), d, *time).try_cast("timestamp_ntz")

    def month(name: Column) -> Column:
        return ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.substring(name, 1, 3)) + 2) / 3).cast("int").cast("string")

    def dated(g: Column) -> Column:
        part = lambda k: F.get(g, F.lit(k - 1))
        there = lambda k: part(k) != ""
        seconds = F.when(there(5), part(5)).otherwise(F.lit(":00"))
        numeric = year(part(8))
        return (F.when(F.size(g) != _DATE_GROUPS, F.lit(None).cast("timestamp_ntz"))
                .when(there(4), at(part(1), part(2), part(3), F.lit(" "), part(4), seconds))
                .when(there(1), at(part(1), part(2), part(3)))
                .when(there(6), F.coalesce(at(numeric, part(6), part(7)), at(numeric, part(7), part(6))))
                .when(there(9), at(year(part(11)), month(part(10)), part(9)))
                .when(there(15), at(part(15), month(part(12)), F.lit("1")))
                .when(there(12), at(year(part(14)), month(part(12)), part(13))))

    return F.coalesce(F.when(text.rlike(_PLAIN_ISO), text.try_cast("timestamp_ntz")), _let(groups, dated))


# ------------------------------------------------ list literals (B6-B8) ----
# Escaped backslashes and quotes stand as noncharacters while a literal is read.
_ESCAPES = [("\\\\", "\ufdd0"), ("\\'", "\ufdd1"), ('\\"', "\ufdd2")]
_TEXT_ITEM = "[uU]?'[^'\\n]*'|[uU]?\"[^\"\\n]*\""
_NUMBER = r"[-+]?(?:(?:\d+\.\d*|\.\d+)(?:[eE][-+]?\d+)?|\d+[eE][-+]?\d+|0+|[1-9]\d*)"
_NAMES = "None|True|False"
_ITEMS_TYPE = "array<struct<kind:string,text:string>>"


def _unescaped(x: Column) -> Column:
    """The text of a quoted item: quotes off, escapes resolved."""
    inner = F.when(x.startswith("'") | x.startswith('"'), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(F.substring(x, F.lit(3), F.length(x) - 3))
    plain = inner
    for written, stands_for in [("\\\n", ""), ("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ("\ufdd0", "\\"), ("\ufdd1", "'"), ("\ufdd2", '"')]:
        plain = F.replace(plain, F.lit(written), F.lit(stands_for))
    return F.when(x.rlike("[\\\\\ufdd0-\ufdd2]"), plain).otherwise(inner)


def _repr(x: Column) -> Column:
    """A text as Python writes it inside a list."""
    x = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    double = (F.instr(x, "'") > 0) & (F.instr(x, '"') == 0)
    return F.when(double, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _is_text(token: Column) -> Column:
    return F.substring(token, 1, 1).isin("'", '"', "u", "U")


def _item(token: Column) -> Column:
    return F.when(_is_text(token), F.struct(F.lit("text").alias("kind"), _unescaped(token).alias("text"))) \
        .otherwise(F.struct(F.lit("value").alias("kind"), token.alias("text")))


def _nested_items(tokens: Column) -> Column:
    """Items of a list with lists in it: one fold over its tokens, null if it is none.

    The state holds the depth, what stood before, the finished items and the
    list that is being written.
    """
    start = F.struct(F.lit(True).alias("ok"), F.lit(0).alias("depth"), F.lit("").alias("prev"),
                     F.array().cast(_ITEMS_TYPE).alias("items"), F.lit("").alias("inner"))

    def step(state: Column, t: Column) -> Column:
        ok, depth, prev, items, inner = (state[k] for k in ("ok", "depth", "prev", "items", "inner"))
        fresh = prev.isin("[", ",")
        comma = F.when((prev == ",") & (depth >= 2), F.lit(", ")).otherwise(F.lit(""))
        joined = (prev == "text") & _is_text(t) & (depth == 1)
        last = F.get(items, F.size(items) - 1)
        one = lambda kind, text: F.array(F.struct(kind.alias("kind"), text.alias("text")))

        def state_of(ok, depth, prev, items, inner):
            return F.struct((ok).alias("ok"), depth.cast("int").alias("depth"), prev.alias("prev"), items.alias("items"), inner.alias("inner"))

        opened = state_of(ok & (fresh | (prev == "")), depth + 1, F.lit("["), items,
                          F.when(depth >= 1, F.concat(inner, comma, F.lit("["))).otherwise(inner))
        closed = state_of(ok & (depth >= 1), depth - 1, F.lit("value"),
                          F.when(depth == 2, F.concat(items, one(F.lit("list"), F.concat(inner, F.lit("]"))))).otherwise(items),
                          F.when(depth > 2, F.concat(inner, F.lit("]"))).otherwise(F.lit("")))
        parted = state_of(ok & (depth >= 1) & prev.isin("text", "value"), depth, F.lit(","), items, inner)
        found = F.array(_item(t))
        value = state_of(ok & (depth >= 1) & (fresh | joined), depth, F.when(_is_text(t), F.lit("text")).otherwise(F.lit("value")),
                         F.when(joined, F.concat(F.slice(items, F.lit(1), F.size(items) - 1), one(F.lit("text"), F.concat(last["text"], _unescaped(t)))))
                         .when(depth == 1, F.concat(items, found)).otherwise(items),
                         F.when(depth >= 2, F.concat(inner, comma, F.when(_is_text(t), _repr(_unescaped(t))).otherwise(t))).otherwise(inner))
        return F.when(t == "[", opened).when(t == "]", closed).when(t == ",", parted).otherwise(value)

    return F.aggregate(tokens, start, step, lambda state: F.when(state["ok"] & (state["depth"] == 0), state["items"]))


def _read_literal(c: str | Column, token: Callable[[Column], Column], item: Callable[[Column], Column], names: bool = True) -> Column:
    """A list literal's items: ``token`` of each as it is written, or ``item`` of
    each (kind, text) where the list holds lists or strings side by side; null if
    the text is no list literal.

    Every item becomes one mark and the marks alone are checked, so a flat
    list of any length is read by regexes that do not recurse; only the other
    lists go through a fold.
    """
    values = _NUMBER + ("|" + _NAMES if names else "")
    text = escaped = _c(c).cast("string")
    for written, mark in _ESCAPES:
        escaped = F.replace(escaped, F.lit(written), F.lit(mark))
    escaped = F.when(F.instr(text, "\\") > 0, escaped).otherwise(text)

    def read(e: Column) -> Column:
        marks = F.translate(F.regexp_replace(F.regexp_replace(e, _TEXT_ITEM, '"'), values, "0"), " \t\n\r\f", "")
        flat = F.transform(F.regexp_extract_all(e, F.lit(f"({_TEXT_ITEM}|{values})"), 1), token)
        nested = F.transform(_nested_items(F.regexp_extract_all(e, F.lit(rf"({_TEXT_ITEM}|{values}|\[|\]|,)"), 1)), item)
        return _let(marks, lambda m: F.when(m.rlike(r'^\[(?:[0"](?:,[0"])*+,?)?\]$'), flat).when(m.rlike(r'^\[[0",\[\]]*\]$'), nested))

    return _let(escaped, read)


def literal_items(c: str | Column, *, names: bool = True) -> Column:
    """The items of a Python list literal, as structs (kind, text); null if the
    text is none.

    Kinds: ``text`` (a string, quotes off, escapes resolved; strings side by
    side are one), ``value`` (a number or, with ``names``, None, True, False,
    as written), ``list`` (a list inside, written as Python prints it).
    Tuples, sets, dictionaries, bytes, raw and triple-quoted strings and
    ``\\x``, ``\\u`` escapes are not read as such (the last stay as written).
    """
    return _read_literal(c, _item, lambda i: i, names)


# ---------------------------------------------------------------- B6 --------
def parse_string_list(c: str | Column) -> Column:
    """Python-literal list text -> array<string>.

    null -> []; lower case; characters outside ``[a-z0-9\\s'"[],-]`` dropped;
    a value mentioning less_than / greater_than / sql is voided; only quoted
    items are kept, trimmed and non-empty (numbers and lists inside are
    passed over); anything but a list -> [].
    """
    raw = F.regexp_replace(F.lower(F.coalesce(_c(c).cast("string"), F.lit("[]"))), r"^\s+|\s+$", "")
    items = literal_items(F.regexp_replace(raw, LIST_KEEP_CHARS, ""), names=False)
    texts = _let(items, lambda a: F.filter(F.transform(F.filter(a, lambda i: i["kind"] == "text"), lambda i: F.trim(i["text"])), lambda x: x != ""))
    return F.when(~raw.rlike(LIST_BLOCK_WORDS), F.coalesce(texts, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))


# ---------------------------------------------------------------- B7 --------
def parse_float_list(c: str | Column) -> Column:
    """List text -> array<double>, keeping only items convertible to a number.

    The whole text must be a list literal, else []; True and False count
    as 1 and 0, quoted numbers are converted, None, other text and lists
    inside are dropped.
    """
    number = r"^\s*(?:" + _NUMBER + r"|\d+|[-+]?(?:inf|infinity|nan))\s*$"
    quoted = lambda x: F.when(F.lower(x).rlike(number), F.trim(x).try_cast("double"))
    named = lambda x: F.when(x == "True", F.lit(1.0)).when(x == "False", F.lit(0.0)).otherwise(x.try_cast("double"))
    values = _read_literal(c, lambda t: F.when(_is_text(t), quoted(_unescaped(t))).otherwise(named(t)),
                           lambda i: F.when(i["kind"] == "text", quoted(i["text"])).when(i["kind"] == "value", named(i["text"])))
    return F.coalesce(F.filter(values, lambda x: x.isNotNull()), F.array().cast("array<double>"))


# ---------------------------------------------------------------- B8 --------
def parse_loose_list(c: str | Column, *, as_text: bool = False, dtype=None, delimiters: str | None = None) -> Column:
    """Tolerant list parse of arrays and text; tokens are trimmed and non-empty.

    Without ``delimiters``: arrays as they are; text gets ``][`` read as
    ``, ``, brackets around it if it has none, and is parsed as a list
    literal (a list inside is one token, written as Python prints it), or else
    (brackets removed) split on commas, or without one on white space; lower
    case.
    With ``delimiters`` (such as ``",|"``): text that starts with a bracket is
    parsed as a literal of strings; other text, or a failed literal, is split
    on these characters and keeps its case.  ``as_text`` joins the tokens with spaces.
    """
    x = _c(c)
    tidy = lambda a: F.filter(F.transform(a, lambda t: F.trim(t.cast("string"))), lambda t: t.isNotNull() & (t != ""))
    if isinstance(dtype, T.ArrayType):
        toks = tidy(x) if delimiters else F.transform(tidy(x), lambda t: F.lower(t))
    elif delimiters:
        s = x.cast("string")
        split = F.split(s, "[" + "".join("\\" + d for d in delimiters) + "]")
        texts = _let(F.when(s.startswith("["), literal_items(s)),
                     lambda a: F.when(F.forall(a, lambda i: i["kind"] == "text"),
                                      F.transform(a, lambda i: F.regexp_replace(F.trim(i["text"]), "^['\"]+|['\"]+$", ""))))
        toks = tidy(F.coalesce(texts, split))
    else:
        s = F.trim(x.cast("string"))
        fixed = F.regexp_replace(s, r"\]\[", ", ")
        bare = F.regexp_replace(fixed, r"^[\[\]]+|[\[\]]+$", "")
        whole = F.when(fixed.startswith("[") & fixed.endswith("]"), fixed).otherwise(F.concat(F.lit("["), bare, F.lit("]")))
        loose = F.regexp_replace(s, r"^[\[\]]+|[\[\]]+$", "")
        split = F.when(F.instr(loose, ",") > 0, F.split(loose, r",\s*")).otherwise(F.split(loose, r"\s+"))
        read = _read_literal(whole, lambda t: F.when(_is_text(t), _unescaped(t)).otherwise(t), lambda i: i["text"])
        parsed = F.coalesce(read, split)
        toks = F.transform(tidy(parsed), lambda t: F.lower(t))
    toks = F.when(x.isNull(), F.array().cast("array<string>")).otherwise(toks)
    return F.array_join(toks, " ") if as_text else toks


# ---------------------------------------------------------------- B9 --------
def normalize_columns(df: DataFrame, renames: dict | None = None) -> DataFrame:
    """Strip and lower-case column names, then rename (only to absent names)."""
    names = [n.strip().lower() for n in df.columns]
    out = df.toDF(*names)
    for src, dst in (renames if renames is not None else COLUMN_RENAMES).items():
        if src in out.columns and dst not in out.columns:
            out = out.withColumnRenamed(src, dst)
    return out


def map_nutrition_names(df: DataFrame) -> DataFrame:
    """Alternative nutrition column names -> standard ones (when absent)."""
    out = df
    for alt, tgt in NUTRITION_ALT_NAMES.items():
        if alt in out.columns and tgt not in out.columns:
            out = out.withColumn(tgt, clean_numeric(alt))
    return out


# ---------------------------------------------------------------- B10 -------
def squeeze_whitespace(c: str | Column) -> Column:
    """Runs of whitespace -> one space, then trimmed."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"\s+", " "), r"^ | $", "")


# ---------------------------------------------------------------- B11 -------
def clean_tags(c: str | Column, stop_words: Sequence[str] | None = None, *, dedupe_only: bool = False) -> Column:
    """Multi-word tags lose stop words and are joined with "-"; single-word
    tags are kept; empty tags dropped.  ``dedupe_only`` only de-duplicates."""
    x = _c(c)
    if dedupe_only:
        return F.array_distinct(x)
    sw = F.array(*[F.lit(w) for w in (stop_words if stop_words is not None else english_stop_words())])
    cleaned = F.transform(x, lambda t: F.when(
        F.instr(t, " ") > 0,
        F.array_join(F.filter(F.split(F.trim(t), r"\s+"), lambda w: ~F.array_contains(sw, w)), "-"),
    ).otherwise(t))
    return F.filter(cleaned, lambda t: t.isNotNull() & (t != ""))


# ---------------------------------------------------------------- B12 -------
def normalize_ingredient_text(c: str | Column, stop_words: Sequence[str] | None = None) -> Column:
    """lower, non-letters -> space, squeeze; drop stop words, 1-char tokens and
    the blacklist; ordered de-duplication; "-" join; original text if empty."""
    sw = list(stop_words if stop_words is not None else english_stop_words()) + INGREDIENT_BLACKLIST
    swa = F.array(*[F.lit(w) for w in sw])
    x = _c(c)
    pre = F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z\s-]", " "), r"\s+", " "))
    toks = F.filter(F.split(pre, " "), lambda t: (F.length(t) > 1) & ~F.array_contains(swa, t))
    joined = F.array_join(F.array_distinct(toks), "-")
    return F.when(joined == "", pre).otherwise(joined)


def normalize_ingredients(df: DataFrame, col: str = "ingredients", stop_words: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalise the items of every list in place (no shuffle).

    Returns (table with ``col`` normalised, one-row report over the distinct
    items: before, after, reduction in percent).
    """
    norm = lambda x: normalize_ingredient_text(x, stop_words)
    out = df.withColumn(col, F.filter(F.transform(F.coalesce(F.col(col), F.array()), norm), lambda x: x.isNotNull()))
    vocab = df.select(F.explode(col).alias("_item")).where(F.col("_item").isNotNull()).distinct().withColumn("_norm", norm("_item"))
    report = vocab.agg(
        F.count(F.lit(1)).alias("distinct_before"),
        F.countDistinct(F.when(F.col("_norm") != "", F.col("_norm"))).alias("distinct_after"),
    ).withColumn("reduction_pct", (F.col("distinct_before") - F.col("distinct_after")) * 100.0 / F.col("distinct_before"))
    return out.select(*df.columns), report


def normalize_ingredients_lists(col: str | Column, vocab_map: Column) -> Column:
    """Map list items through a map<string,string> (small vocabularies)."""
    return F.transform(_c(col), lambda t: F.coalesce(F.element_at(vocab_map, t), t))


# ---------------------------------------------------------------- B13 -------
def _canon(c: Column, dt) -> Column:
    if isinstance(dt, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def canonical_columns(df: DataFrame) -> DataFrame:
    """Make every column comparable/groupable: maps become key-sorted entry arrays."""
    return df.select(*[_canon(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def canonical_text(c: Column, dt) -> Column:
    """A string that is equal exactly when the values are equal."""
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(_canon(c, dt).alias("v")))
    return c.cast("string")


def canonical_key(df: DataFrame, columns: Sequence[str] | None = None, out_col: str = "row_key") -> DataFrame:
    """64-bit hash of the canonical form of the given columns."""
    columns = list(columns or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.withColumn(out_col, F.xxhash64(*[_canon(F.col(c), types[c]) for c in columns]))


def needs_canonical(df: DataFrame) -> DataFrame:
    """Which columns hold non-scalar values (column, needs_canonical)."""
    spark = df.sparkSession
    rows = [(f.name, isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, needs_canonical boolean")


# ---------------------------------------------------------------- B14 -------
def expand_nutrition(df: DataFrame, col: str = "nutrition") -> tuple[DataFrame, DataFrame]:
    """Nutrition vector -> 7 named columns (only rows with >= 7 values).

    Standard columns already present (or mapped from alternative names) win;
    text vectors are parsed.  Returns (table, one-row info).
    """
    out = map_nutrition_names(df)
    present = [c for c in NUTRITION_COLS if c in out.columns]
    parsed = False
    if not present and col in out.columns:
        dt = out.schema[col].dataType
        arr = F.col(col).cast("array<double>") if isinstance(dt, T.ArrayType) else parse_float_list(col)
        out = out.withColumn("_nut", arr)
        for i, c in enumerate(NUTRITION_COLS):
            out = out.withColumn(c, F.when(F.size("_nut") >= len(NUTRITION_COLS), F.col("_nut")[i]))
        out = out.drop("_nut")
        parsed = True
    spark = df.sparkSession
    info = spark.createDataFrame(
        [(",".join(c for c in NUTRITION_COLS if c in out.columns),
          ",".join(f"{a}->{t}" for a, t in NUTRITION_ALT_NAMES.items() if a in df.columns and t not in df.columns),
          parsed)],
        "present string, mapped string, parsed_nut_column boolean")
    return out, info


# ---------------------------------------------------------------- B15 -------
def text_features(df: DataFrame, col: str = "review") -> DataFrame:
    """Append len, words, "!" and "?" counts, has_caps ([A-Z]{3,}) and
    mentions_thanks to the table.  A null text counts as ""."""
    t = F.coalesce(F.col(col), F.lit(""))
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    return df.select(
        "*",
        F.length(t).alias(f"{col}_len"),
        words.alias(f"{col}_words"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).alias(f"{col}_exclamations"),
        (F.length(t) - F.length(F.replace(t, F.lit("?"), F.lit("")))).alias(f"{col}_question_marks"),
        t.rlike(r"[A-Z]{3,}").alias(f"{col}_has_caps"),
        t.rlike(r"(?i)\bthank(s| you)?\b").alias(f"{col}_mentions_thanks"),
    )


# ---------------------------------------------------------------- B16/B17 ---
def py_list_text(c: str | Column) -> Column:
    """Render an array<string> the way Python prints a list; null -> "nan"."""
    x = _c(c)
    quoted = F.transform(x, lambda t: F.when(F.instr(t, "'") > 0, F.concat(F.lit('"'), t, F.lit('"')))
                         .otherwise(F.concat(F.lit("'"), t, F.lit("'"))))
    return F.when(x.isNull(), F.lit("nan")).otherwise(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def build_corpus(name: str | Column = "name", ingredients: str | Column = "ingredients",
                 description: str | Column = "description") -> Column:
    """lower(name + " " + ingredients as printed + " " + description), nulls as ""."""
    ing = _c(ingredients)
    return F.lower(F.concat(F.coalesce(_c(name), F.lit("")), F.lit(" "), py_list_text(ing), F.lit(" "),
                            F.coalesce(_c(description), F.lit(""))))


def merge_features(time_tags: str | Column = "time_tags", tokens: str | Column = "ingredient_tokens") -> Column:
    """time tags and ingredient tokens -> one space-separated feature string."""
    tt = F.array_join(F.filter(F.coalesce(_c(time_tags), F.array()), lambda t: t.isNotNull() & (t != "")), " ")
    it = F.array_join(F.coalesce(_c(tokens), F.array()), " ")
    return F.trim(F.concat(tt, F.lit(" "), it))


# ---------------------------------------------------------------- B18 -------
def schema_report(df: DataFrame) -> DataFrame:
    """(column, dtype) for every column."""
    return df.sparkSession.createDataFrame(list(df.dtypes), "column_name string, dtype string")


# ---------------------------------------------------------------- B2 --------
_FLOAT_ITEM = r"(?:-?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?|-?[0-9]+[eE][-+]?[0-9]+|None)"
FLOAT_LIST_PATTERN = r"^\[\s*(?:" + _FLOAT_ITEM + r"\s*(?:,\s*" + _FLOAT_ITEM + r"\s*)*,?\s*)?\]$"
_S_ITEM = r"""(?:'[^'\\]*'|"[^"\\]*")"""
STRING_LIST_PATTERN = r"^\[\s*(?:" + _S_ITEM + r"\s*(?:,\s*" + _S_ITEM + r"\s*)*,?\s*)?\]$"


def kind_of(c: Column) -> Column:
    """Kind of one text value: datetime, list_float, list_string or string."""
    s = F.trim(c)
    is_bracketed = c.startswith("[") & c.endswith("]")
    is_dt = ~is_bracketed & (F.length(c) >= 4) & (F.length(c) <= 20) & c.rlike(DATETIME_PATTERN)
    return (F.when(is_dt, "datetime").when(s.rlike(FLOAT_LIST_PATTERN), "list_float")
            .when(s.rlike(STRING_LIST_PATTERN), "list_string").otherwise("string"))


def infer_column_kinds(df: DataFrame, *, by: str = "first", order_col: str | None = None) -> DataFrame:
    """(column, kind) for every string column.

    ``by="first"``: the kind of the first non-null value in the order of
    ``order_col``, or else of the scan (deterministic for a given input);
    ``by="share"``: the kind most non-null values have (ties -> order above).
    One aggregation over the table.
    """
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not str_cols:
        return df.sparkSession.createDataFrame([], "column_name string, kind string")
    pos = F.col(order_col) if order_col else F.monotonically_increasing_id()
    base = df.select(pos.alias("_pos"), *str_cols)
    if by == "first":
        aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(c) for c in str_cols]
        first = base.agg(*aggs)
        long = first.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in str_cols])).alias("kv"))
        return long.select("kv.column_name", F.when(F.col("kv.v").isNull(), F.lit(None)).otherwise(kind_of(F.col("kv.v"))).alias("kind"))
    kinds = ["datetime", "list_float", "list_string", "string"]
    aggs = [F.count_if(kind_of(F.col(c)) == k).alias(f"{c}__{k}") for c in str_cols for k in kinds]
    one = base.agg(*aggs)
    rows = []
    for c in str_cols:
        best = F.lit(None).cast("string")
        best_n = F.lit(0).cast("long")
        for k in kinds:  # strictly greater keeps the earlier kind on ties
            n = F.col(f"{c}__{k}")
            best = F.when(n > best_n, F.lit(k)).otherwise(best)
            best_n = F.greatest(n, best_n)
        rows.append(F.struct(F.lit(c).alias("column_name"), best.alias("kind")))
    return one.select(F.explode(F.array(*rows)).alias("kv")).select("kv.column_name", "kv.kind")


# ---------------------------------------------------------------- B1 --------
def clean_by_kind(c: str, kind: str | None, dt) -> Column:
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(c), F.lit(None).cast(dt.simpleString())).alias(c)
    if not isinstance(dt, T.StringType) or kind is None:
        return F.col(c)
    if kind == "datetime":
        return clean_date(c).alias(c)
    if kind == "list_float":
        return parse_float_list(c).alias(c)
    if kind == "list_string":
        return parse_string_list(c).alias(c)
    return clean_string(c).alias(c)


def preprocess(df: DataFrame, *, by: str = "first", order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean every column by kind; returns (clean table, raw missing counts).

    Column kinds come from one aggregation (one row per column reaches the
    driver - a bound set by the schema, not the data); the cleaning itself is
    a single projection.
    """
    from potluck.operators.quality import na_counts

    kinds = {r["column_name"]: r["kind"] for r in infer_column_kinds(df, by=by, order_col=order_col).collect()}
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    clean = df.select(*[clean_by_kind(c, kinds.get(c), types[c]) for c in df.columns])
    issues = na_counts(df).select("column_name", "na_count")
    return clean, issues
