"""List parsing, canonical keys, column kinds (fixture 3 of FIXTURES.md)."""

from __future__ import annotations

import ast

from pyspark.sql import functions as F

from potluck.operators import cleaning as B
from potluck.operators import stats as S


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).collect()[0]["r"]


def test_parse_string_list(spark):
    assert _one(spark, B.parse_string_list, "['Apple', 'Banana']") == ["apple", "banana"]
    assert _one(spark, B.parse_string_list, "['pear']") == ["pear"]
    for bad in [None, "", "not a list", "[['a']]", "['x', 'drop table sql']"]:
        assert _one(spark, B.parse_string_list, bad) == [], bad
    assert _one(spark, B.parse_string_list, "[' a ', '', \"it's\"]") == ["a", "it's"]
    assert _one(spark, B.parse_string_list, "['less_than 5']") == []


def test_parse_float_list(spark):
    assert _one(spark, B.parse_float_list, '[1.0, 2, "x", None]') == [1.0, 2.0]
    assert _one(spark, B.parse_float_list, "[1.5, 'nope', '3']") == [1.5, 3.0]
    assert _one(spark, B.parse_float_list, "garbage") == []
    assert _one(spark, B.parse_float_list, None) == []


def test_parse_loose_list(spark):
    f = lambda c: B.parse_loose_list(c)
    assert _one(spark, f, "['Salt', 'pepper']") == ["salt", "pepper"]
    assert _one(spark, f, "['a']['b']") == ["a", "b"]
    assert _one(spark, f, "salt  Pepper") == ["salt", "pepper"]
    assert _one(spark, lambda c: B.parse_loose_list(c, dtype=None, as_text=True), "['x', 'y']") == "x y"


def test_clean_string_numeric_date(spark):
    assert _one(spark, B.clean_string, "  Hello World \n") == "hello world"
    assert _one(spark, B.clean_string, None) == ""
    assert _one(spark, B.clean_numeric, "12.5") == 12.5
    assert _one(spark, B.clean_numeric, "abc") is None
    import datetime as dt

    assert _one(spark, B.clean_date, "2024-03-12") == dt.datetime(2024, 3, 12)
    assert _one(spark, B.clean_date, "03/12/2024") == dt.datetime(2024, 3, 12)  # month first
    assert _one(spark, B.clean_date, "25/12/2024") == dt.datetime(2024, 12, 25)
    assert _one(spark, B.clean_date, "March 12, 2024") == dt.datetime(2024, 3, 12)
    assert _one(spark, B.clean_date, "not a date") is None


def test_canonical_map_sorted(spark):
    df = spark.createDataFrame([({"b": 2, "a": 1},), ({"a": 1, "b": 2},)], "m map<string,int>")
    c = B.canonical_columns(df).collect()
    assert [e["key"] for e in c[0]["m"]] == ["a", "b"]
    keys = B.canonical_key(df, ["m"]).select("row_key").distinct().count()
    assert keys == 1


def test_nested_list_equal_to_itself(spark):
    df = spark.createDataFrame([([[1, 2], [3, 4]],), ([[1, 2], [3, 4]],)], "v array<array<int>>")
    assert B.canonical_key(df).select("row_key").distinct().count() == 1


def test_extract_classes(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "c"],)], "v array<string>")
    assert [r["value"] for r in S.distinct_values(df, "v").orderBy("index").collect()] == ["a", "b", "c"]
    assert [r["index"] for r in S.distinct_values(df, "v").orderBy("index").collect()] == [0, 1, 2]


def test_infer_kinds(spark):
    df = spark.createDataFrame([("2024-03-12", "[1.0, None]", "['a', 'b']", "hello")],
                               "d string, f string, l string, s string")
    for by in ("first", "share"):
        kinds = {r["column_name"]: r["kind"] for r in B.infer_column_kinds(df, by=by).collect()}
        assert kinds == {"d": "datetime", "f": "list_float", "l": "list_string", "s": "string"}, by


def test_preprocess_and_issues(spark):
    df = spark.createDataFrame([("2024-03-12", "['A', 'b']", " Hi "), (None, None, None)], "d string, l string, s string")
    clean, issues = B.preprocess(df)
    rows = clean.collect()
    assert rows[0]["l"] == ["a", "b"] and rows[0]["s"] == "hi" and rows[1]["l"] == [] and rows[1]["s"] == ""
    assert {r["column_name"]: r["na_count"] for r in issues.collect()} == {"d": 1, "l": 1, "s": 1}


def test_clean_tags_and_ingredients(spark):
    df = spark.createDataFrame([(["north american", "quick", "", "for the kids"],)], "t array<string>")
    out = df.select(B.clean_tags("t", ["for", "the"]).alias("r")).collect()[0]["r"]
    assert out == ["north-american", "quick", "kids"]
    assert _one(spark, lambda c: B.normalize_ingredient_text(c, ["of"]), "2 Large Cans of Tomato-Paste, diced") == "cans-tomato-paste"
    assert _one(spark, lambda c: B.normalize_ingredient_text(c, []), "small") == "small"


def test_normalize_ingredients_vocabulary(spark):
    df = spark.createDataFrame([(1, ["Fresh Basil", "salt"]), (2, ["salt", "SALT"]), (2, ["salt", "SALT"])],
                               "id long, ingredients array<string>")
    out, report = B.normalize_ingredients(df, "ingredients", [])
    rows = sorted((r["id"], r["ingredients"]) for r in out.collect())
    assert rows == [(1, ["basil", "salt"]), (2, ["salt", "salt"]), (2, ["salt", "salt"])]
    r = report.collect()[0]
    assert (r["distinct_before"], r["distinct_after"]) == (3, 2)


def test_build_corpus(spark):
    df = spark.createDataFrame([("Pie", ["apple", "it's"], None)], "name string, ingredients array<string>, description string")
    assert df.select(B.build_corpus().alias("t")).collect()[0]["t"] == "pie ['apple', \"it's\"] "


def test_dates_of_every_accepted_shape(spark):
    cases = {"03-12-24": "2024-03-12", "25/12/24": "2024-12-25", "12Mar2024": "2024-03-12", "12 Mar, 2024": "2024-03-12", "Mar 12, 24": "2024-03-12",
             "March 2024": "2024-03-01", "2024-03-12 10:00": "2024-03-12 10:00:00", "2024-03-12T10:00:00Z": "2024-03-12 10:00:00",
             "2024-03-12 10:00:00.123": "2024-03-12 10:00:00.123", "13-12-24": "2024-12-13", "1/1/70": "1970-01-01", "2024.3.2": "2024-03-02",
             "12 Mar": None, "Mar12": None, "3/4/024": None, "45/45/2024": None, "x": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", B.clean_date("v").cast("string").alias("d")).collect()}
    assert got == {k: v if v is None or " " in v else f"{v} 00:00:00" for k, v in cases.items()}
    kept = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678' t").select(B.clean_date("t").cast("string").alias("d")).first()["d"]
    assert kept == "2024-01-02 03:04:05.678"


def test_float_lists_as_literals(spark):
    f = lambda c: B.parse_float_list(c)
    for text, want in {"[1., .5]": [1.0, 0.5], "[1.0, 2.0,]": [1.0, 2.0], "[1.0, 2.0] junk": [], "[1.5, True]": [1.5, 1.0],
                       "[1, None, 'x', '2.5', -3e2]": [1.0, 2.5, -300.0], "[01]": []}.items():
        assert _one(spark, f, text) == want, text


def test_loose_lists_by_both_rules(spark):
    for text, literal, delimited in [("easy|quick, dinner", ["easy|quick", "dinner"], ["easy", "quick", "dinner"]), ("'a', 'b'", ["a", "b"], ["'a'", "'b'"]),
                                     ("[tomato, basil]", ["tomato", "basil"], ["[tomato", "basil]"]), ("a,b", ["a", "b"], ["a", "b"]),
                                     ("[' X ', 'y']", ["x", "y"], ["X", "y"])]:
        assert _one(spark, lambda c: B.parse_loose_list(c), text) == literal
        assert _one(spark, lambda c: B.parse_loose_list(c, delimiters=",|"), text) == delimited


def test_list_literals_as_python_reads_them(spark):
    cases = [r"""['it\'s', "b"]""", "['a', ['b','c']]", "[]", "[,]", "['a' 'b', 'c']", "[['x'], [], [['y', 1], 2]]", "['a'", "['a']]", "[[1,2],]", "['a',]",
             "[1 2]", "[01]", """["a 'b'", 'c "d"']""", r"['back\\slash', 'tab\tx']", r"""[['it\'s', "q\"z"]]""", "['a']['b']", "[a]", "[None, True, 'x']",
             "[[',']]", "['[', ']']", "", None, "[['a']['b']]", "[[1],2,'z' ,[None]]", r"[\'a\']", "[u'x', U\"y\"]", "['a'1]", "['a', , 'b']", "'a'", "[['a'],'b' 'c']"]
    rows = spark.createDataFrame([(c,) for c in cases], "v string").select("v", B.literal_items("v").alias("items")).collect()
    for r in rows:
        try:
            value = ast.literal_eval(r["v"])
            want = [str(x) for x in value] if isinstance(value, list) else None
        except (ValueError, SyntaxError, TypeError):
            want = None
        assert (None if r["items"] is None else [i["text"] for i in r["items"]]) == want, r["v"]
    long = "[" + ", ".join(f"'{i} it\\'s'" for i in range(30000)) + "]"
    assert spark.createDataFrame([(long,)], "v string").select(F.size(B.literal_items("v")).alias("n")).first()["n"] == 30000


def test_lists_with_lists_inside_by_each_rule(spark):
    assert _one(spark, B.parse_string_list, "['a', ['b', 'c'], 1, 'd']") == ["a", "d"]
    assert _one(spark, B.parse_float_list, "[1, [2], '3', None]") == [1.0, 3.0]
    assert _one(spark, lambda c: B.parse_loose_list(c), r"""['a', ['b','c'], 'it\'s']""") == ["a", "['b', 'c']", "it's"]
    assert _one(spark, lambda c: B.parse_loose_list(c, delimiters=",|"), "['a', 1]") == ["['a'", "1]"]  # not strings alone: split
