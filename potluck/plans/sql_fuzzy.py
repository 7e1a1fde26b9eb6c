"""DuckDB oracles of the fuzzy lookups.

The longest common subsequence is computed bit-parallel by a recursive query:
bit p of ``v`` is cleared once character p of the first string is matched.
"""

from __future__ import annotations

from potluck.plans import proxies as P


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort({x}), ' ')"


def _lcs(pairs: str, sfx: str) -> str:
    """lcs{sfx}(a, b, ratio) of the distinct pairs (a, b)."""
    bits = "list_sum(list_transform(range(1, len(a) + 1), lambda p: CASE WHEN a[p] = b[i + 1] THEN CAST(1 AS BIGINT) << (p - 1) ELSE 0 END))"
    return f"""step{sfx}(a, b, i, v) AS (
  SELECT a, b, CAST(0 AS BIGINT), (CAST(1 AS BIGINT) << len(a)) - 1 FROM (SELECT DISTINCT a, b FROM ({pairs})) WHERE len(a) > 0 AND len(b) > 0
  UNION ALL
  SELECT a, b, i + 1, ((v + u) | (v - u)) & ((CAST(1 AS BIGINT) << len(a)) - 1)
  FROM (SELECT a, b, i, v, v & CAST({bits} AS BIGINT) AS u FROM step{sfx} WHERE i < len(b))),
lcs{sfx} AS (SELECT a, b, 100.0::DOUBLE * 2 * (len(a) - bit_count(v)) / (len(a) + len(b)) AS ratio FROM step{sfx} WHERE i = len(b))"""


def _ratio(a: str, b: str, sfx: str) -> str:
    return f"(CASE WHEN len({a}) + len({b}) = 0 THEN 100.0 ELSE coalesce((SELECT ratio FROM lcs{sfx} l WHERE l.a = {a} AND l.b = {b}), 0.0) END)"


NAMES = """names AS (SELECT 'country' AS kind, 0 AS grp, country_id AS pos, name AS ref, name FROM country_ref
  UNION ALL SELECT 'country', 1, country_id, demonym, name FROM country_ref
  UNION ALL SELECT 'region', 0, row_number() OVER (ORDER BY region), region, region FROM (SELECT DISTINCT region FROM country_ref))"""

STAGES = """names AS (SELECT 'common_name' AS kind, 0 AS grp, country_id AS pos, lower(common_name) AS ref, name FROM country_ref
  UNION ALL SELECT 'official_name', 0, country_id, lower(official_name), name FROM country_ref
  UNION ALL SELECT 'demonym', 0, country_id, lower(demonym), name FROM country_ref
  UNION ALL SELECT 'region', 0, row_number() OVER (ORDER BY region) - 1, region, region FROM (SELECT DISTINCT region FROM country_ref))"""


def best_tokens(tokens: str) -> str:
    """best(token, kind, ref, name, score): mean token score, first wins ties."""
    return f"""tk AS (SELECT DISTINCT token, replace(token, '-', ' ') AS q FROM ({tokens}) WHERE token <> ''),
sets AS (SELECT token, kind, grp, pos, ref, name, list_distinct({_words('q')}) AS ta, list_distinct({_words('ref')}) AS tb,
  {_sorted(_words('q'))} AS sq, {_sorted(_words('ref'))} AS sr FROM tk, names),
cut AS (SELECT *, {_sorted('list_filter(ta, lambda w: list_contains(tb, w))')} AS si, {_sorted('list_filter(ta, lambda w: NOT list_contains(tb, w))')} AS sa,
  {_sorted('list_filter(tb, lambda w: NOT list_contains(ta, w))')} AS sb FROM sets),
pair AS (SELECT *, trim(si || ' ' || sa) AS wa, trim(si || ' ' || sb) AS wb FROM cut),
{_lcs("SELECT wa AS a, wb AS b FROM pair UNION ALL SELECT si, wa FROM pair UNION ALL SELECT si, wb FROM pair UNION ALL SELECT sq, sr FROM pair", "1")},
score AS (SELECT token, kind, grp, pos, ref, name, ((CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN si <> '' AND (sa = '' OR sb = '') THEN 100.0
  WHEN si = '' THEN {_ratio('wa', 'wb', '1')} ELSE greatest({_ratio('wa', 'wb', '1')}, {_ratio('si', 'wa', '1')}, {_ratio('si', 'wb', '1')}) END)
  + {_ratio('sq', 'sr', '1')}) / 2.0 AS score FROM pair),
best AS (SELECT token, kind, ref, name, score FROM score
  QUALIFY row_number() OVER (PARTITION BY token, kind ORDER BY score DESC, grp, pos) = 1)"""


def _head(*more: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([P.SQL_GEO, P.SQL_COUNTRY_REF, *more]) + "\n"


def _found(rows: str) -> str:
    """found(id, country, region) of rows (id, ci, pos, token)."""
    order = "ci, score < 100, CASE WHEN score < 100 THEN -score ELSE 0 END, pos"
    pick = lambda kind: (f"(SELECT id, name FROM (SELECT ex.id, best.name FROM ex JOIN best ON ex.token = best.token "  # noqa: E731
                         f"WHERE kind = '{kind}' AND score >= 80 QUALIFY row_number() OVER (PARTITION BY ex.id ORDER BY {order}) = 1))")
    return f"""ex AS ({rows}),
found0 AS (SELECT geo.id, coalesce(c.name, '') AS country, coalesce(r.name, '') AS region FROM geo
  LEFT JOIN {pick('country')} c ON c.id = geo.id LEFT JOIN {pick('region')} r ON r.id = geo.id),
found AS (SELECT f.id, f.country, CASE WHEN f.region = '' THEN coalesce((SELECT any_value(region) FROM country_ref WHERE name = f.country), '') ELSE f.region END AS region
  FROM found0 f)"""


_TOKENS = "SELECT id, 0 AS ci, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM geo"
_SEGMENT = f"""SELECT id, 1 AS ci, unnest(range(len({_words('segment')}))) AS pos, unnest({_words('segment')}) AS token FROM geo"""

FUZZY_MATCH = _head(NAMES, best_tokens("SELECT unnest(tokens) AS token FROM geo")) + """SELECT token, CASE WHEN score >= 80 THEN name ELSE '' END AS match,
  round(score, 6) AS score FROM best WHERE kind = 'country'"""

FETCH_REFERENCE = _head(NAMES, best_tokens(f"SELECT token FROM ({_TOKENS} UNION ALL {_SEGMENT})"), _found(f"{_TOKENS} UNION ALL {_SEGMENT}")) + (
    "SELECT geo.id, tokens, segment, found.country, found.region FROM geo JOIN found ON geo.id = found.id")

FETCH_COUNTRY = _head(NAMES, best_tokens(f"SELECT token FROM ({_TOKENS})"), _found(_TOKENS)) + (
    "SELECT geo.id, tokens AS tags, found.country, found.region FROM geo JOIN found ON geo.id = found.id WHERE found.country <> ''")

_TAGS2 = "SELECT id, 0 AS ci, unnest(range(len(t))) AS pos, unnest(t) AS token FROM tagged"
FETCH_COUNTRY_SEASON = _head(
    NAMES, """tagged AS (SELECT id, segment, CASE WHEN list_contains(tokens, lower(segment)) THEN tokens ELSE list_append(tokens, lower(segment)) END AS t FROM geo)""",
    best_tokens(f"SELECT token FROM ({_TAGS2})"), _found(_TAGS2)) + """SELECT tagged.id, t AS tags, segment AS name,
  'a ' || lower(segment) || ' dish for winter' AS description, found.country, found.region, '' AS event, 'winter' AS season
FROM tagged JOIN found ON tagged.id = found.id WHERE found.country <> ''"""

_STAGED = f"""tk AS (SELECT DISTINCT lower(token) AS token FROM (SELECT unnest(tags) AS token FROM geo) WHERE token <> ''),
{_lcs("SELECT token AS a, ref AS b FROM tk, names", "2")},
best AS (SELECT token, kind, pos AS target, score FROM (SELECT token, kind, pos, {_ratio('token', 'ref', '2')} AS score FROM tk, names)
  QUALIFY row_number() OVER (PARTITION BY token, kind ORDER BY score DESC, pos) = 1),
ex AS (SELECT id, unnest(range(len(tags))) AS pos, lower(unnest(tags)) AS token FROM geo),
hit AS (SELECT ex.id, kind, target FROM ex JOIN best ON ex.token = best.token WHERE score >= 80
  QUALIFY row_number() OVER (PARTITION BY ex.id, kind ORDER BY score DESC, ex.pos) = 1),
wide AS (SELECT geo.id, max(target) FILTER (WHERE kind = 'common_name') AS a, max(target) FILTER (WHERE kind = 'official_name') AS b,
  max(target) FILTER (WHERE kind = 'demonym') AS c, max(target) FILTER (WHERE kind = 'region') AS r FROM geo LEFT JOIN hit ON geo.id = hit.id GROUP BY geo.id)"""
LOOKUP_STAGED = _head(STAGES, _STAGED) + """SELECT id, CAST(coalesce(a, b, c, -1) AS BIGINT) AS country_id, CAST(coalesce(r, -1) AS BIGINT) AS region_id FROM wide"""
