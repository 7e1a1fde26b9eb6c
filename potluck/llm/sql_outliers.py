"""DuckDB SQL of the outlier query: word positions and windows as rows, the
covariance estimate as a chain of grouped tables.  Every row counts for its
language and source, for its language and for the whole table; the first of
these with enough rows judges it.  All constants are written out here."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"
_P = 5
_FLOORS = [0.35, 0.15, 0.25, 0.2, 0.075]
_Z = range(_P)
#: The 1 - 1e-6 quantile of chi-square with 5 degrees of freedom, times 0.75 over
#: the share of 7 degrees that lies below the 0.75 quantile of 5.
_LIMIT = 50.67667009829394
_PAIRS = [(i, j) for i in _Z for j in range(i + 1)]

_BASE = rf"""docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
word AS (SELECT rid, w, row_number() OVER (PARTITION BY rid ORDER BY k) AS i FROM (
  SELECT rid, unnest(regexp_split_to_array(text, '{_SPACE}+')) AS w, generate_subscripts(regexp_split_to_array(text, '{_SPACE}+'), 1) AS k FROM docs) WHERE w <> ''),
gram AS (SELECT rid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM gram WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + d) AS r FROM twice, (VALUES (0), (1), (2)) x(d) GROUP BY rid),
line AS (SELECT rid, count(*) - count(DISTINCT l) AS dup FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
size AS (SELECT rid, count(*) AS n FROM word GROUP BY rid),
stat AS (SELECT d.rid, d.doc_id, coalesce('=' || lang, 'null') AS gl, coalesce('=' || source, 'null') AS gs, coalesce(s.n, 0) AS n_words,
  length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.r, 0) AS n_repeat_words FROM docs d LEFT JOIN size s ON s.rid = d.rid
  LEFT JOIN line l ON l.rid = d.rid LEFT JOIN covered c ON c.rid = d.rid),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stat),
zr AS (SELECT rid, gl, gs, ln(n_words) AS z0, ln(word_chars / CAST(n_words AS DOUBLE)) * 2 AS z1, ln(1 + 100 * n_symbols / CAST(word_chars AS DOUBLE)) AS z2,
  ln(1 + n_dup_lines) / ln(1 + sqrt(n_words)) AS z3, sqrt(n_repeat_words / CAST(n_words + 150 AS DOUBLE)) AS z4 FROM base WHERE NOT base_failed),
zs AS MATERIALIZED (SELECT *, '0' || gl || chr(1) || gs AS g FROM zr UNION ALL SELECT *, '1' || gl FROM zr UNION ALL SELECT *, '2' FROM zr)"""


def _factor(source: str, keys: str) -> str:
    """Lower-triangular factor of c* as nested selects, one column a level."""
    sql = source
    for i, j in _PAIRS:
        rest = f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        value = f"sqrt(greatest({rest}, 1e-12))" if i == j else f"({rest}) / l{j}{j}"
        sql = f"(SELECT *, {value} AS l{i}{j} FROM {sql})"
    det = " + ".join(f"ln(l{i}{i})" for i in _Z)
    return f"SELECT {keys}, {', '.join(f'm{i}' for i in _Z)}, {', '.join(f'l{i}{j}' for i, j in _PAIRS)}, {det} AS det FROM {sql}"


def _far(rows: str) -> str:
    """Rows with d2, by forward substitution."""
    sql = rows
    for i in _Z:
        rest = f"z{i} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(i))
        sql = f"(SELECT *, ({rest}) / l{i}{i} AS y{i} FROM {sql})"
    return f"(SELECT *, {' + '.join(f'y{i} * y{i}' for i in _Z)} AS d2 FROM {sql})"


def _moments(rows: str, keys: str) -> str:
    floor = lambda i, j: f" + {_FLOORS[i] ** 2}" if i == j else ""
    return (f"(SELECT {keys}, {', '.join(f'avg(z{i}) AS m{i}' for i in _Z)}, "
            + ", ".join(f"avg(z{i} * z{j}) - avg(z{i}) * avg(z{j}){floor(i, j)} AS c{i}{j}" for i, j in _PAIRS) + f" FROM {rows} GROUP BY {keys})")


def build(share: float = 0.75, steps: int = 3, least_rows: int = 20) -> str:
    parts = [_BASE]
    parts.append("med AS (SELECT g, " + ", ".join(f"quantile_disc(z{i}, 0.5) AS m{i}" for i in _Z) + " FROM zs GROUP BY g)")
    parts.append("dev AS (SELECT zs.g, " + ", ".join(f"any_value(m{i}) AS m{i}, quantile_disc(abs(z{i} - m{i}), 0.5) AS a{i}" for i in _Z)
                 + " FROM zs JOIN med ON zs.g = med.g GROUP BY zs.g)")
    robust = ("(SELECT g, 0 AS start, " + ", ".join(f"m{i}" for i in _Z) + ", "
              + ", ".join(f"pow(a{i} * 1.4826, 2) + {_FLOORS[i] ** 2} AS c{i}{j}" if i == j else f"0.0 AS c{i}{j}" for i, j in _PAIRS) + " FROM dev)")
    plain = "(SELECT g, 1 AS start, " + ", ".join([*(f"m{i}" for i in _Z), *(f"c{i}{j}" for i, j in _PAIRS)]) + f" FROM {_moments('zs', 'g')})"
    parts.append(f"e0 AS MATERIALIZED ({_factor(f'(SELECT * FROM {robust} UNION ALL SELECT * FROM {plain})', 'g, start')})")
    for k in range(steps):
        rows = f"(SELECT zs.*, e.* EXCLUDE (g) FROM zs JOIN e{k} e ON zs.g = e.g)"
        parts.append(f"""c{k} AS (SELECT g, start, {', '.join(f'z{i}' for i in _Z)}, floor(log2(d2 + 1e-6) * 16) AS cls FROM {_far(rows)}),
b{k} AS (SELECT *, rank() OVER (PARTITION BY g, start ORDER BY cls) - 1 AS before, count(*) OVER (PARTITION BY g, start) AS total FROM c{k})""")
        parts.append(f"e{k + 1} AS MATERIALIZED ({_factor(_moments(f'(SELECT * FROM b{k} WHERE before < {share} * total)', 'g, start'), 'g, start')})")
    parts.append(f"""best AS (SELECT * FROM e{steps} WHERE g IN (SELECT g FROM zs GROUP BY g HAVING count(*) >= {least_rows})
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY det, start) = 1),
own AS (SELECT zs.*, best.* EXCLUDE (g) FROM zs JOIN best ON zs.g = best.g),
first AS (SELECT rid, min(g[1]) AS level FROM own GROUP BY rid)""")
    judged = _far("(SELECT own.* FROM own JOIN first ON own.rid = first.rid AND own.g[1] = first.level)")
    parts.append(f"judged AS (SELECT rid, d2 FROM {judged})")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT b.doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (d2 IS NULL OR d2 <= {_LIMIT!r}) AS kept FROM base b LEFT JOIN judged j ON b.rid = j.rid""")
