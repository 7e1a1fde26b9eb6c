"""Oracle SQL of the text clusters: seeds and Lloyd steps, one CTE each."""

from __future__ import annotations

from collections.abc import Sequence


def _near(name: str, centers: str) -> str:
    """``name``(id, cluster, d): every text's nearest of ``centers``(cluster, t, c)."""
    return f""",
{name}_g AS MATERIALIZED (SELECT x.id, l.cluster, x.n2 + l.c2 - 2 * coalesce(p.dot, 0) AS d FROM x
  CROSS JOIN (SELECT cluster, sum(c * c) AS c2 FROM {centers} GROUP BY cluster) l
  LEFT JOIN (SELECT w.id, c.cluster, sum(w.w * c.c) AS dot FROM w JOIN {centers} c ON c.t = w.t GROUP BY ALL) p
    ON p.id = x.id AND p.cluster = l.cluster),
{name} AS MATERIALIZED (SELECT id, cluster, d FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, cluster) AS r FROM {name}_g) WHERE r = 1)"""


def text_clusters(k: int, max_features: int, steps: int, stop_words: Sequence[str]) -> str:
    """WITH ... of ``own``(id, cluster, d), ``centers``(cluster, t, c) and ``v``(term, t)."""
    stop = ", ".join(f"'{s}'" for s in stop_words)
    sql = f"""WITH tk AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents),
tc AS MATERIALIZED (SELECT id, term, count(*) AS cnt FROM tk WHERE term NOT IN ({stop}) GROUP BY 1, 2),
v AS MATERIALIZED (SELECT term, idf, row_number() OVER (ORDER BY total DESC, term) - 1 AS t FROM (
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf, sum(cnt) AS total
  FROM tc GROUP BY term ORDER BY total DESC, term LIMIT {max_features})),
raw AS (SELECT id, t, cnt * idf AS raw FROM tc JOIN v ON v.term = tc.term),
w AS MATERIALIZED (SELECT id, t, CAST(floor(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) * 1048576 + 0.5) AS BIGINT) AS w FROM raw),
x AS MATERIALIZED (SELECT d.doc_id AS id, coalesce(sum(w * w), 0) AS n2 FROM documents d LEFT JOIN w ON w.id = d.doc_id GROUP BY 1),
s0 AS MATERIALIZED (SELECT 0 AS cluster, t, w AS c FROM w WHERE id = (SELECT min(id) FROM w))"""
    for i in range(1, k):
        sql += _near(f"f{i}", f"s{i - 1}")
        sql += f""",
s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL SELECT {i}, t, w FROM w
  WHERE id = (SELECT id FROM f{i} WHERE id IN (SELECT id FROM w) ORDER BY d DESC, id LIMIT 1))"""
    now = f"s{k - 1}"
    for i in range(steps):
        sql += _near(f"a{i}", now)
        sql += f""",
m{i} AS MATERIALIZED (SELECT s.cluster, s.t, s.s // n.n AS c
  FROM (SELECT a.cluster, w.t, sum(w.w) AS s FROM a{i} a JOIN w ON w.id = a.id GROUP BY ALL) s
  JOIN (SELECT cluster, count(*) AS n FROM a{i} GROUP BY 1) n ON n.cluster = s.cluster
  UNION ALL SELECT cluster, t, c FROM {now} WHERE cluster NOT IN (SELECT cluster FROM a{i}))"""
        now = f"m{i}"
    return sql + _near("own", now) + f",\ncenters AS (SELECT * FROM {now})"
