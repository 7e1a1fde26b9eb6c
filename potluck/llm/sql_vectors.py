"""DuckDB SQL of the vector queries: every round is a pair of tables, nearest
entries and their moved positions.  Sums are whole numbers (exact), and floors
of means are taken on whole numbers."""

from __future__ import annotations


def _kept(scale: int, where: str = "") -> str:
    return f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0{where})"""


_FLOOR = "CAST(({s} - (({s} % {n}) + {n}) % {n}) // {n} AS BIGINT)"


def clusters(k: int = 8, length: int = 64, rounds: int = 10, scale: int = 1024, salt: str = "3:") -> str:
    """op13: vec_id, cluster, distance and sums."""
    parts = [_kept(scale, f" AND len(embedding) = {length}"),
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v AS m FROM
  (SELECT sha256('{salt}' || CAST(vec_id AS VARCHAR)) AS h, vec_id, v FROM kept ORDER BY h NULLS LAST, vec_id, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (SELECT rid, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept, c{r}),
a{r} AS MATERIALIZED (SELECT rid, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            floor = _FLOOR.format(s="s", n="n")
            parts.append(f"""m{r} AS (SELECT c, list({floor} ORDER BY i) AS m FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM
  (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept JOIN a{r} ON kept.rid = a{r}.rid) GROUP BY c, i) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN m{r} n ON o.c = n.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT kept.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} a ON kept.rid = a.rid JOIN c{rounds} z ON a.c = z.c"""


def codes(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """op11 for vectors of one length that the parts divide."""
    width = f"(len(v) // {parts})"
    steps = [_kept(scale),
             f"""piece AS MATERIALIZED (SELECT rid, vec_id, p, v[p * {width} + 1:(p + 1) * {width}] AS x FROM kept, (SELECT unnest(range({parts})) AS p)),
e0 AS MATERIALIZED (SELECT p, e, x AS m FROM piece JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept
  ORDER BY e LIMIT {entries}) f ON piece.rid = f.rid)"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT rid, piece.p, e, list_sum(list_transform(list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM piece JOIN e{r} ON piece.p = e{r}.p),
a{r} AS MATERIALIZED (SELECT rid, p, min(d) AS d, arg_min(e, d * {entries} + e) AS e FROM d{r} GROUP BY rid, p)""")
        if r < rounds:
            floor = _FLOOR.format(s="s", n="n")
            steps.append(f"""m{r} AS (SELECT p, e, list({floor} ORDER BY i) AS m FROM (SELECT p, e, i, sum(c) AS s, count(*) AS n FROM
  (SELECT piece.p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM piece JOIN a{r} ON piece.rid = a{r}.rid AND piece.p = a{r}.p)
  GROUP BY p, e, i) GROUP BY p, e),
e{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(n.m, o.m) AS m FROM e{r} o LEFT JOIN m{r} n ON o.p = n.p AND o.e = n.e)""")
    return "WITH " + ",\n".join(steps) + f""",
done AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
books AS (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY p, e)) AS h FROM e{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN done ON kept.rid = done.rid, books"""
