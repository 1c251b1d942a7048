"""DuckDB SQL of the vector operators: rounds as a chain of materialised steps.

The SQL holds for vectors of 64 components, as the ``embeddings`` table has.
"""

from __future__ import annotations

_FLOOR_MEAN = "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)"  # exact, rounds down


def _kept(scale: int, columns: str, size: str) -> str:
    return f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, {columns},
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))"""


def _squares(a: str, b: str, n: int) -> str:
    return f"CAST(list_sum(list_transform(range(1, {n + 1}), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i]))) AS BIGINT)"


def clusters_sql(rounds: int = 3) -> str:
    steps = [_kept(64, "vec_id", "len(embedding) = 64"), """c0 AS MATERIALIZED (
    SELECT CAST(place - 1 AS INTEGER) AS k, v
    FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) AS place, v FROM kept)
    WHERE place <= 16)"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
    SELECT r, min({{'d': {_squares('kept.v', f'c{t}.v', 64)}, 'k': k}}) AS best FROM kept, c{t} GROUP BY r)""")
        if t < rounds:
            steps.append(f"""m{t} AS MATERIALIZED (
    SELECT k, list(x ORDER BY i) AS v FROM (
        SELECT best.k AS k, i, CAST({_FLOOR_MEAN} AS BIGINT) AS x
        FROM (SELECT best, i, v[i] AS x FROM a{t} JOIN kept USING (r), range(1, 65) AS t(i)) GROUP BY ALL)
    GROUP BY k),
c{t + 1} AS MATERIALIZED (SELECT c{t}.k, coalesce(m{t}.v, c{t}.v) AS v FROM c{t} LEFT JOIN m{t} ON m{t}.k = c{t}.k)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, best.k AS cluster, best.d AS distance,
    CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.k = best.k
"""


def codes_sql(rounds: int = 6) -> str:
    steps = [_kept(4096, "vec_id, label", "embedding IS NOT NULL"), """parts AS MATERIALIZED (
    SELECT r, p, v[8 * p + 1 : 8 * p + 8] AS v FROM kept, range(8) AS t(p))""", """c0 AS MATERIALIZED (
    SELECT p, place - 1 AS k, parts.v
    FROM (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS place, r FROM kept) JOIN parts USING (r)
    WHERE place <= 16)"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
    SELECT r, p, min({{'d': {_squares('parts.v', f'c{t}.v', 8)}, 'k': k}}) AS best
    FROM parts JOIN c{t} USING (p) GROUP BY r, p)""")
        if t < rounds:
            steps.append(f"""m{t} AS MATERIALIZED (
    SELECT p, k, list(x ORDER BY i) AS v FROM (
        SELECT p, best.k AS k, i, CAST({_FLOOR_MEAN} AS BIGINT) AS x
        FROM (SELECT p, best, i, v[i] AS x FROM a{t} JOIN parts USING (r, p), range(1, 9) AS t(i)) GROUP BY ALL)
    GROUP BY p, k),
c{t + 1} AS MATERIALIZED (
    SELECT c{t}.p, c{t}.k, coalesce(m{t}.v, c{t}.v) AS v
    FROM c{t} LEFT JOIN m{t} ON m{t}.p = c{t}.p AND m{t}.k = c{t}.k)""")
    return "WITH " + ",\n".join(steps) + f""",
codes AS (
    SELECT r, string_agg(format('{{:02x}}', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY r),
book AS (
    SELECT sha256(string_agg(CAST(v[i] AS VARCHAR), ',' ORDER BY p, k, i)) AS digest
    FROM c{rounds}, range(1, 9) AS t(i))
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    digest AS codebooks_sha256
FROM codes JOIN kept USING (r), book
"""
