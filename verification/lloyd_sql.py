"""k-means on the grid in SQL: the rule of ``partylens.operators.lloyd`` written out round by round."""

from __future__ import annotations

ROUNDS = 20


def _away(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::HUGEINT"


def lloyd(name: str, points: str, ks: list[int], rounds: int = ROUNDS) -> str:
    """WITH entries over ``points (id, v)``: ``<name>_near (k, id, e, d)`` and ``<name>_cost (k, cost)``."""
    most = max(ks)
    parts = [f"""
{name}_scale AS (SELECT pow(2, (60 - ceil(log2(greatest(max(len(v)), 1))))::BIGINT // 2
  - coalesce(CASE WHEN max(list_max(list_transform(v, lambda x: abs(x)))) > 0 THEN ceil(log2(max(list_max(list_transform(v, lambda x: abs(x)))))) END, 0)) AS s FROM {points}),
{name}_grid AS MATERIALIZED (SELECT id, list_transform(v, lambda x: floor(x * s)::BIGINT) AS v FROM {points}, {name}_scale),
{name}_seed1 AS MATERIALIZED (SELECT 1 AS n, v FROM {name}_grid ORDER BY list_sum(list_transform(v, lambda x: x * x)) DESC, v LIMIT 1)"""]
    for n in range(2, most + 1):
        parts.append(f"""
{name}_seed{n} AS MATERIALIZED (SELECT * FROM {name}_seed{n - 1} UNION ALL SELECT * FROM (SELECT {n}, g.v FROM {name}_grid g, {name}_seed{n - 1} s
  GROUP BY g.id, g.v HAVING min({_away('g.v', 's.v')}) > 0 ORDER BY min({_away('g.v', 's.v')}) DESC, g.v LIMIT 1))""")
    parts.append(f"""
{name}_c0 AS (SELECT k, n - 1 AS e, v FROM {name}_seed{most}, (SELECT unnest({list(ks)}) AS k) WHERE n <= k)""")
    for t in range(rounds + 1):
        parts.append(f"""
{name}_n{t} AS MATERIALIZED (SELECT k, id, e, {_away('g.v', 'c.v')} AS d FROM {name}_grid g, {name}_c{t} c
  QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY d, e) = 1)""")
        if t < rounds:
            parts.append(f"""
{name}_m{t} AS (SELECT k, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
  SELECT k, e, i, sum(x) AS s, count(*) AS n FROM (
    SELECT k, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM {name}_n{t} JOIN {name}_grid USING (id)) GROUP BY ALL) GROUP BY ALL),
{name}_c{t + 1} AS MATERIALIZED (SELECT k, e, coalesce(m.v, c.v) AS v FROM {name}_c{t} c LEFT JOIN {name}_m{t} m USING (k, e))""")
    parts.append(f"""
{name}_near AS (SELECT * FROM {name}_n{rounds}),
{name}_cost AS (SELECT k, sum(d)::DOUBLE / (any_value(s) * any_value(s)) AS cost FROM {name}_near, {name}_scale GROUP BY k)""")
    return ",".join(["", *parts])
