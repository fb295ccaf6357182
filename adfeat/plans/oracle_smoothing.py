"""DuckDB oracle SQL for the Beta-prior fit and the smoothed rates (M1, M2).

DuckDB has no digamma, so the fit uses the exact identity for integer v
``ψ(v + a) − ψ(a) = Σ_{k<v} 1/(a + k)``: with tail counts
``T(k) = #pairs with value > k`` each step is ``Σ_k T(k) / (a + k)``.  The
iteration is a recursive CTE that stops like the reference (break before
storing a step whose moves are both below ε).
"""

from __future__ import annotations

from adfeat.plans.sql_views import with_views


def _fit_ctes(pairs_sql: str, iter_num: int, epsilon: float, tag: str) -> str:
    return f"""
{tag}_pairs AS ({pairs_sql}),
{tag}_vals AS (
  SELECT 'c' AS kind, c AS v, w FROM {tag}_pairs
  UNION ALL SELECT 'u', n - c, w FROM {tag}_pairs
  UNION ALL SELECT 'n', n, w FROM {tag}_pairs
),
{tag}_ks AS (SELECT unnest(range(0, (SELECT max(v) FROM {tag}_vals))) AS k),
{tag}_tails AS (
  SELECT kind, k, CAST(sum(w) AS DOUBLE) AS t
  FROM {tag}_vals JOIN {tag}_ks ON v > k GROUP BY kind, k
),
{tag}_fit(i, a, b, done) AS (
  SELECT 0, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE), false
  UNION ALL
  SELECT i + 1, CASE WHEN conv THEN a ELSE na END, CASE WHEN conv THEN b ELSE nb END, conv
  FROM (
    SELECT i, a, b, na, nb, (abs(na - a) < {epsilon} AND abs(nb - b) < {epsilon}) AS conv
    FROM (
      SELECT f.i, f.a, f.b,
        f.a * sum(CASE WHEN kind = 'c' THEN t / (f.a + k) ELSE 0 END)
            / sum(CASE WHEN kind = 'n' THEN t / (f.a + f.b + k) ELSE 0 END) AS na,
        f.b * sum(CASE WHEN kind = 'u' THEN t / (f.b + k) ELSE 0 END)
            / sum(CASE WHEN kind = 'n' THEN t / (f.a + f.b + k) ELSE 0 END) AS nb
      FROM {tag}_fit f, {tag}_tails
      WHERE NOT f.done AND f.i < {iter_num}
      GROUP BY f.i, f.a, f.b
    ) s1
  ) s2
),
{tag}_prior AS (SELECT a AS alpha, b AS beta FROM {tag}_fit ORDER BY i DESC LIMIT 1)"""


def _key_pairs(key: str) -> str:
    return (
        f"SELECT {key}, count(is_trade) AS n, count(*) FILTER (WHERE is_trade = 1) AS c, 1 AS w "
        f"FROM hist WHERE {key} IS NOT NULL GROUP BY {key}"
    )


def beta_prior_sql() -> str:
    prelude = with_views("imp_lineitem").replace("WITH ", "WITH RECURSIVE ", 1)
    return prelude + "," + _fit_ctes(_key_pairs("shop_id"), 1000, 0.001, "s") + (
        "\nSELECT round(alpha, 6) AS alpha, round(beta, 6) AS beta FROM s_prior"
    )


def key_smoothed_sql(key: str, prefix: str) -> str:
    prelude = with_views("imp_lineitem").replace("WITH ", "WITH RECURSIVE ", 1)
    n, c, s = f"{prefix}_trade_sum", f"{prefix}_trade_count", f"{prefix}_trade_smooth"
    return (
        prelude
        + ","
        + _fit_ctes(_key_pairs(key), 1000, 0.001, "s")
        + f"""
SELECT t.instance_id, t.{key},
       coalesce(p.n, 0) AS {n}, coalesce(p.c, 0) AS {c},
       round(CASE WHEN p.{key} IS NULL THEN alpha / (alpha + beta)
                  ELSE (p.c + alpha) / (p.n + alpha + beta) END, 6) AS {s}
FROM tgt t LEFT JOIN s_pairs p ON t.{key} = p.{key}, s_prior"""
    )


def user_smoothed_sql() -> str:
    prelude = with_views("imp_lineitem").replace("WITH ", "WITH RECURSIVE ", 1)
    rows = """
u_counts AS (SELECT user_id, count(is_trade) AS n, count(*) FILTER (WHERE is_trade = 1) AS c
             FROM hist WHERE user_id IS NOT NULL GROUP BY user_id),
u_rows AS (SELECT t.instance_id, t.user_id, coalesce(u.n, 0) AS n, coalesce(u.c, 0) AS c
           FROM tgt t LEFT JOIN u_counts u ON t.user_id = u.user_id),"""
    return (
        prelude
        + ","
        + rows
        + _fit_ctes("SELECT n, c, 1 AS w FROM u_rows", 100, 0.001, "s")
        + """
SELECT r.instance_id, r.user_id, r.n AS user_trade_sum, r.c AS user_trade_count,
       round((r.c + alpha) / (r.n + alpha + beta), 6) AS user_trade_smooth
FROM u_rows r, s_prior"""
    )


def shop_digamma_sql() -> str:
    """For whole n, ψ(n + 1) − ψ(1) is the n-th harmonic number."""
    return with_views("imp_lineitem") + (
        "\nSELECT shop_id, n, round(coalesce(list_sum(list_transform(range(1, n + 1), lambda k: 1.0 / k)), 0), 9) AS digamma_diff "
        "FROM (SELECT shop_id, count(is_trade) AS n FROM hist WHERE shop_id IS NOT NULL GROUP BY shop_id)"
    )
