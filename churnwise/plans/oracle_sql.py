"""Independent DuckDB SQL for the correctness gate.

Each registered query has an ANSI SQL twin written from the operator's
definition (not generated from the Spark plan). The building blocks below are
common table expressions shared by many twins: the member snapshot and the
scorecard.
"""

from __future__ import annotations

from ..operators.scorecard import INTERCEPT, RATIO_WEIGHT, REFERENCE_MEMBER, SCORECARD_WEIGHTS, SHORT


def fx(expr: str, d: int) -> str:
    """F10 in SQL: floor(x*10^d + 0.5) / 10^d on doubles."""
    s = f"{float(10 ** d)!r}"
    return f"(FLOOR(CAST(({expr}) AS DOUBLE) * {s} + 0.5) / {s})"


def sdiv(a: str, b: str) -> str:
    """F1 in SQL: 0.0 when the denominator is 0 or null."""
    return (f"(CASE WHEN CAST({b} AS DOUBLE) = 0 OR {b} IS NULL THEN 0.0 "
            f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)")


MEMBERS_SQL = """
SELECT c_custkey AS customer_id,
       CAST(c_custkey % 2 AS INTEGER) AS gender,
       CAST(c_nationkey % 5 <> 0 AS INTEGER) AS Near_Location,
       CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INTEGER) AS Partner,
       CAST(c_custkey % 10 < 3 AS INTEGER) AS Promo_friends,
       CAST(c_custkey % 10 <> 9 AS INTEGER) AS Phone,
       CAST(CASE WHEN c_custkey % 9 < 5 THEN 1 WHEN c_custkey % 9 < 7 THEN 6 ELSE 12 END AS INTEGER) AS Contract_period,
       CAST((c_custkey + c_nationkey) % 5 < 2 AS INTEGER) AS Group_visits,
       CAST(18 + c_custkey % 24 AS INTEGER) AS Age,
       CAST(oc.price_before AS DOUBLE) / CAST(oc.n_before AS DOUBLE) / 2000.0 AS Avg_additional_charges_total,
       CAST(CASE WHEN c_custkey % 9 < 5 THEN 1
                 WHEN c_custkey % 9 < 7 THEN 1 + c_custkey % 6
                 ELSE 1 + c_custkey % 12 END AS DOUBLE) AS Month_to_end_contract,
       CAST(FLOOR((c_acctbal + 1000.0) / 1000.0) AS INTEGER) AS Lifetime,
       CAST(COALESCE(lh.lines_hist, 0) AS DOUBLE) / 12.0 AS Avg_class_frequency_total,
       CAST(COALESCE(lh.lines_cur, 0) AS DOUBLE) / 3.0 AS Avg_class_frequency_current_month,
       CAST(oc.n_after = 0 AS INTEGER) AS Churn
FROM customer
JOIN (SELECT o_custkey,
             COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-01-01') AS n_before,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate < TIMESTAMP '2001-01-01') AS price_before,
             COUNT(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-01-01') AS n_after
      FROM orders GROUP BY o_custkey) oc ON oc.o_custkey = c_custkey AND oc.n_before > 0
LEFT JOIN (SELECT o.o_custkey,
                  SUM(li.n) AS lines_hist,
                  SUM(CASE WHEN o.o_orderdate >= TIMESTAMP '2000-01-01' THEN li.n ELSE 0 END) AS lines_cur
           FROM orders o
           JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey
           WHERE o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderdate < TIMESTAMP '2001-01-01'
           GROUP BY o.o_custkey) lh ON lh.o_custkey = c_custkey
"""


def _scorecard_terms_sql(alias: str = "f", values: dict[str, str] | None = None) -> dict[str, str]:
    values = values or {}
    out = {}
    for f, w, _ in SCORECARD_WEIGHTS:
        v = values.get(f, f"{alias}.{f}")
        out[f] = fx(f"{w!r} * (CAST({v} AS DOUBLE) - {float(REFERENCE_MEMBER[f])!r})", 4)
    rv = values.get("ratio_freq_atual_vs_lifetime", f"{alias}.ratio3")
    out["ratio_freq_atual_vs_lifetime"] = fx(f"{RATIO_WEIGHT!r} * (CAST({rv} AS DOUBLE) - 0.95)", 4)
    return out


def scorecard_logit_sql(terms: dict[str, str]) -> str:
    order = [f for f, _, _ in SCORECARD_WEIGHTS] + ["ratio_freq_atual_vs_lifetime"]
    return f"({INTERCEPT!r} + (0.0 + " + " + ".join(terms[f] for f in order) + "))"


def _scored_sql() -> str:
    terms = _scorecard_terms_sql("f")
    cols = ",\n       ".join(f"{terms[f]} AS c_{SHORT[f]}" for f in terms)
    cterms = {f: f"c_{SHORT[f]}" for f in terms}
    logit = scorecard_logit_sql(cterms)
    return f"""
SELECT s.*,
       {fx('p_raw', 5)} AS churn_probability,
       CASE WHEN p_raw >= 0.75 THEN 'critico' WHEN p_raw >= 0.55 THEN 'alto'
            WHEN p_raw >= 0.35 THEN 'medio' ELSE 'baixo' END AS risk_tier,
       CASE WHEN flag_sleeping_dog = 1 THEN 'sleeping_dog'
            WHEN flag_early_user = 1 AND p_raw >= 0.4 THEN 'early_dropper'
            WHEN ratio3 < 0.6 THEN 'desengajado_conteudo'
            WHEN Contract_period <= 1 AND Avg_additional_charges_total < 120 THEN 'preco_sensivel'
            ELSE 'concorrente_driven' END AS archetype
FROM (
  SELECT t.*, 1.0 / (1.0 + EXP(-logit)) AS p_raw
  FROM (
    SELECT c.*, {logit} AS logit
    FROM (
      SELECT f.*,
       {cols}
      FROM (SELECT m.*,
                   {fx(sdiv('Avg_class_frequency_current_month', 'Avg_class_frequency_total'), 3)} AS ratio3,
                   CAST(Lifetime <= 1 AS INTEGER) AS flag_early_user,
                   CAST(Lifetime > 6 AND Avg_class_frequency_current_month < 0.5 AS INTEGER) AS flag_sleeping_dog
            FROM members m) f
    ) c
  ) t
) s
"""


SCORED_SQL = _scored_sql()


def with_members(body: str, scored: bool = False) -> str:
    """Prefix ``body`` with the ``members`` (and optionally ``scored``) CTEs."""
    ctes = f"WITH members AS ({MEMBERS_SQL})"
    if scored:
        ctes += f",\nscored AS ({SCORED_SQL})"
    return f"{ctes}\n{body}"
