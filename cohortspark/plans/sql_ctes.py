"""DuckDB twins of the role bindings and shared steps, as named CTEs.

``with_ctes(body, *names)`` prepends the named CTEs (and their
dependencies, in order) to ``body``.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()):
    CTES[name] = (deps, sql.strip())


def _order(names, seen, out):
    for n in names:
        if n in seen:
            continue
        deps, _ = CTES[n]
        _order(deps, seen, out)
        seen.add(n)
        out.append(n)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []
    _order(names, set(), order)
    if not order:
        return body.strip()
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# ---- bindings ---------------------------------------------------------------
cte("samples", "SELECT c_custkey AS sample_id, c_mktsegment AS label FROM customer")
cte("classes", "SELECT DISTINCT label AS class FROM samples", ("samples",))
cte("lines", """
SELECT l.l_partkey, l.l_quantity, l.l_discount, l.l_returnflag, o.o_custkey, c.c_mktsegment
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey""")
cte("expr_long", """
SELECT x.c_mktsegment AS cohort, x.o_custkey AS sample_id, p.p_brand AS feature, x.l_quantity AS value
FROM lines x JOIN part p ON x.l_partkey = p.p_partkey""", ("lines",))
cte("cnv_long", """
SELECT x.c_mktsegment AS cohort, x.o_custkey AS sample_id, concat('S', CAST(p.p_size AS VARCHAR)) AS feature,
       nullif(x.l_discount, 0.0) AS value
FROM lines x JOIN part p ON x.l_partkey = p.p_partkey""", ("lines",))
cte("mut_events", """
SELECT x.c_mktsegment AS cohort, x.o_custkey AS sample_id, p.p_type AS feature, x.l_returnflag AS variant_class
FROM lines x JOIN part p ON x.l_partkey = p.p_partkey""", ("lines",))
cte("act_events", "SELECT user_id AS sample_id, event_type AS feature, value FROM events")
cte("mirna_long", """
SELECT c.c_mktsegment AS cohort, o.o_custkey AS sample_id, o.o_orderpriority AS feature, o.o_totalprice AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
cte("folds", """
SELECT sample_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42', '-', CAST(sample_id AS VARCHAR))), sample_id) - 1) % 5 AS INTEGER) AS fold
FROM samples""", ("samples",))
cte("cohort_codes", """
SELECT cohort, CAST(dense_rank() OVER (ORDER BY cohort) - 1 AS INTEGER) AS ordinal
FROM (SELECT DISTINCT cohort FROM expr_long)""", ("expr_long",))
cte("expr_cells", """
SELECT sample_id, feature, avg(value) AS value FROM expr_long
WHERE sample_id IS NOT NULL AND feature IS NOT NULL AND value IS NOT NULL
GROUP BY sample_id, feature""", ("expr_long",))
cte("mut_presence", """
SELECT DISTINCT sample_id, feature, 1 AS value FROM mut_events
WHERE variant_class IN ('A', 'R') AND sample_id IS NOT NULL AND feature IS NOT NULL""", ("mut_events",))


def frequency_expert_ctes(prefix: str, long_cte: str, weight_expr: str, where: str = "TRUE",
                          folds: str = "folds", classes: str = "classes"):
    """CTEs ``{prefix}_dom``, ``{prefix}_assigned``, ``{prefix}_model``, ``{prefix}_oof``."""
    cte(f"{prefix}_dom", f"""
SELECT sample_id, feature FROM (
  SELECT sample_id, feature, row_number() OVER (PARTITION BY sample_id ORDER BY w DESC, feature) AS rn
  FROM (SELECT sample_id, feature, sum({weight_expr}) AS w FROM {long_cte} WHERE {where} GROUP BY sample_id, feature))
WHERE rn = 1""", (long_cte,))
    cte(f"{prefix}_assigned", f"""
SELECT d.sample_id, d.feature, f.label, f.fold FROM {prefix}_dom d JOIN {folds} f ON d.sample_id = f.sample_id""",
        (f"{prefix}_dom", folds))
    cte(f"{prefix}_model", f"""
SELECT feature, fold, class,
  CAST(sum(n) OVER (PARTITION BY feature, class) - n + 1 AS DOUBLE)
  / CAST(sum(n) OVER (PARTITION BY feature) - sum(n) OVER (PARTITION BY feature, fold)
         + (SELECT count(*) FROM {classes}) AS DOUBLE) AS prob
FROM (
  SELECT g.feature, g.fold, g.class, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT a.feature, CAST(r.range AS INTEGER) AS fold, k.class
        FROM {prefix}_assigned a CROSS JOIN range(5) r CROSS JOIN {classes} k) g
  LEFT JOIN (SELECT feature, label AS class, fold, count(*) AS n FROM {prefix}_assigned GROUP BY ALL) c
    ON g.feature = c.feature AND g.class = c.class AND g.fold = c.fold)""", (f"{prefix}_assigned", classes))
    cte(f"{prefix}_oof", f"""
SELECT a.sample_id, a.label, a.fold, m.class, m.prob
FROM {prefix}_assigned a JOIN {prefix}_model m ON a.feature = m.feature AND a.fold = m.fold""",
        (f"{prefix}_assigned", f"{prefix}_model"))


frequency_expert_ctes("fx_expr", "expr_long", "value")
frequency_expert_ctes("fx_mut", "mut_events", "1", "variant_class IN ('A', 'R')")
frequency_expert_ctes("fx_act", "act_events", "1")

cte("fx_expr_pred", """
SELECT sample_id, label, fold, arg_min(class, (-prob, class)) AS pred FROM fx_expr_oof GROUP BY ALL""",
    ("fx_expr_oof",))
