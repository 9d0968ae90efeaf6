"""SQL text for the data-quality rule queries, generated from the same rule
specs the Spark operators evaluate (conditions are shared SQL predicates)."""

from __future__ import annotations

from orderlens.operators.quality import Rule


def _lit(x) -> str:
    return "NULL" if x is None else ("'" + str(x).replace("'", "''") + "'")


def row_sql(rule_id, dataset, description, passed, value, threshold, severity, src: str = "") -> str:
    th = "CAST(NULL AS DOUBLE)" if threshold is None else f"CAST({threshold} AS DOUBLE)"
    return (f"SELECT {_lit(rule_id)} AS rule_id, {_lit(dataset)} AS dataset, {_lit(description)} AS description, "
            f"CAST({passed} AS BOOLEAN) AS passed, CAST({value} AS DOUBLE) AS value, {th} AS threshold, "
            f"{_lit(severity)} AS severity {src}")


def count_rules_sql(table: str, dataset: str, rules: list[Rule]) -> str:
    aggs = ", ".join(f"count_if({r.cond}) AS v{i}" for i, r in enumerate(rules))
    parts = []
    for i, r in enumerate(rules):
        passed = "true" if r.info else f"v{i} = 0"
        parts.append(row_sql(r.rule_id, dataset, r.description, passed, f"v{i}", None if r.info else 0.0, r.severity,
                             f"FROM (SELECT {aggs} FROM {table}) a"))
    return "\nUNION ALL ".join(parts)


def dup_rule_sql(table: str, keys, rule_id, dataset, description, severity="HIGH") -> str:
    k = ", ".join(keys)
    return row_sql(rule_id, dataset, description, "v = 0", "v", 0.0, severity,
                   f"FROM (SELECT coalesce(sum(n - 1), 0) AS v FROM (SELECT count(*) AS n FROM {table} GROUP BY {k}) g) a")


def coverage_sql(left: str, right: str, key: str, lkey_expr: str | None = None, rkey_expr: str | None = None) -> str:
    lk, rk = lkey_expr or key, rkey_expr or key
    return (f"SELECT CASE WHEN count(*) > 0 THEN count(r.hit) / count(*) * 100 ELSE 0.0 END AS v FROM "
            f"(SELECT DISTINCT {lk} AS k FROM {left} WHERE {lk} IS NOT NULL) l LEFT JOIN "
            f"(SELECT DISTINCT {rk} AS k, 1 AS hit FROM {right} WHERE {rk} IS NOT NULL) r USING (k)")


def coverage_rule_sql(left, right, key, threshold, rule_id, dataset, description, severity="HIGH") -> str:
    return row_sql(rule_id, dataset, description, f"CASE WHEN v >= 0 THEN v >= {threshold} ELSE false END", "v",
                   threshold, severity, f"FROM ({coverage_sql(left, right, key)}) a")


def literal_rule_sql(rule_id, dataset, description, passed: bool, value, threshold, severity) -> str:
    return row_sql(rule_id, dataset, description, "true" if passed else "false", value, threshold, severity)


def union(*parts: str) -> str:
    return "\nUNION ALL ".join(f"({p})" for p in parts)
