"""Catalog entries: lineage registry check and audits (DQ16-DQ19), run audit (SNK4)."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from orderlens.operators import metrics as M, profile as PF, quality as Q
from orderlens.operators.orders import ORDER_COLUMNS
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O, oracle_dq as S
from orderlens.plans.catalog import pipeline, register
from orderlens.plans.queries_core import Q2_SELECT, Q4_SQL, Q5_SQL
from orderlens.sources.files import read_registry

REGISTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "metadata", "derived_fields.json")


@register("dq16_registry_check", None)
def dq16(spark, sf):
    p = pipeline(spark, sf)
    return Q.check_registry(read_registry(spark, REGISTRY), p.buyers, p.lines, p.orders)


_Q1 = "SELECT year, hour_company AS hour, count(DISTINCT order_id) AS order_volume FROM ow GROUP BY 1, 2"
_MONEY = {"total_profit": "order_profit", "total_revenue": "order_revenue", "total_referral_discount": "referral_discount_amount"}
_Q3 = ("SELECT CASE WHEN is_referred = 1 THEN 'referred' ELSE 'non_referred' END AS referral_group, "
       + ", ".join(f"{O.msum(c)} AS {n}" for n, c in _MONEY.items()) + " FROM ow GROUP BY 1")
_MSQL = {"q1_hourly_order_volume": _Q1, "q2_profit_by_quarter_segment": Q2_SELECT, "q3_referral_impact": _Q3,
         "q4_black_friday_impact": Q4_SQL, "q5_customer_base_kpis": Q5_SQL}

# The audited tables with faults: (columns replaced, rows added).  The Q3 table is reduced to the columns of its SQL.
BREAKS = {
    "q1_hourly_order_volume": ({"hour": "CASE WHEN hour = 5 THEN 24 ELSE hour END", "year": "CASE WHEN hour = 4 THEN 1969 ELSE year END",
                                "order_volume": "CASE WHEN hour = 0 THEN 0 WHEN hour = 2 THEN NULL ELSE order_volume END"}, "hour < 2"),
    "q2_profit_by_quarter_segment": ({"profit_iqr": "CASE WHEN quarter LIKE '%Q1' THEN profit_iqr + 1 ELSE profit_iqr END",
                                      "profit_volatility": "CASE WHEN quarter LIKE '%Q2' THEN NULL ELSE profit_volatility END",
                                      "avg_profit_per_order": "CASE WHEN quarter LIKE '%Q3' THEN -1.0 ELSE avg_profit_per_order END",
                                      "quarter": "CASE WHEN quarter LIKE '%Q4' THEN '1969Q4' ELSE quarter END"}, "quarter LIKE '%Q2'"),
    "q3_referral_impact": ({"referral_group": "CASE WHEN referral_group = 'referred' THEN 'unknown' ELSE referral_group END",
                            "total_referral_discount": "1.0"}, "true"),
    "q4_black_friday_impact": ({"bf_orders": "-bf_orders - 1"}, "false"),
    "q5_customer_base_kpis": ({"strategic_bucket": "CASE WHEN strategic_bucket = 'CORE' THEN 'OTHER' ELSE strategic_bucket END",
                               "orders_per_customer": "CASE WHEN strategic_bucket = 'EXPAND' THEN orders_per_customer + 1 ELSE orders_per_customer END",
                               "customer_segment": "CASE WHEN strategic_bucket = 'OPTIMIZE' THEN 'NOBODY' ELSE customer_segment END"}, "false"),
}
_CLOSE = "abs(({0}) - ({1})) <= 1e-8 + 1e-5 * abs({1})"


def _metric_ctes(broken: bool) -> str:
    ctes = [f"g_{i} AS ({sql})" for i, sql in enumerate(_MSQL.values())]
    for i, name in enumerate(_MSQL):
        replaced, again = BREAKS[name]
        ctes.append(f"m_{i} AS (SELECT * FROM g_{i})" if not broken else
                    f"h_{i} AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in replaced.items())}) FROM g_{i})")
        if broken:
            ctes.append(f"m_{i} AS (SELECT * FROM h_{i} UNION ALL SELECT * FROM h_{i} WHERE {again})")
    return ", ".join(ctes)


def _dq17_sql(broken: bool = False) -> str:
    """The audit stated anew: every count is a query of its own."""
    lo, hi = P.metric_years
    names = list(_MSQL)

    def rule(rule_id, i, text, count, severity="HIGH"):
        return S.row_sql(rule_id, names[i], text, "v = 0", "v", 0.0, severity, f"FROM (SELECT ({count}) AS v) a")

    rows = lambda i, cond: f"SELECT count(*) FROM m_{i} WHERE {cond}"
    parts = [
        rule("AUD_Q1_HOUR", 0, "hour within 0..23", rows(0, "NOT hour BETWEEN 0 AND 23")),
        rule("AUD_Q1_VOLUME", 0, "order volume positive", rows(0, "order_volume <= 0")),
        rule("AUD_Q1_YEAR", 0, "years inside the metric window", rows(0, f"NOT year BETWEEN {lo} AND {hi}")),
        rule("AUD_Q2_IQR", 1, "IQR equals q75 - q25", rows(1, f"NOT ({_CLOSE.format('profit_iqr', '(q75_profit - q25_profit)')})")),
        rule("AUD_Q2_YEAR", 1, "quarters inside the metric window", rows(1, f"left(quarter, 4) NOT IN ({', '.join(repr(str(y)) for y in range(lo, hi + 1))})")),
        rule("AUD_Q2_NEG_MEAN", 1, "no mean profit below zero", rows(1, "avg_profit_per_order < 0"), "MEDIUM"),
        rule("AUD_Q2_VOLATILITY", 1, "volatility equals IQR / (|median| + 1)", rows(
            1, f"NOT ({_CLOSE.format('profit_volatility', '(profit_iqr / (abs(median_profit_per_order) + 1.0))')})")),
        rule("AUD_Q3_GROUP", 2, "groups are referred / non_referred", rows(2, "referral_group <> 'referred' AND referral_group <> 'non_referred'")),
        rule("AUD_Q3_DISCOUNT", 2, "only referred orders have a referral discount", rows(
            2, "(referral_group = 'referred') <> (total_referral_discount > 0) AND referral_group IN ('referred', 'non_referred')"), "MEDIUM"),
        rule("AUD_Q4_NONNEG", 3, "order counts and lifts non-negative", rows(3, "least(bf_orders, annual_orders, volume_lift_x, revenue_lift_x) < 0")),
        rule("AUD_Q5_BUCKET", 4, "bucket is one of the four labels", rows(4, "NOT list_contains(['CORE', 'EXPAND', 'OPTIMIZE', 'DEPRIORITIZE'], strategic_bucket)")),
        rule("AUD_Q5_RATIO", 4, "orders per customer recomputes", rows(4, f"NOT ({_CLOSE.format('orders_per_customer', O.ratio('order_count', 'unique_customers'))})")),
        rule("AUD_Q1_TOTAL", 0, "Q1 total equals order rows", f"SELECT abs(coalesce((SELECT sum(order_volume) FROM m_0), 0) - "
             f"(SELECT count(*) FROM order_level WHERE year BETWEEN {lo} AND {hi}))"),
        rule("AUD_SEGMENT_SET", 4, "segment sets of Q2 and Q5 agree",
             "SELECT count(*) FROM (SELECT DISTINCT customer_segment AS s FROM m_1) a FULL JOIN (SELECT DISTINCT customer_segment AS s FROM m_4) b "
             "ON a.s = b.s WHERE a.s IS NULL OR b.s IS NULL")]
    for i, (name, tag) in enumerate(Q.AUDITED.items()):
        parts.append(rule(f"AUD_{tag}_NULLS", i, "no cell without a value", f"SELECT coalesce(sum(len(list_filter(json_extract(to_json(t), '$.*'), "
                          f"lambda x: CAST(x AS VARCHAR) = 'null'))), 0) FROM m_{i} t", "MEDIUM"))
        parts.append(rule(f"AUD_{tag}_DUPLICATES", i, "no row appears twice",
                          f"SELECT (SELECT count(*) FROM m_{i}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m_{i}))"))
    return f", {_metric_ctes(broken)}\n" + S.union(*parts)


def _reduced(metrics: dict) -> dict:
    """Metric tables with the columns that the SQL of the audit has (Q3 in short form)."""
    return {**metrics, "q3_referral_impact": metrics["q3_referral_impact"].select("referral_group", *_MONEY)}


@register("dq17_metric_audit", O.with_base(_dq17_sql()))
def dq17(spark, sf):
    o = pipeline(spark, sf).orders
    return Q.audit_metrics(_reduced(M.build_metrics(o, P)), o, P)


@register("dq17b_broken_metrics", O.with_base(_dq17_sql(broken=True)))
def dq17b(spark, sf):
    """The same audit on tables with faults: each of its rules fires."""
    o = pipeline(spark, sf).orders
    tables = _reduced(M.build_metrics(o, P))
    for name, (replaced, again) in BREAKS.items():
        bad = tables[name].select(*[F.expr(replaced.get(c, f"`{c}`")).alias(c) for c in tables[name].columns])
        tables[name] = bad.unionByName(bad.where(again))
    return Q.audit_metrics(tables, o, P)


# counted anew from order rows: groups whose two ways of summing differ (list aggregates against plain ones)
_Q2_BAD = """SELECT count(*) AS v FROM (
  SELECT quarter, customer_segment, avg(order_profit) AS a, median(order_profit) AS m, sum(order_profit) AS t, count(*) AS n,
         list_sort(list(order_profit)) AS l FROM ow GROUP BY 1, 2) g
WHERE abs(list_avg(l) - a) > 1e-6 + 1e-5 * abs(a) OR abs(list_median(l) - m) > 1e-6 + 1e-5 * abs(m)
   OR abs(list_sum(l) - t) > 1e-6 + 1e-5 * abs(t) OR len(l) <> n"""
_Q5_BAD = f"""SELECT count(*) AS v FROM (
  SELECT strategic_bucket, median_profit_per_order >= (SELECT median(median_profit_per_order) FROM q5) AS hp,
         order_count >= (SELECT median(order_count) FROM q5) AS hv FROM q5) b
WHERE strategic_bucket <> CASE WHEN hp AND hv THEN 'CORE' WHEN hp THEN 'EXPAND' WHEN hv THEN 'OPTIMIZE' ELSE 'DEPRIORITIZE' END"""


@register("dq18_recompute_audit", O.with_base(f", q5 AS ({Q5_SQL})\n" + S.union(
    S.row_sql("AUD_RECOMPUTE_Q2", "q2_profit_by_quarter_segment", Q.RECOMPUTE_Q2, "v = 0", "v", 0.0, "HIGH", f"FROM ({_Q2_BAD}) a"),
    S.row_sql("AUD_RECOMPUTE_BUCKET", "q5_customer_base_kpis", Q.RECOMPUTE_BUCKET, "v = 0", "v", 0.0, "HIGH", f"FROM ({_Q5_BAD}) a"))))
def dq18(spark, sf):
    o = pipeline(spark, sf).orders
    return Q.recompute_audit(M.profit_by_quarter_segment(o, P), _recomputed_q2(o), M.segment_kpis(o, P))


def _recomputed_q2(o):
    """Independent recomputation: from the raw order rows, not by the metric operator."""
    from orderlens.functions.numeric import exact_mean, money_sum, rounded
    from orderlens.operators.quantiles import with_group_quantiles
    w, keys = M.in_window(o, P), ["quarter", "customer_segment"]
    return with_group_quantiles(w.groupBy(*keys).agg(
        exact_mean("order_profit").alias("avg_profit_per_order"),
        money_sum("order_profit").alias("total_profit"), F.count_distinct("order_id").alias("order_count")),
        w, keys, "order_profit", [0.5], ["median_profit_per_order"]).withColumn(
        "median_profit_per_order", rounded("median_profit_per_order"))


@register("dq18b_broken_recompute", O.with_base(f", q5 AS ({Q5_SQL})\n" + S.union(
    S.row_sql("AUD_RECOMPUTE_Q2", "q2_profit_by_quarter_segment", Q.RECOMPUTE_Q2, "v = 0", "v", 0.0, "HIGH",
              "FROM (SELECT count(*) AS v FROM (SELECT DISTINCT quarter, customer_segment FROM ow WHERE right(quarter, 2) IN ('Q1', 'Q2', 'Q4'))) a"),
    S.row_sql("AUD_RECOMPUTE_BUCKET", "q5_customer_base_kpis", Q.RECOMPUTE_BUCKET, "v = 0", "v", 0.0, "HIGH",
              "FROM (SELECT count(*) AS v FROM q5 WHERE strategic_bucket IN ('CORE', 'DEPRIORITIZE')) a"))))
def dq18b(spark, sf):
    """The audit on metric tables with wrong means, counts and buckets and without the fourth quarters."""
    o = pipeline(spark, sf).orders
    q2 = M.profit_by_quarter_segment(o, P).where("quarter NOT LIKE '%Q4'").withColumns({
        "avg_profit_per_order": F.expr("CASE WHEN quarter LIKE '%Q1' THEN avg_profit_per_order + 1 ELSE avg_profit_per_order END"),
        "order_count": F.expr("CASE WHEN quarter LIKE '%Q2' THEN order_count + 1 ELSE order_count END")})
    q5 = M.segment_kpis(o, P).withColumn("strategic_bucket", F.expr(
        "CASE strategic_bucket WHEN 'CORE' THEN 'EXPAND' WHEN 'DEPRIORITIZE' THEN 'CORE' ELSE strategic_bucket END"))
    return Q.recompute_audit(q2, _recomputed_q2(o), q5)


# The order table with faults: columns replaced; orders of the hour 23 appear twice.
ORDER_BREAKS = {
    "buyer_id": "CASE WHEN hour_company = 1 THEN NULL ELSE buyer_id END",
    "order_base_revenue": "CASE WHEN hour_company = 3 THEN -order_base_revenue ELSE order_base_revenue END",
    "quarter": "CASE WHEN year = 1997 THEN '97' ELSE quarter END",
    "customer_shipping_fee": "CASE WHEN hour_company = 2 THEN -1.0 ELSE customer_shipping_fee END",
    "year": "CASE WHEN hour_company = 4 THEN 1901 ELSE year END",
    "referral_discount_amount": "CASE WHEN year = 1996 THEN referral_discount_amount + 5 ELSE referral_discount_amount END",
    "hour_company": "CASE WHEN hour_company = 0 THEN 24 ELSE hour_company END",
}
_BROKEN_ORDERS = (f"bo AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in ORDER_BREAKS.items())}) FROM "
                  f"(SELECT * FROM order_level UNION ALL SELECT * FROM order_level WHERE hour_company = 23))")


def broken_orders(orders):
    twice = orders.unionByName(orders.where("hour_company = 23"))
    return twice.select(*[F.expr(ORDER_BREAKS.get(c, c)).alias(c) for c in orders.columns])


def _dq19_sql(table: str) -> str:
    def rule(rule_id, text, count):
        return S.row_sql(rule_id, "order_level", text, "v = 0", "v", 0.0, "HIGH", f"FROM (SELECT ({count}) AS v) a")

    rows = lambda cond: f"SELECT count(*) FROM {table} WHERE {cond}"
    return S.union(
        rule("AUD_O_NULL_KEYS", "order rows with a NULL key or timestamp",
             f"SELECT count(*) - count(order_id || buyer_id || customer_segment || CAST(order_datetime_company AS VARCHAR)) FROM {table}"),
        rule("AUD_O_HOUR", "hour_company within 0..23", rows("NOT hour_company BETWEEN 0 AND 23")),
        rule("AUD_O_QUARTER", "quarter label is YYYYQn", rows("NOT regexp_full_match(quarter, '....Q.')")),
        rule("AUD_O_NEG_BASE", "negative base revenue", rows("order_base_revenue < 0")),
        rule("AUD_O_DISCOUNT_SPLIT", "referral + holiday discount equals base - net revenue", rows("NOT (" + _CLOSE.format(
            "(referral_discount_amount + black_friday_discount_amount)", "(order_base_revenue - order_net_revenue_before_shipping)") + ")")),
        rule("AUD_O_DUP_ID", "duplicate order ids",
             f"SELECT count(*) - count(DISTINCT order_id) - greatest(count(*) - count(order_id) - 1, 0) FROM {table} WHERE order_id IS NOT NULL"))


@register("dq19_order_audit", O.with_base(_dq19_sql("order_level")))
def dq19(spark, sf):
    return Q.order_audit(pipeline(spark, sf).orders)


@register("dq19d_broken_orders", O.with_base(f", {_BROKEN_ORDERS}\n{_dq19_sql('bo')}"))
def dq19d(spark, sf):
    return Q.order_audit(broken_orders(pipeline(spark, sf).orders))


def _order_columns_sql() -> str:
    """Every column of the order table; times and numbers in the text form that Spark writes."""
    text = {"order_datetime_company": "CASE WHEN {0} IS NOT NULL THEN strftime({0}, '%Y-%m-%d %H:%M:%S') END"}
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count_if({c} IS NULL) AS nulls, count(DISTINCT {c}) AS distinct_values,
       {text.get(c, 'CAST({0} AS VARCHAR)').format(f'min({c})')} AS min_value, {text.get(c, 'CAST({0} AS VARCHAR)').format(f'max({c})')} AS max_value
FROM order_level""" for c in ORDER_COLUMNS)


@register("dq19c_order_columns", O.with_base(f"SELECT * FROM ({_order_columns_sql()}) t ORDER BY 1"))
def dq19c(spark, sf):
    p = pipeline(spark, sf)
    return PF.distinct_profile(p.orders, ORDER_COLUMNS, passes=p.parts, keep=lambda df: p.stored(df, "order_columns"))


@register("dq19b_peak_dates", O.with_base(
    "SELECT DISTINCT CAST(order_datetime_company AS DATE) AS peak_date FROM order_level WHERE is_black_friday ORDER BY 1"))
def dq19b(spark, sf):
    return Q.peak_dates(pipeline(spark, sf).orders)


def _snk4_sql() -> str:
    from orderlens.plans import batch
    from orderlens.plans import queries_quality  # noqa: F401  (the rule queries must be registered)
    from orderlens.plans.queries_profile import _body

    rules = "\nUNION ALL ".join(f"SELECT dataset, severity, passed FROM ({_body(k)}) r{i}" for i, k in enumerate(
        ["dq4_buyers_raw_rules", "dq5_sales_raw_rules", "dq6_products_raw_rules", "dq7_cross_dataset_rules", "dq14_quality_report"]))
    tables = {s: "line_fact" if s == "final_line" else s for s in batch.STAGE_GATES}
    settings = json.dumps(P.as_dict(), sort_keys=True).replace("'", "''")
    parts = [f"""SELECT '{stage}' AS stage, (SELECT count(*) FROM {table}) AS rows,
       count_if(severity IN {batch.STAGE_GATES[stage]} AND NOT passed) = 0 AS passed,
       count_if(severity IN {batch.STAGE_GATES[stage]} AND NOT passed) AS failed_rules, '{settings}' AS settings
FROM rules WHERE CASE dataset WHEN 'cross_dataset' THEN 'sales_raw' WHEN 'final_dataset_line' THEN 'final_line' ELSE dataset END = '{stage}'"""
             for stage, table in tables.items()]
    return f", rules AS ({rules})\n" + "\nUNION ALL ".join(parts)


@register("snk4_run_audit", O.with_base(_snk4_sql()))
def snk4(spark, sf):
    from orderlens.plans import batch
    p = pipeline(spark, sf)
    return batch.stage_audit(p, batch.raw_rules(p).unionByName(
        Q.run_quality(p.buyers, p.sales, p.products, p.lines, p.orders, p.params)))
