"""Catalog entries: data-quality rules (DQ4-DQ16) over the pipeline tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import quality as Q
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O, oracle_dq as S
from orderlens.plans.catalog import pipeline, register

T = P.min_join_coverage_pct


@register("dq4_buyers_raw_rules", O.with_base(S.union(
    S.count_rules_sql("buyers_raw", "buyers_raw", [
        Q.null_rule("RV_B001", "buyer_id", "every row names a buyer"),
        Q.Rule("RV_B003", "referral codes are 0, 1 or missing",
               "is_referred IS NOT NULL AND NOT coalesce(TRY_CAST(is_referred AS DOUBLE) IN (0, 1), false)", "MEDIUM")]),
    S.dup_rule_sql("buyers_raw", ["buyer_id"], "RV_B002", "buyers_raw", "no buyer appears twice"),
    S.literal_rule_sql("RV_B004", "buyers_raw", "signup_date column present", True, 1, None, "INFO"))))
def dq4(spark, sf):
    return Q.validate_buyers_raw(pipeline(spark, sf).buyers_raw)


@register("dq5_sales_raw_rules", O.with_base(S.union(
    S.count_rules_sql("sales_raw", "sales_raw", [
        Q.null_rule("RV_S001", "order_id", "every row names an order"),
        Q.null_rule("RV_S002", "buyer_id", "every row names a buyer"),
        Q.null_rule("RV_S003", "sku_id", "every row names a product key"),
        Q.Rule("RV_S005", "no quantity of zero or less", "TRY_CAST(quantity AS DOUBLE) <= 0", "MEDIUM")]),
    S.literal_rule_sql("RV_S004", "sales_raw", "order_datetime column present", True, 1, None, "INFO"),
    S.literal_rule_sql("RV_S006", "sales_raw", "no required column is missing", True, 0, 0.0, "CRITICAL"))))
def dq5(spark, sf):
    return Q.validate_sales_raw(pipeline(spark, sf).sales_raw)


@register("dq6_products_raw_rules", O.with_base(S.union(
    S.literal_rule_sql("RV_P001", "products_raw", "price column present", True, 1, None, "INFO"),
    S.literal_rule_sql("RV_P002", "products_raw",
                       "a product key is given or can be composed of subcategory, vendor and number",
                       True, 0, 0.0, "CRITICAL"),
    S.literal_rule_sql("RV_P003", "products_raw", "no required column is missing", True, 0, 0.0, "CRITICAL"))))
def dq6(spark, sf):
    return Q.validate_products_raw(pipeline(spark, sf).products_raw)


@register("dq7_cross_dataset_rules", O.with_base(S.union(
    S.coverage_rule_sql("sales_raw", "buyers_raw", "buyer_id", T, "RV_X001", "cross_dataset",
                        f"at least {T}% of the sold-to buyers are known"),
    S.coverage_rule_sql("sales_raw", "products_raw", "sku_id", T, "RV_X002", "cross_dataset",
                        f"at least {T}% of the sold keys are in the catalogue"))))
def dq7(spark, sf):
    p = pipeline(spark, sf)
    return Q.validate_cross_dataset(p.sales_raw, p.buyers_raw, p.products_raw, P)


B_SQL = S.union(S.count_rules_sql("buyers_clean", "buyers_clean", [Q.null_rule("DQ_B001", "buyer_id", "rows without a buyer")]),
                S.dup_rule_sql("buyers_clean", ["buyer_id"], "DQ_B002", "buyers_clean", "buyers that appear more than once"))
S_SQL = S.count_rules_sql("sales_clean", "sales_clean", Q.SALES_CLEAN_RULES)
P_SQL = S.union(S.dup_rule_sql("products_clean", ["sku_id"], "DQ_P001", "products_clean", "product keys that appear more than once"),
                S.count_rules_sql("products_clean", "products_clean", Q.PRODUCTS_CLEAN_RULES))
J_SQL = S.union(
    S.coverage_rule_sql("sales_clean", "line_fact", "buyer_id", T, "DQ_J001", "final_dataset_line",
                        "share of sold-to buyers that reach the line table", "MEDIUM"),
    S.row_sql("DQ_J002", "final_dataset_line", "sold-to buyers that the line table lacks", "true", "v", None,
              "INFO", "FROM (SELECT count(*) AS v FROM (SELECT DISTINCT trim(buyer_id) AS k FROM sales_clean WHERE buyer_id IS NOT NULL) s "
              "WHERE k NOT IN (SELECT trim(buyer_id) FROM line_fact WHERE buyer_id IS NOT NULL)) a"))
OL_SQL = S.union(S.dup_rule_sql("order_level", ["order_id"], "DQ_O001", "order_level",
                                "orders that appear more than once"),
                 S.count_rules_sql("order_level", "order_level", Q.order_rules(P)))


@register("dq9_buyers_clean_rules", O.with_base(B_SQL))
def dq9(spark, sf):
    return Q.check_buyers_clean(pipeline(spark, sf).buyers)


@register("dq10_sales_clean_rules", O.with_base(S_SQL))
def dq10(spark, sf):
    return Q.check_sales_clean(pipeline(spark, sf).sales)


@register("dq11_products_clean_rules", O.with_base(P_SQL))
def dq11(spark, sf):
    return Q.check_products_clean(pipeline(spark, sf).products)


@register("dq12_line_rules", O.with_base(J_SQL))
def dq12(spark, sf):
    p = pipeline(spark, sf)
    return Q.check_final_line(p.lines, p.sales, P)


@register("dq13_order_rules", O.with_base(OL_SQL))
def dq13(spark, sf):
    return Q.check_order_level(pipeline(spark, sf).orders, P)


@register("dq14_quality_report", O.with_base(S.union(B_SQL, S_SQL, P_SQL, J_SQL, OL_SQL)))
def dq14(spark, sf):
    p = pipeline(spark, sf)
    return Q.run_quality(p.buyers, p.sales, p.products, p.lines, p.orders, P)


@register("dq15_quality_summary", O.with_base("""
, cov AS (SELECT count(*) AS n, count(f.hit) AS c FROM (SELECT DISTINCT trim(buyer_id) AS k FROM sales_clean WHERE trim(buyer_id) IS NOT NULL) s
          LEFT JOIN (SELECT DISTINCT trim(buyer_id) AS k, 1 AS hit FROM line_fact) f USING (k)),
cnt AS (SELECT (SELECT count(*) FROM buyers_clean) AS buyers_rows, (SELECT count(*) FROM sales_clean) AS sales_rows,
               (SELECT count(*) FROM products_clean) AS products_rows, (SELECT count(*) FROM line_fact) AS final_line_rows,
               (SELECT count(*) FROM order_level) AS order_level_rows)
SELECT buyers_rows, sales_rows, products_rows, final_line_rows, order_level_rows,
       round(CASE WHEN n > 0 THEN c / n * 100 ELSE 0.0 END, 2) AS coverage_pct,
       round(CASE WHEN sales_rows > 0 THEN final_line_rows / sales_rows * 100 ELSE 0.0 END, 2) AS row_retention_pct,
       n - c AS missing_sales_buyer_ids_in_final FROM cov, cnt"""))
def dq15(spark, sf):
    p = pipeline(spark, sf)
    return Q.quality_summary(p.buyers, p.sales, p.products, p.lines, p.orders)


# The clean tables with faults (columns replaced), so that every rule has something to count.
TABLE_BREAKS = {
    "buyers_clean": {"buyer_id": "CASE WHEN wishlist_size = 7 THEN NULL WHEN wishlist_size = 8 THEN 'twice' ELSE buyer_id END"},
    "sales_clean": {"order_id": "CASE WHEN quantity_original = 11 THEN NULL ELSE order_id END",
                    "buyer_id": "CASE WHEN quantity_original = 12 THEN NULL ELSE buyer_id END",
                    "sku_id": "CASE WHEN quantity_original = 13 THEN NULL ELSE sku_id END",
                    "order_status": "CASE WHEN quantity_original = 14 THEN NULL ELSE order_status END",
                    "quantity": "CASE WHEN quantity_original = 15 THEN NULL WHEN quantity_original = 16 THEN 0.0 "
                                "WHEN quantity_original = 17 THEN quantity_cap_value + 1 ELSE quantity END"},
    "products_clean": {"sku_id": "CASE WHEN margin BETWEEN 0.1 AND 0.115 THEN 'SKU-TWICE' ELSE sku_id END",
                       "price": "CASE WHEN margin BETWEEN 0.2 AND 0.215 THEN NULL WHEN margin BETWEEN 0.3 AND 0.315 THEN -price ELSE price END",
                       "margin": "CASE WHEN margin BETWEEN 0.4 AND 0.415 THEN 1.5 WHEN margin BETWEEN 0.5 AND 0.515 THEN -1.5 ELSE margin END"},
}


def _broken_sql() -> str:
    """Counts of the faults, each stated anew."""
    from orderlens.plans.queries_audit import _BROKEN_ORDERS
    tables = {"buyers_clean": "bb", "sales_clean": "bs", "products_clean": "bp"}
    ctes = [f"{short} AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in TABLE_BREAKS[t].items())}) FROM {t})" for t, short in tables.items()]
    lo, hi = P.order_year_band

    def rule(rule_id, dataset, text, count, severity="HIGH", info=False):
        return S.row_sql(rule_id, dataset, text, "true" if info else "v = 0", "v", None if info else 0.0, severity, f"FROM (SELECT ({count}) AS v) a")

    def count(table, cond):
        return f"SELECT count(*) FROM {table} WHERE {cond}"

    def repeats(table, key):
        return f"SELECT (SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table}))"

    parts = [
        rule("DQ_B001", "buyers_clean", "rows without a buyer", count("bb", "buyer_id IS NULL")),
        rule("DQ_B002", "buyers_clean", "buyers that appear more than once", repeats("bb", "buyer_id")),
        rule("DQ_S001", "sales_clean", "lines without an order", count("bs", "order_id IS NULL")),
        rule("DQ_S002", "sales_clean", "rows without a buyer", count("bs", "buyer_id IS NULL")),
        rule("DQ_S003", "sales_clean", "lines without a product key", count("bs", "sku_id IS NULL")),
        rule("DQ_S004", "sales_clean", "lines without a status", count("bs", "order_status IS NULL")),
        rule("DQ_S005", "sales_clean", "lines whose quantity is no number", count("bs", "quantity IS NULL")),
        rule("DQ_S006", "sales_clean", "lines with a quantity of zero or less", count("bs", "quantity <= 0")),
        rule("DQ_S007", "sales_clean", "lines whose quantity was lowered to the cap", count("bs", "quantity_original > quantity_cap_value"), "INFO", True),
        rule("DQ_S008", "sales_clean", "lines still above the cap", count("bs", "quantity > quantity_cap_value")),
        rule("DQ_P001", "products_clean", "product keys that appear more than once", repeats("bp", "sku_id")),
        rule("DQ_P002", "products_clean", "products without a price", count("bp", "price IS NULL"), "INFO", True),
        rule("DQ_P003", "products_clean", "products with a price below zero", count("bp", "price < 0")),
        rule("DQ_P004", "products_clean", "margins below minus one", count("bp", "margin < -1"), "MEDIUM"),
        rule("DQ_P005", "products_clean", "margins above one", count("bp", "margin > 1"), "MEDIUM"),
        rule("DQ_O001", "order_level", "orders that appear more than once", repeats("bo", "order_id")),
        rule("DQ_O005", "order_level", f"orders outside the years {lo} to {hi}", count("bo", f"NOT year BETWEEN {lo} AND {hi}")),
        rule("DQ_O002", "order_level", "orders with a shipping fee below zero", count("bo", "customer_shipping_fee < 0")),
        rule("DQ_O003", "order_level", "orders with revenue below zero", count("bo", "order_revenue < 0"), "INFO", True),
        rule("DQ_O004", "order_level", "orders that lose money", count("bo", "order_profit < 0"), "MEDIUM", True)]
    return f", {', '.join([*ctes, _BROKEN_ORDERS])}\n" + S.union(*parts)


@register("dq14b_broken_tables", O.with_base(_broken_sql()))
def dq14b(spark, sf):
    """DQ9, DQ10, DQ11 and DQ13 on tables with faults: each of their rules counts some."""
    from orderlens.plans.queries_audit import broken_orders
    p = pipeline(spark, sf)

    def broken(df, name):
        return df.select(*[F.expr(TABLE_BREAKS[name].get(c, f"`{c}`")).alias(c) for c in df.columns])

    return Q.union_rules([Q.check_buyers_clean(broken(p.buyers, "buyers_clean")), Q.check_sales_clean(broken(p.sales, "sales_clean")),
                          Q.check_products_clean(broken(p.products, "products_clean")), Q.check_order_level(broken_orders(p.orders), P)])
