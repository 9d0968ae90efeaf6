"""Catalog entries of the report tables; each SQL states the table anew."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import clean, joins, profile as PF, reports as R
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.plans.pipeline import lines_max_amount
from orderlens.session import materialize_table

# The segments of the mapped customers.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def top_values(cols, source: str, top: int, where: str = "true") -> str:
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", value, count,
  round(count / (SELECT count(*) FROM {source} WHERE {where}) * 100, 4) AS pct, CAST(rank AS INTEGER) AS rank FROM (
  SELECT CAST({c} AS VARCHAR) AS value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR) ASC NULLS LAST) AS rank
  FROM {source} WHERE {where} GROUP BY 1) x WHERE rank <= {top}""" for c in cols)


BUYER_COLS = ["customer_group", "customer_segment", "region", "preferred_channel", "is_referred"]


@register("eda3b_buyer_distributions", O.with_base(top_values(BUYER_COLS, "buyers_clean", 25)))
def eda3b(spark, sf):
    return R.distributions(pipeline(spark, sf).buyers, BUYER_COLS)


@register("eda7b_status_mix", O.with_base(top_values(["order_status"], "sales_clean", 25)))
def eda7b(spark, sf):
    return R.distributions(pipeline(spark, sf).sales, ["order_status"])


def _counts(name: str, value: str, tail: str = "") -> str:
    return (f"SELECT * FROM (SELECT '{name}' AS \"table\", {value} AS value, count(*) AS count, "
            f"round(count(*) / (SELECT count(*) FROM sales_clean) * 100, 2) AS pct FROM sales_clean GROUP BY 2 {tail}) t_{name}")


@register("eda41b_sales_counts", O.with_base("\nUNION ALL ".join([
    _counts("order_status", "order_status"),
    _counts("quantity", "regexp_replace(format('{:.6f}', quantity), '\\.?0+$', '')"),
    _counts("month", "strftime(order_datetime, '%Y-%m')"),
    _counts("top_sku", "sku_id", "ORDER BY count DESC, value LIMIT 10")])))
def eda41b(spark, sf):
    return R.sales_totals_tables(pipeline(spark, sf).sales)


@register("q3b2_referral_comparison", O.with_base("""
, g AS (SELECT coalesce(is_referred, 0) = 1 AS ref, count(DISTINCT buyer_id) AS c, count(*) AS n,
        CAST(sum(CAST(order_profit AS DECIMAL(20,6))) AS DOUBLE) AS p, CAST(sum(CAST(order_revenue AS DECIMAL(20,6))) AS DOUBLE) AS r
        FROM order_level GROUP BY 1),
l AS (SELECT ref, unnest(['customers', 'orders', 'orders_per_customer', 'avg_profit_per_order', 'total_profit',
             'avg_revenue_per_order', 'total_revenue']) AS measure, unnest(range(7)) AS position,
             unnest([CAST(c AS DOUBLE), n, CAST(n AS DOUBLE) / c, p / n, p, r / n, r]) AS value FROM g)
SELECT CAST(position AS INTEGER) AS position, measure, max(value) FILTER (ref) AS referred, max(value) FILTER (NOT ref) AS non_referred,
       max(value) FILTER (ref) - max(value) FILTER (NOT ref) AS difference FROM l GROUP BY ALL ORDER BY 1"""))
def q3b2(spark, sf):
    return R.referral_comparison(pipeline(spark, sf).orders)


@register("q3l2_profitability_gap", O.with_base(f"""
SELECT *, referred_avg - non_referred_avg AS referred_avg_vs_non_referred FROM (
  SELECT {O.mean('CASE WHEN coalesce(is_referred, 0) = 1 THEN order_profit END')} AS referred_avg,
         {O.mean('CASE WHEN coalesce(is_referred, 0) <> 1 THEN order_profit END')} AS non_referred_avg FROM order_level) t"""))
def q3l2(spark, sf):
    return R.profitability_gap(pipeline(spark, sf).orders)


@register("q2g2_line_segment_summary", O.with_base(f"""
SELECT customer_segment, round({O.mean('profit')}, 2) AS avg_profit_per_order, count(profit) AS order_count,
       round({O.msum('profit')}, 2) AS total_profit FROM lines_max_amount GROUP BY 1 ORDER BY 1"""))
def q2g2(spark, sf):
    return R.line_segment_summary(lines_max_amount(pipeline(spark, sf)))


@register("q5i2_buyers_by_quarter_pivot", O.with_base(f"""
SELECT CAST(year(order_datetime) AS VARCHAR) || '-Q' || CAST(quarter(order_datetime) AS VARCHAR) AS year_quarter,
       {', '.join(f"nullif(count(DISTINCT buyer_id) FILTER (customer_segment = '{s}'), 0) AS " + '"' + s + '"' for s in SEGMENTS)}
FROM line_fact WHERE buyer_id IS NOT NULL GROUP BY 1 ORDER BY 1"""))
def q5i2(spark, sf):
    return R.first_buyers_pivot(pipeline(spark, sf).lines, SEGMENTS)


@register("eda20c_category_groups", O.with_base(f"""
SELECT category_name, count(DISTINCT product_num) AS products, count(*) AS rows, round({O.mean('price', 10)}, 8) AS avg_price,
       round({O.mean('margin', 10)}, 8) AS avg_margin, round({O.mean('TRY_CAST(current_stock AS DOUBLE)', 10)}, 8) AS avg_stock
FROM products_clean GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda20c(spark, sf):
    return R.product_groups(pipeline(spark, sf).products, "category_name")


@register("eda20d_subcategory_groups", O.with_base(f"""
SELECT subcategory_id, count(DISTINCT product_num) AS products, count(*) AS rows, round({O.mean('price', 10)}, 8) AS avg_price,
       round({O.mean('margin', 10)}, 8) AS avg_margin, round({O.mean('TRY_CAST(current_stock AS DOUBLE)', 10)}, 8) AS avg_stock
FROM products_clean GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda20d(spark, sf):
    return R.product_groups(pipeline(spark, sf).products, "subcategory_id")


@register("eda24b_margin_by_vendor", O.with_base(f"""
SELECT vendor, count(*) AS rows, count_if(margin IS NULL) AS nulls, {O.mean('margin', 10)} AS mean,
       round(median(margin), 8) AS median FROM products_clean GROUP BY 1 ORDER BY 1"""))
def eda24b(spark, sf):
    return PF.breakdown(pipeline(spark, sf).products, "vendor", "margin")


SLICE = ["customer_group", "region", "timezone", "preferred_channel", "wishlist_size"]


def _slice_sql(c: str) -> str:
    number = f"CAST({c} AS DOUBLE)" if c == "wishlist_size" else "CAST(NULL AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS nulls, "
            f"round(count_if({c} IS NULL) / nullif(count(*), 0) * 100, 1) AS null_pct, min({number}) AS min, max({number}) AS max, "
            f"round(avg({number}), 8) AS mean FROM buyers_raw WHERE signup_date IS NULL")


@register("eda45b_slice_numbers", O.with_base("\nUNION ALL ".join(map(_slice_sql, SLICE))))
def eda45b(spark, sf):
    return R.slice_numbers(pipeline(spark, sf).buyers_raw, "signup_date IS NULL", SLICE, {"wishlist_size"})


@register("eda46b_region_imputation", O.with_base("""
, m AS (SELECT state, region AS _m FROM (SELECT state, region, count(*) AS c FROM b1
        WHERE state IS NOT NULL AND region IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY state ORDER BY c DESC, region) = 1)
SELECT count_if(region IS NULL) AS nulls_before, count_if(region IS NULL AND _m IS NOT NULL) AS fillable,
       count_if(region IS NULL AND _m IS NULL) AS not_fillable, count_if(coalesce(region, _m) IS NULL) AS nulls_after
FROM b1 LEFT JOIN m USING (state)"""))
def eda46b(spark, sf):
    return PF.imputation_audit(pipeline(spark, sf).buyers_raw, "region", "state")


@register("eda48b_buyer_headline", O.with_base("""
SELECT *, round(active / buyers * 100, 1) AS active_pct, round(referred / buyers * 100, 1) AS referred_pct FROM (
  SELECT count(*) AS buyers, count_if(TRY_CAST(is_active_buyer AS DOUBLE) = 1) AS active,
         count_if(TRY_CAST(is_referred AS DOUBLE) = 1) AS referred FROM buyers_raw) t"""))
def eda48b(spark, sf):
    return R.buyer_headline(pipeline(spark, sf).buyers_raw)


DIFF = ["buyer_id", "sku_id", "quantity", "order_datetime", "order_status"]


@register("eda37b_duplicate_diff_all", O.with_base(", d AS (SELECT * FROM sales_raw WHERE order_id IN (SELECT order_id FROM sales_raw "
          "WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)),\nper AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", order_id, count(DISTINCT coalesce(CAST({c} AS VARCHAR), chr(0) || 'NULL')) AS n FROM d GROUP BY order_id"
    for c in DIFF) + ")\nSELECT \"column\", count(*) AS keys_with_difference FROM per WHERE n > 1 GROUP BY 1 ORDER BY 2 DESC, 1"))
def eda37b(spark, sf):
    return PF.duplicate_diff(pipeline(spark, sf).sales_raw.where("order_id IS NOT NULL").select("order_id", *DIFF), "order_id")


# ---- operators that no other query reaches: J7 and CL1
@register("j7_sales_of_kept_buyers", O.with_base("""
SELECT s.order_id, s.buyer_id, s.sku_id FROM sales_clean s WHERE s.buyer_id IN (SELECT buyer_id FROM buyers_clean)"""))
def j7(spark, sf):
    p = pipeline(spark, sf)
    return joins.semi_filter(p.sales, p.buyers, "buyer_id").select("order_id", "buyer_id", "sku_id")


@register("cl1_clean_layer", O.with_base("""
SELECT 'sales' AS "table", count(*) AS rows FROM sales_clean UNION ALL SELECT 'products', count(*) FROM products_clean
UNION ALL SELECT 'buyers', count(*) FROM buyers_clean"""))
def cl1(spark, sf):
    p = pipeline(spark, sf)
    # the sales are read by the cap, the count and the buyers' first orders: cleaned once, as the pipeline does
    buyers, sales, products, _ = clean.build_clean_layer(p.sales_raw, p.buyers_raw, p.products_raw, p.params,
                                                         keep=lambda df: materialize_table(df, "clean-layer-sales"))
    count = lambda name, df: df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
    return count("sales", sales).unionByName(count("products", products)).unionByName(count("buyers", buyers))


# ---- gates and settings of a run (SNK4 / DQ14)
def _gate_sql(name: str, keys, severities) -> str:
    from orderlens.plans.queries_profile import _body
    rows = "\nUNION ALL ".join(f"SELECT severity, passed FROM ({_body(k)}) r{i}" for i, k in enumerate(keys))
    listed = ", ".join(f"'{s}'" for s in severities)
    return (f"SELECT '{name}' AS gate, coalesce(bool_and(passed) FILTER (severity IN ({listed})), true) AS passed, count(*) AS checks, "
            f"count_if(NOT passed AND severity IN ({listed})) AS failed FROM ({rows}) g_{name}")


_RAW = ["dq4_buyers_raw_rules", "dq5_sales_raw_rules", "dq6_products_raw_rules"]


@register("snk4b_run_gates", O.with_base("\nUNION ALL ".join([
    _gate_sql("raw", _RAW, ("HIGH", "CRITICAL")), _gate_sql("cross", ["dq7_cross_dataset_rules"], ("HIGH", "CRITICAL")),
    _gate_sql("quality", ["dq14_quality_report"], ("HIGH", "MEDIUM"))])))
def snk4b(spark, sf):
    from orderlens.operators import quality as Q
    p = pipeline(spark, sf)
    # the rules of a gate are stored before the next gate's: the disk holds the shuffles of one gate, and of the raw ones before the stage tables
    return R.run_gates({
        "raw": (p.stored(Q.union_rules([Q.validate_buyers_raw(p.buyers_raw), Q.validate_sales_raw(p.sales_raw),
                                        Q.validate_products_raw(p.products_raw)]), "raw_gate"), ("HIGH", "CRITICAL")),
        "cross": (p.stored(Q.validate_cross_dataset(p.sales_raw, p.buyers_raw, p.products_raw, p.params), "cross_gate"), ("HIGH", "CRITICAL")),
        "quality": (p.stored(Q.run_quality(p.buyers, p.sales, p.products, p.lines, p.orders, p.params), "quality_gate"), ("HIGH", "MEDIUM"))})
