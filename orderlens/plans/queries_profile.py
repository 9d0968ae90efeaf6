"""Catalog entries: profiling and exploration tables (EDA*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.functions.text import strip_ws
from orderlens.operators import profile as PF
from orderlens.operators.clean import SALES_KEY
from orderlens.operators.orders import ORDER_COLUMNS
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.session import materialize_table, temporary_folder
from orderlens.sinks import SnapshotStore


def _long(dataset: str, items: list[tuple[str, str]], src: str) -> str:
    def one(e: str) -> str:
        return e if e.startswith("(SELECT") else f"(SELECT {e} FROM {src})"
    return "\nUNION ALL ".join(f"SELECT '{dataset}' AS dataset, '{m}' AS metric, CAST({one(e)} AS DOUBLE) AS value"
                               for m, e in items)


def _five(col: str, prefix: str) -> list[tuple[str, str]]:
    c = f"TRY_CAST({col} AS DOUBLE)"
    return [(f"{prefix}.count", f"count({c})"), (f"{prefix}.min", f"min({c})"),
            (f"{prefix}.p25", f"round(quantile_cont({c}, 0.25), 8)"), (f"{prefix}.median", f"round(quantile_cont({c}, 0.5), 8)"),
            (f"{prefix}.p75", f"round(quantile_cont({c}, 0.75), 8)"), (f"{prefix}.max", f"max({c})")]


def _dups(table: str, keys: str) -> str:
    return f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}) g)"


@register("eda1_null_profile", O.with_base(_long("order_level", [(f"null_profile.{c}", f"count_if({c} IS NULL)")
                                                                for c in ORDER_COLUMNS], "order_level")))
def eda1(spark, sf):
    return PF.null_profile(pipeline(spark, sf).orders, "order_level")


@register("eda2_distribution", O.with_base("""
SELECT 'customer_segment' AS "column", value, count, round(count / sum(count) OVER () * 100, 4) AS pct,
       CAST(row_number() OVER (ORDER BY count DESC, value ASC NULLS LAST) AS INTEGER) AS rank
FROM (SELECT CAST(customer_segment AS STRING) AS value, count(*) AS count FROM buyers_clean GROUP BY 1) g
QUALIFY rank <= 25"""))
def eda2(spark, sf):
    return PF.distribution(pipeline(spark, sf).buyers, "customer_segment", 25)


@register("eda3_buyers_summary", O.with_base(_long("buyers", [
    ("rows", "count(*)"), ("duplicate_buyer_id_count", _dups("buyers_clean", "buyer_id")),
    ("invalid_referral_count", "count_if(is_referred_invalid)")], "buyers_clean")))
def eda3(spark, sf):
    return PF.buyers_summary(pipeline(spark, sf).buyers)


@register("eda4_five_number", O.with_base(_long("sales", _five("quantity", "quantity_summary"), "sales_clean")))
def eda4(spark, sf):
    return PF.five_number(pipeline(spark, sf).sales, "quantity", "sales", "quantity_summary")


@register("eda5_sales_monthly", O.with_base("""
SELECT strftime(order_datetime, '%Y-%m') AS year_month, count(DISTINCT order_id) AS order_count, count(*) AS line_count
FROM sales_clean WHERE order_datetime IS NOT NULL GROUP BY 1 ORDER BY 1"""))
def eda5(spark, sf):
    return PF.sales_monthly(pipeline(spark, sf).sales)


@register("eda6_top_skus", O.with_base("""
SELECT sku_id, count(*) AS line_count, count(DISTINCT order_id) AS order_count,
       CAST(sum(CAST(quantity AS DECIMAL(20,6))) AS DOUBLE) AS total_quantity
FROM sales_clean GROUP BY 1 ORDER BY line_count DESC, order_count DESC, sku_id LIMIT 100"""))
def eda6(spark, sf):
    return PF.top_skus(pipeline(spark, sf).sales)


def _bounds(cols):
    out = []
    for c in cols:
        v = f"TRY_CAST({c} AS DOUBLE)"
        out += [(f"numeric_bounds.{c}.null_count", f"count_if({v} IS NULL)"), (f"numeric_bounds.{c}.min", f"min({v})"),
                (f"numeric_bounds.{c}.max", f"max({v})"), (f"numeric_bounds.{c}.mean", O.mean(v, 10))]
    return out


@register("eda8_numeric_bounds", O.with_base(_long("products", _bounds(["price", "margin", "current_stock"]), "products_clean")))
def eda8(spark, sf):
    return PF.numeric_bounds(pipeline(spark, sf).products, ["price", "margin", "current_stock"], "products")


@register("eda9_category_skus", O.with_base("""
SELECT category_name, count(DISTINCT sku_id) AS sku_count FROM products_clean GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda9(spark, sf):
    return PF.category_skus(pipeline(spark, sf).products)


@register("eda10_products_summary", O.with_base(_long("products", [
    ("rows", "count(*)"), ("duplicate_sku_id_count", _dups("products_clean", "sku_id")),
    ("margin_imputed_count", "count_if(margin_imputed)"),
    ("vendor_product_conflict_count", "sum(CASE WHEN active_flag = 1 AND vendor_flag = 0 THEN 1 ELSE 0 END)"),
    ("inactive_with_stock_count", "count_if(active_flag = 0 AND TRY_CAST(current_stock AS DOUBLE) > 0)")],
    "(SELECT *, " + ", ".join(
        f"CASE WHEN lower(trim({c})) IN ('1', 'true', 'y') THEN 1 WHEN lower(trim({c})) IN ('0', 'false', 'n') THEN 0 END AS {a}"
        for c, a in [("active_product", "active_flag"), ("currently_active_vendor", "vendor_flag")]) + " FROM products_clean) pc")))
def eda10(spark, sf):
    return PF.products_summary(pipeline(spark, sf).products)


@register("eda11_line_summary", O.with_base(_long("final_line", [
    ("rows", "count(*)"), ("duplicate_order_buyer_sku_count", _dups("line_fact", "order_id, buyer_id, sku_id"))], "line_fact")))
def eda11(spark, sf):
    return PF.line_summary(pipeline(spark, sf).lines)


@register("eda12_orders_monthly", O.with_base(f"""
SELECT strftime(order_datetime_company, '%Y-%m') AS year_month, count(DISTINCT order_id) AS order_count,
       {O.msum('order_revenue')} AS total_revenue, {O.msum('order_profit')} AS total_profit
FROM order_level WHERE order_datetime_company IS NOT NULL GROUP BY 1 ORDER BY 1"""))
def eda12(spark, sf):
    return PF.orders_monthly(pipeline(spark, sf).orders)


@register("eda13_orders_summary", O.with_base(_long("order_level", [
    ("rows", "count(*)"), ("duplicate_order_id_count", _dups("order_level", "order_id")),
    ("order_profit_summary.negative_order_profit_count", "count_if(order_profit < 0)")] +
    _five("order_profit", "order_profit_summary"), "order_level")))
def eda13(spark, sf):
    return PF.orders_summary(pipeline(spark, sf).orders)


@register("eda16_describe_profit", O.with_base(_long("order_level", [
    ("order_profit.count", "count(order_profit)"), ("order_profit.mean", O.mean("order_profit", 10)),
    ("order_profit.std", "round(stddev_samp(order_profit), 8)"), ("order_profit.min", "min(order_profit)"),
    ("order_profit.max", "max(order_profit)")] + [
    (f"order_profit.p{int(p * 100)}", f"round(quantile_cont(order_profit, {p}), 8)")
    for p in [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]], "order_level")))
def eda16(spark, sf):
    return PF.describe_percentiles(pipeline(spark, sf).orders, "order_profit", "order_level")


@register("eda17_iqr_outliers", O.with_base("""
, q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM products_clean)
SELECT count_if(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS outliers,
       any_value(q1 - 1.5 * (q3 - q1)) AS lower_fence, any_value(q3 + 1.5 * (q3 - q1)) AS upper_fence, 'price' AS "column"
FROM products_clean, q"""))
def eda17(spark, sf):
    return PF.iqr_outliers(pipeline(spark, sf).products, "price")


@register("eda18_functional_dependency", O.with_base("""
SELECT vendor, count(DISTINCT coalesce(CAST(category_name AS STRING), chr(0) || 'NULL')) AS n_values
FROM products_clean GROUP BY 1 HAVING n_values > 1 ORDER BY 2 DESC, 1"""))
def eda18(spark, sf):
    return PF.functional_dependency(pipeline(spark, sf).products, "vendor", "category_name")


@register("eda21_contingency", O.with_base("""
SELECT customer_segment, region, count(*) AS count FROM buyers_clean GROUP BY 1, 2 ORDER BY 1, 2"""))
def eda21(spark, sf):
    return PF.contingency(pipeline(spark, sf).buyers, "customer_segment", "region")


@register("eda21b_contingency_margins", O.with_base("""
SELECT customer_segment, region, count(*) AS count, CAST(grouping(customer_segment, region) AS BIGINT) AS level
FROM buyers_clean GROUP BY CUBE (customer_segment, region)"""))
def eda21b(spark, sf):
    return PF.contingency(pipeline(spark, sf).buyers, "customer_segment", "region", margins=True)


@register("eda29_null_rate_by_group", O.with_base("""
SELECT state, avg(CAST(timezone IS NULL AS DOUBLE)) * 100 AS null_pct, count(*) AS rows FROM buyers_raw
GROUP BY 1 ORDER BY null_pct DESC, rows DESC, state NULLS FIRST LIMIT 20"""))
def eda29(spark, sf):
    return PF.null_rate_by(pipeline(spark, sf).buyers_raw, "timezone", "state")


@register("eda34_signup_vs_first_order", O.with_base("""
, f AS (SELECT buyer_id, min(order_datetime) AS first_order FROM sales_clean GROUP BY 1),
j AS (SELECT b.signup_date, f.first_order, datediff('day', CAST(b.signup_date AS DATE), CAST(f.first_order AS DATE)) AS d
      FROM buyers_clean b LEFT JOIN f USING (buyer_id))
SELECT count_if(signup_date IS NOT NULL AND first_order IS NOT NULL) AS both,
       count_if(signup_date IS NOT NULL AND first_order IS NULL) AS signup_only,
       count_if(signup_date IS NULL AND first_order IS NOT NULL) AS order_only,
       count_if(signup_date IS NULL AND first_order IS NULL) AS neither,
       CAST(min(d) AS INTEGER) AS min_days, CAST(max(d) AS INTEGER) AS max_days, round(avg(d), 8) AS mean_days,
       median(CAST(d AS DOUBLE)) AS median_days, count_if(d < 0) AS order_before_signup FROM j"""))
def eda34(spark, sf):
    p = pipeline(spark, sf)
    return PF.signup_vs_first_order(p.buyers, p.sales)


_EDA36 = """, n AS (SELECT trim(order_id) AS order_id, trim(buyer_id) AS buyer_id, trim(sku_id) AS sku_id, quantity,
        order_datetime, order_status, _ord FROM sales_raw),
d AS (SELECT *, count(*) OVER (PARTITION BY order_id, buyer_id, sku_id) AS copies,
             count(*) OVER (PARTITION BY order_id, buyer_id, sku_id, quantity, order_datetime, order_status) AS same FROM n)
"""


@register("eda36_duplicate_rows", O.with_base(_EDA36 + """
SELECT order_id, buyer_id, sku_id, quantity, order_datetime, order_status, _ord AS line FROM d WHERE copies > 1"""))
def eda36(spark, sf):
    return PF.duplicate_rows(_keyed_sales(spark, sf), SALES_KEY).select(
        *SALES_KEY, "quantity", "order_datetime", "order_status", F.col("_ord").alias("line"))


@register("eda36b_exact_copies", O.with_base(_EDA36 + """
SELECT count(*) AS rows, count(DISTINCT [order_id, buyer_id, sku_id]) AS keys, count_if(same > 1) AS exact_copy_rows,
       (SELECT count(*) FROM (SELECT DISTINCT order_id, buyer_id, sku_id, quantity, order_datetime, order_status
                              FROM d WHERE same > 1) p) AS exact_copy_patterns
FROM d WHERE copies > 1"""))
def eda36b(spark, sf):
    return PF.exact_copies(_keyed_sales(spark, sf), SALES_KEY, ["quantity", "order_datetime", "order_status"])


def _keyed_sales(spark, sf):
    return pipeline(spark, sf).sales_raw.withColumns({c: strip_ws(c) for c in SALES_KEY})


@register("eda48_headline_shares", O.with_base("""
SELECT avg(CAST(is_referred = 1 AS DOUBLE)) * 100 AS referred_pct, round(avg(wishlist_size), 8) AS mean_wishlist,
       count(DISTINCT customer_segment) AS segments FROM buyers_clean"""))
def eda48(spark, sf):
    return PF.headline_shares(pipeline(spark, sf).buyers)


# ------------------------------------------------------------------ EDA7, EDA15, EDA20, EDA43
def _cs5_sql() -> str:
    from orderlens.plans.queries_clean import CS5_SQL
    return CS5_SQL


@register("eda7_sales_summary", O.with_base(_long("sales", [
    ("rows", "count(*)"), ("duplicate_line_grain_count", _dups("sales_clean", "order_id, buyer_id, sku_id"))]
    + _five("quantity", "quantity_summary") + _five("quantity_original", "quantity_original_summary"), "sales_clean")
    + "\nUNION ALL SELECT 'sales', 'cleaning_audit.' || metric, value FROM (" + _cs5_sql() + ") a"))
def eda7(spark, sf):
    p = pipeline(spark, sf)
    return PF.sales_summary(p.sales, p.sales_audit)


def _year_profile_sql(year: int) -> str:
    src = f"(SELECT * FROM order_level WHERE year = {year}) y{year}"
    items = [("rows", "count(*)"), ("duplicate_order_id_count", _dups(src, "order_id")),
             ("order_profit_summary.negative_order_profit_count", "count_if(order_profit < 0)")]
    items += _five("order_profit", "order_profit_summary")
    return _long("order_level", items, src)


_DRIFT_YEAR = P.metric_years[1]


@register("eda15_drift", O.with_base(f"""
, cur AS ({_year_profile_sql(_DRIFT_YEAR)}), prev AS ({_year_profile_sql(_DRIFT_YEAR - 1)})
SELECT dataset, metric, prev.value AS previous, cur.value AS current, cur.value - prev.value AS delta,
       CASE WHEN prev.value <> 0 THEN (cur.value - prev.value) / abs(prev.value) * 100 END AS pct_change
FROM cur JOIN prev USING (dataset, metric) ORDER BY 1, 2"""))
def eda15(spark, sf):
    """Drift of the order-table profile: the latest metric year against the
    year before (the profile snapshot of the previous period)."""
    from pyspark.sql import functions as F
    o = pipeline(spark, sf).orders
    return PF.drift(PF.orders_summary(o.where(F.col("year") == _DRIFT_YEAR)),
                    PF.orders_summary(o.where(F.col("year") == _DRIFT_YEAR - 1)))


# Columns of the two runs that eda15b compares: the tables as they come in, and after cleaning.
_RUN_COLUMNS = {"buyers": ["buyer_id", "region", "state", "timezone", "signup_date", "customer_segment"],
                "sales": ["order_id", "buyer_id", "sku_id", "quantity", "order_datetime", "order_status"]}
_RUN_GRAIN = {"buyers": ["buyer_id"], "sales": ["order_id", "buyer_id", "sku_id"]}


def _run_profile_sql(name: str, table: str, quantity: str) -> str:
    keys, cols = ", ".join(_RUN_GRAIN[name]), _RUN_COLUMNS[name]
    parts = [f"SELECT '{name}' AS dataset, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM {table}",
             f"SELECT '{name}', 'duplicates', CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}) g"]
    parts += [f"SELECT '{name}', 'null_profile.{c}', CAST(count_if({c} IS NULL) AS DOUBLE) FROM {table}" for c in cols]
    if name == "sales":
        parts += [f"SELECT 'sales', 'quantity.{m}', CAST({f}({quantity}) AS DOUBLE) FROM {table}"
                  for m, f in (("count", "count"), ("min", "min"), ("max", "max"))]
        parts += [f"SELECT 'sales', 'quantity.{m}', round(quantile_cont({quantity}, {p}), 8) FROM {table}"
                  for m, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))]
    return "\nUNION ALL ".join(parts)


def run_profile(buyers, sales):
    """Long profile of one run's tables: rows, duplicate keys, NULLs, quantities."""
    from orderlens.operators.common import long_rows
    parts = []
    for name, df in (("buyers", buyers), ("sales", sales)):
        own = df.select(*_RUN_COLUMNS[name])
        # counts, NULLs and extremes of a table in one pass
        parts.append(long_rows(own, {
            "rows": F.count(F.lit(1)), "duplicates": F.first(PF.grain_duplicates(own, _RUN_GRAIN[name])), **PF.null_metrics(own),
            **(PF.extreme_metrics("quantity", "quantity") if name == "sales" else {})}, name))
    parts.append(PF.quartile_rows(sales, "quantity", "sales", "quantity"))
    return PF.union_rules(parts)


@register("eda15b_run_drift", O.with_base(f"""
, typed AS (SELECT * REPLACE ({O.num('quantity')} AS quantity) FROM s2 WHERE order_datetime IS NOT NULL),
first_run AS ({_run_profile_sql("buyers", "b1", "")}
UNION ALL {_run_profile_sql("sales", "typed", "quantity")}),
second_run AS ({_run_profile_sql("buyers", "buyers_clean", "")}
UNION ALL {_run_profile_sql("sales", "sales_clean", "quantity")})
SELECT dataset, metric, f.value AS previous, s.value AS current, s.value - f.value AS delta,
       CASE WHEN f.value <> 0 THEN (s.value - f.value) / abs(f.value) * 100 END AS pct_change
FROM first_run f JOIN second_run s USING (dataset, metric) ORDER BY 1, 2"""))
def eda15b(spark, sf):
    """Two runs through the snapshot store: the tables as they come in, then the cleaned ones;
    rows staged by a run that died in between are no version."""
    from orderlens.functions.numeric import try_num
    from orderlens.functions.timefn import SIGNUP_TS_FORMATS, parse_ts
    from orderlens.operators.clean import typed_sales
    p = pipeline(spark, sf)
    store = SnapshotStore(spark, temporary_folder(spark, "orderlens-profile"))
    raw = p.buyers_raw.withColumns({"buyer_id": strip_ws("buyer_id"), "signup_date": parse_ts("signup_date", SIGNUP_TS_FORMATS)})
    # the profile reads the sales more than once: they are joined and parsed once
    typed = typed_sales(p.sales_raw).withColumn("quantity", try_num("quantity")).select(*_RUN_COLUMNS["sales"])
    store.write(run_profile(raw, materialize_table(typed, "profile-sales")))
    previous = store.read()
    store.stage(previous.withColumn("value", F.lit(-1.0)))
    store.write(run_profile(p.buyers, p.sales))
    first, second = store.versions()
    return PF.drift(store.read(second), store.read(first))


@register("eda20_vendor_summary", O.with_base(f"""
SELECT vendor, count(*) AS rows, count(DISTINCT sku_id) AS skus, {O.mean('price', 10)} AS mean_price
FROM products_clean GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda20(spark, sf):
    return PF.group_summary(pipeline(spark, sf).products, "vendor", "price")


@register("eda20b_category_summary", O.with_base(f"""
SELECT category_name, count(*) AS rows, count(DISTINCT sku_id) AS skus, {O.mean('margin', 10)} AS mean_margin
FROM products_clean GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda20b(spark, sf):
    return PF.group_summary(pipeline(spark, sf).products, "category_name", "margin")


@register("eda43_buyer_issue_table", O.with_base("\nUNION ALL ".join(
    f"SELECT {i + 1} AS issue_no, '{label}' AS issue, CAST({expr} AS BIGINT) AS remaining_issue_rows, "
    # the clean buyers have no stored activity flag
    + (f"'{PF.NOT_COMPUTED}'" if i == 6 else f"CASE WHEN CAST({expr} AS BIGINT) = 0 THEN 'PASS' ELSE 'FAIL' END")
    + " AS status FROM buyers_clean"
    for i, (label, expr) in enumerate(zip(PF.BUYER_ISSUES, [
        "count_if(buyer_id IS NULL)",
        "max((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM buyers_clean GROUP BY buyer_id HAVING count(*) > 1) d))",
        "count_if(region IS NULL)", "count_if(timezone IS NULL)", "count_if(signup_date IS NULL)",
        "count_if(is_referred NOT IN (0, 1) AND is_referred IS NOT NULL)", "max(NULL)"])))))
def eda43(spark, sf):
    return PF.buyer_issue_table(pipeline(spark, sf).buyers)


@register("eda43b_raw_buyer_issues", O.with_base(f"""
, n AS (SELECT count(*) AS n, buyer_id FROM buyers_raw GROUP BY buyer_id),
i AS (
  SELECT 1 AS issue_no, (SELECT count(*) FROM buyers_raw WHERE buyer_id IS NULL) AS r
  UNION ALL SELECT 2, (SELECT sum(n) FROM n WHERE n > 1)
  UNION ALL SELECT 3, (SELECT count(*) - count(region) FROM buyers_raw)
  UNION ALL SELECT 4, (SELECT count(*) - count(timezone) FROM buyers_raw)
  UNION ALL SELECT 5, (SELECT count(*) - count(signup_date) FROM buyers_raw)
  UNION ALL SELECT 6, (SELECT count(*) FROM buyers_raw WHERE is_referred = '2')
  UNION ALL SELECT 7, (SELECT count(*) FROM buyers_raw WHERE CAST(is_active_buyer AS INTEGER) <> CASE customer_group WHEN 'Dormant' THEN 0 ELSE 1 END))
SELECT issue_no, {PF.BUYER_ISSUES}[issue_no] AS issue, CAST(r AS BIGINT) AS remaining_issue_rows,
       CASE WHEN issue_no = 7 THEN CASE WHEN r > 0 THEN 'PASS' ELSE '{PF.STILL_REDUNDANT}' END
            WHEN r = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM i"""))
def eda43b(spark, sf):
    return PF.buyer_issue_table(pipeline(spark, sf).buyers_raw)


# EDA14: the run's whole profile as one long table: the EDA3, EDA7, EDA8,
# EDA10, EDA11 and EDA13 tables (their SQL bodies are reused) plus the NULL
# profile of the five stage tables.  The oracle's product table lacks the
# derived flag columns the Spark table carries; ``px`` restates them from the
# raw rows (one row per sku), and the line table takes them by sku.
def _body(key: str) -> str:
    from orderlens.plans.catalog import _REGISTRY
    pre = "WITH " + O.base_ctes() + "\n"
    sql = _REGISTRY[key][1]
    assert sql.startswith(pre), key
    return sql[len(pre):]


def _flag(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('1', 'true', 'y') THEN 1 WHEN lower(trim({c})) IN ('0', 'false', 'n') THEN 0 END"


_PX = f"""px AS (SELECT upper({O.strip('sku_id')}) AS sku_id, subcategory_name, TRY_CAST(profit_margin AS DOUBLE) AS profit_margin,
  TRY_CAST(pct_profit_margin AS DOUBLE) AS pct_profit_margin, _ord,
  {_flag('active_product')} AS active_product_num, {_flag('currently_active_vendor')} AS currently_active_vendor_num,
  TRY_CAST(current_stock AS DOUBLE) AS current_stock_num,
  CAST(coalesce({_flag('active_product')} = 1 AND {_flag('currently_active_vendor')} = 0, false) AS INTEGER) AS vendor_product_conflict,
  coalesce({_flag('active_product')} = 0 AND TRY_CAST(current_stock AS DOUBLE) > 0, false) AS inactive_with_stock_flag
  FROM products_raw)"""
_PX_COLS = ["subcategory_name", "profit_margin", "pct_profit_margin", "active_product_num", "currently_active_vendor_num", "current_stock_num",
            "vendor_product_conflict", "inactive_with_stock_flag"]
_NULL_PROFILES = [
    ("buyers", "buyers_clean", ["buyer_id", "state", "customer_group", "customer_segment", "preferred_channel", "signup_date",
                                "region", "timezone", "is_referred", "wishlist_size", "_ord", "is_referred_invalid"]),
    ("sales", "sales_clean", ["order_id", "buyer_id", "sku_id", "quantity", "order_datetime", "order_status", "_ord",
                              "quantity_cap_value", "quantity_original", "quantity_was_capped"]),
    ("products", "products_clean", ["subcategory_id", "category_name", "vendor", "product_num", "sku_id", "price",
                                    "active_product", "currently_active_vendor", "current_stock", "margin", "margin_imputed"]),
    ("products", "px", _PX_COLS + ["_ord"]),
    ("final_line", "line_fact", ["sku_id", "buyer_id", "order_id", "quantity", "order_datetime", "order_status",
                                 "quantity_cap_value", "quantity_original", "quantity_was_capped", "state", "customer_group",
                                 "customer_segment", "preferred_channel", "signup_date", "region", "timezone", "is_referred",
                                 "wishlist_size", "is_referred_invalid", "subcategory_id", "category_name", "vendor",
                                 "product_num", "price", "active_product", "currently_active_vendor", "current_stock",
                                 "margin", "margin_imputed"]),
    ("final_line", "(SELECT px.* FROM line_fact JOIN px USING (sku_id)) lpx", _PX_COLS),
    ("order_level", "order_level", ORDER_COLUMNS),
]


def _eda14_sql() -> str:
    parts = [f"SELECT * FROM ({_body(k)}) t{i}" for i, k in enumerate(
        ["eda3_buyers_summary", "eda7_sales_summary", "eda10_products_summary", "eda8_numeric_bounds",
         "eda11_line_summary", "eda13_orders_summary"])]
    parts += [_long(ds, [(f"null_profile.{c}", f"count_if({c} IS NULL)") for c in cols], src)
              for ds, src, cols in _NULL_PROFILES]
    return O.with_base(", " + _PX + "\n" + "\nUNION ALL ".join(parts))


@register("eda14_profile_summary", _eda14_sql())
def eda14(spark, sf):
    p = pipeline(spark, sf)
    return PF.eda_summary(p.buyers, p.sales, p.sales_audit, p.products, p.lines, p.orders)
