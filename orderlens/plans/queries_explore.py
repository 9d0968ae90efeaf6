"""Catalog entries: further exploration tables (EDA19-EDA47) and Q4e."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import derived as D, profile as PF
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.sources.files import SALES_COLUMNS

# Fixed checks of the products issue table: (predicate, severity), and the fields that must not be missing.
PRODUCT_ISSUES = {
    "missing_margin_before_imputation": ("margin IS NULL OR margin_imputed", "MEDIUM"),
    "negative_margin": ("margin < 0", "MEDIUM"),
    "vendor_product_conflict": ("vendor_product_conflict = 1", "LOW"),
    "inactive_with_stock": ("inactive_with_stock_flag", "LOW"),
}
PRODUCT_FIELDS = {"product_num": "HIGH", "vendor": "MEDIUM", "category_id": "MEDIUM", "subcategory_id": "MEDIUM", "price": "HIGH"}

# The catalogue of this table has lost some cells and repeats some numbers.
CATALOGUE_LOSSES = {
    "price": "CASE WHEN price > 0 AND length(sku_id) % 3 = 0 AND margin > 0.55 THEN NULL ELSE price END",
    "vendor": "CASE WHEN margin BETWEEN 0.31 AND 0.325 THEN NULL ELSE vendor END",
    "product_num": "CASE WHEN margin BETWEEN 0.41 AND 0.425 THEN NULL WHEN margin BETWEEN 0.45 AND 0.465 THEN 'N' || vendor ELSE product_num END",
}


@register("eda19_issue_table", O.with_base(f"""
, flags AS (SELECT *, lower(trim(active_product)) AS a, lower(trim(currently_active_vendor)) AS v FROM products_clean),
pc AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in CATALOGUE_LOSSES.items())}) FROM flags),
i AS (
  SELECT 'Missing product_num' AS issue, count(*) - count(product_num) AS rows, 'HIGH' AS severity FROM pc
  UNION ALL SELECT 'Missing vendor', count(*) - count(vendor), 'MEDIUM' FROM pc
  UNION ALL SELECT 'Missing subcategory_id', count(*) - count(subcategory_id), 'MEDIUM' FROM pc
  UNION ALL SELECT 'Missing price', count(*) - count(price), 'HIGH' FROM pc
  UNION ALL SELECT 'Duplicate product_num rows', count(*), 'HIGH' FROM (SELECT count(*) OVER (PARTITION BY product_num) AS n FROM pc) WHERE n > 1
  UNION ALL SELECT 'missing_margin_before_imputation', count_if(margin IS NULL OR margin_imputed), 'MEDIUM' FROM pc
  UNION ALL SELECT 'negative_margin', count(*), 'MEDIUM' FROM pc WHERE margin < 0
  UNION ALL SELECT 'vendor_product_conflict', count(*), 'LOW' FROM pc WHERE a IN ('1', 'true', 'y') AND v IN ('0', 'false', 'n')
  UNION ALL SELECT 'inactive_with_stock', count(*), 'LOW' FROM pc WHERE a IN ('0', 'false', 'n') AND TRY_CAST(current_stock AS DOUBLE) > 0)
SELECT issue, rows, round(rows / (SELECT count(*) FROM pc) * 100, 2) AS pct, severity, CASE WHEN rows > 0 THEN 'CHECK' ELSE 'OK' END AS status
FROM i ORDER BY status, rows DESC, issue"""))
def eda19(spark, sf):
    p = pipeline(spark, sf).products
    return PF.product_issue_table(p.withColumns({c: F.expr(e) for c, e in CATALOGUE_LOSSES.items()}), PRODUCT_ISSUES, PRODUCT_FIELDS)


@register("eda24_margin_breakdown", O.with_base("""
SELECT vendor, count(*) AS rows, count_if(TRY_CAST(margin AS DOUBLE) IS NULL) AS nulls,
       """ + O.mean("TRY_CAST(margin AS DOUBLE)", 10) + """ AS mean, round(median(TRY_CAST(margin AS DOUBLE)), 8) AS median
FROM products_clean WHERE regexp_matches(category_name, '(?i)promo') GROUP BY 1 ORDER BY 1"""))
def eda24(spark, sf):
    return PF.breakdown(pipeline(spark, sf).products, "vendor", "margin", "promo", on="category_name")


@register("eda28_predictive_spread", O.with_base("""
SELECT round(stddev_samp(m), 8) AS std_of_group_means, count(*) AS groups FROM (
  SELECT customer_segment, """ + O.mean("TRY_CAST(order_profit AS DOUBLE)", 10) + """ AS m FROM order_level GROUP BY 1) g"""))
def eda28(spark, sf):
    return PF.predictive_spread(pipeline(spark, sf).orders, "customer_segment", "order_profit")


@register("eda31_slice_vs_all", O.with_base("""
, g AS (SELECT customer_segment AS value, count(*) AS n, count_if(is_referred_invalid) AS n_slice FROM buyers_clean GROUP BY 1)
SELECT value, n, n_slice, n / sum(n) OVER () * 100 AS pct_all, n_slice / sum(n_slice) OVER () * 100 AS pct_slice,
       n_slice / sum(n_slice) OVER () * 100 - n / sum(n) OVER () * 100 AS skew_points FROM g ORDER BY value"""))
def eda31(spark, sf):
    return PF.slice_vs_all(pipeline(spark, sf).buyers, "is_referred_invalid", "customer_segment")


def _repeats(name: str, keys: str, where: str = "c > 1", rows: str = "count(*)") -> str:
    """Rows and groups of ``keys`` in s2 (typed rows before de-duplication) by window counts."""
    return f"""SELECT '{name}' AS scenario, CAST({rows} AS BIGINT) AS rows, count(DISTINCT k) AS groups FROM (
  SELECT *, [{keys}] AS k, count(*) OVER (PARTITION BY {keys}) AS c, count(*) OVER (PARTITION BY order_id, buyer_id, sku_id,
         quantity, order_datetime, order_status) AS same,
         count(DISTINCT [buyer_id, quantity, order_status]) OVER (PARTITION BY {keys}) AS versions
  FROM (SELECT * REPLACE (CAST(order_datetime AS VARCHAR) AS order_datetime) FROM s2 WHERE order_datetime IS NOT NULL) t) u WHERE {where}"""


_LOOSE = "order_id, sku_id, order_datetime"


@register("eda38_duplicate_scenarios", O.with_base("\n".join([
    ",", "rep AS (", _repeats("duplicate_order_id", "order_id"), "UNION ALL",
    _repeats("duplicate_strict_key", "order_id, buyer_id, sku_id, order_datetime"), "UNION ALL",
    _repeats("A_full_copies", _LOOSE, "c > 1 AND same > 1"), "UNION ALL",
    _repeats("B_differing_rows", _LOOSE, "c > 1 AND versions > 1"), ")", "SELECT * FROM rep ORDER BY scenario"])))
def eda38(spark, sf):
    from orderlens.operators.clean import typed_sales
    rows = typed_sales(pipeline(spark, sf).sales_raw)
    return PF.duplicate_scenarios(rows, "order_id", ["order_id", "buyer_id", "sku_id", "order_datetime"],
                                  ["order_id", "sku_id", "order_datetime"])


@register("eda41_sales_totals", O.with_base("""
SELECT *, rows / orders AS items_per_order FROM (
  SELECT count(*) AS rows, count(DISTINCT order_id) AS orders, count(DISTINCT buyer_id) AS buyers,
         count(DISTINCT sku_id) AS skus, CAST(sum(CAST(quantity AS DECIMAL(20,6))) AS DOUBLE) AS total_quantity
  FROM sales_clean) t"""))
def eda41(spark, sf):
    return PF.sales_totals(pipeline(spark, sf).sales)


@register("eda44_date_stats", O.with_base("""
SELECT customer_segment, min(signup_date) AS min_date, max(signup_date) AS max_date,
       make_timestamp(CAST(sum(CAST(epoch(signup_date) AS BIGINT)) // count(signup_date) AS BIGINT) * 1000000) AS mean_date,
       count(signup_date) AS n, CAST(floor(epoch(max(signup_date) - min(signup_date)) / 86400) AS BIGINT) AS span_days
FROM buyers_clean GROUP BY 1 ORDER BY 1"""))
def eda44(spark, sf):
    return PF.date_stats_by(pipeline(spark, sf).buyers, "customer_segment", "signup_date")


@register("eda44b_date_overview", O.with_base("""
SELECT count(*) AS rows, count_if(signup_date IS NULL) AS nulls, count_if(signup_date IS NULL) / count(*) * 100 AS null_pct,
       min(signup_date) AS min_date, max(signup_date) AS max_date,
       CAST(floor(epoch(max(signup_date) - min(signup_date)) / 86400) AS BIGINT) AS span_days FROM b1"""))
def eda44b(spark, sf):
    from orderlens.functions.timefn import SIGNUP_TS_FORMATS, parse_ts
    return PF.date_overview(pipeline(spark, sf).buyers_raw.withColumn("signup_date", parse_ts("signup_date", SIGNUP_TS_FORMATS)), "signup_date")


@register("eda46c_signup_fill", O.with_base("""
SELECT count_if(signup_date IS NULL) AS nulls_before,
       count_if(signup_date IS NULL AND buyer_id IN (SELECT buyer_id FROM sales_clean)) AS fillable,
       count_if(signup_date IS NULL AND (buyer_id IS NULL OR buyer_id NOT IN (SELECT buyer_id FROM sales_clean))) AS not_fillable,
       count_if(signup_date IS NULL AND (buyer_id IS NULL OR buyer_id NOT IN (SELECT buyer_id FROM sales_clean))) AS nulls_after FROM b1"""))
def eda46c(spark, sf):
    from orderlens.functions.text import strip_ws
    from orderlens.functions.timefn import SIGNUP_TS_FORMATS, parse_ts
    p = pipeline(spark, sf)
    raw = p.buyers_raw.withColumns({"buyer_id": strip_ws("buyer_id"), "signup_date": parse_ts("signup_date", SIGNUP_TS_FORMATS)})
    return PF.signup_fill_audit(raw, p.sales)


@register("eda46_imputation_audit", O.with_base("""
, m AS (SELECT state, timezone AS _m FROM (SELECT state, timezone, count(*) AS c FROM b1
        WHERE state IS NOT NULL AND timezone IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY state ORDER BY c DESC, timezone) = 1)
SELECT count_if(timezone IS NULL) AS nulls_before, count_if(timezone IS NULL AND _m IS NOT NULL) AS fillable,
       count_if(timezone IS NULL AND _m IS NULL) AS not_fillable, count_if(coalesce(timezone, _m) IS NULL) AS nulls_after
FROM b1 LEFT JOIN m USING (state)"""))
def eda46(spark, sf):
    from orderlens.functions.text import strip_ws
    raw = pipeline(spark, sf).buyers_raw.withColumn("buyer_id", strip_ws("buyer_id"))
    return PF.imputation_audit(raw, "timezone", "state")


@register("eda47_region_states", O.with_base("""
, ps AS (SELECT state, count(DISTINCT region) AS regions FROM buyers_clean WHERE state IS NOT NULL GROUP BY 1),
zc AS (SELECT region, timezone, count(*) AS c FROM buyers_clean WHERE region IS NOT NULL AND timezone IS NOT NULL GROUP BY ALL),
zm AS (SELECT region, timezone AS modal_timezone FROM zc QUALIFY row_number() OVER (PARTITION BY region ORDER BY c DESC, timezone) = 1)
SELECT b.region, list_sort(list(DISTINCT b.state)) AS states, count(DISTINCT b.state) AS n_states, any_value(zm.modal_timezone) AS modal_timezone,
       bool_and(ps.regions = 1) AS states_exclusive
FROM buyers_clean b LEFT JOIN ps USING (state) LEFT JOIN zm USING (region) WHERE b.region IS NOT NULL GROUP BY b.region ORDER BY 1"""))
def eda47(spark, sf):
    return PF.region_states(pipeline(spark, sf).buyers)


@register("q4e_peak_day_revenue_impact", O.with_base(f"""
, g AS (SELECT year, customer_segment,
               sum(CASE WHEN is_black_friday THEN CAST(order_base_revenue AS DECIMAL(20,6)) END) AS _b,
               sum(CASE WHEN is_black_friday THEN CAST(order_net_revenue_before_shipping AS DECIMAL(20,6)) END) AS _n,
               sum(CAST(order_net_revenue_before_shipping AS DECIMAL(20,6))) AS _a FROM ow GROUP BY 1, 2)
SELECT year, customer_segment, coalesce(CAST(_b AS DOUBLE), 0.0) AS bf_base_revenue, coalesce(CAST(_n AS DOUBLE), 0.0) AS bf_net_revenue,
       coalesce(CAST(_b - _n AS DOUBLE), 0.0) AS discount_impact,
       {O.ratio('coalesce(CAST(_n AS DOUBLE), 0.0)', 'CAST(_a AS DOUBLE)')} * 100 AS pct_of_annual FROM g ORDER BY 1, 2"""))
def q4e(spark, sf):
    return D.peak_day_revenue_impact(pipeline(spark, sf).orders, P)


@register("eda22_non_numeric_values", O.with_base("""
SELECT price AS value, count(*) AS count FROM products_raw WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL
GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda22(spark, sf):
    return PF.non_numeric_values(pipeline(spark, sf).products_raw, "price")


@register("eda23_margin_consistency", O.with_base("""
, d AS (SELECT abs(TRY_CAST(pct_profit_margin AS DOUBLE) - TRY_CAST(profit_margin AS DOUBLE) * 100) AS d FROM products_raw)
SELECT max(d) AS max_abs_diff, round(avg(d), 8) AS mean_abs_diff, count_if(d < 0.001) AS matches, count(d) AS compared FROM d"""))
def eda23(spark, sf):
    return PF.margin_consistency(pipeline(spark, sf).products_raw)


@register("eda25_top_by_stock", O.with_base("""
SELECT sku_id, TRY_CAST(current_stock AS DOUBLE) AS stock FROM products_clean
WHERE NOT coalesce(lower(trim(active_product)) IN ('1', 'true', 'y'), false)
ORDER BY stock DESC NULLS LAST, sku_id LIMIT 20"""))
def eda25(spark, sf):
    d = PF.top_by(pipeline(spark, sf).products.where(~F.coalesce(F.col("active_product_num") == 1, F.lit(False))),
                  "current_stock", 20, tie="sku_id")
    return d.select("sku_id", F.col("current_stock").try_cast("double").alias("stock"))


@register("eda26_price_histogram", O.with_base("""
, mm AS (SELECT min(price) AS lo, max(price) AS hi FROM products_clean)
SELECT CAST(least(CASE WHEN price < lo THEN 0 WHEN price >= hi + 1e-9 THEN 51
                       ELSE floor((price - lo) / (hi + 1e-9 - lo) * 50) + 1 END, 50) AS BIGINT) AS bin, count(*) AS count
FROM products_clean, mm WHERE price IS NOT NULL GROUP BY 1 ORDER BY 1"""))
def eda26(spark, sf):
    return PF.histogram(pipeline(spark, sf).products, "price", 50)


@register("eda27_flag_redundancy", O.with_base("""
, f AS (SELECT CAST(is_active_buyer AS INTEGER) = CAST(coalesce(buyer_id, chr(1)) IN (SELECT coalesce(buyer_id, chr(1)) FROM sales_raw) AS INTEGER) AS eq
        FROM buyers_raw)
SELECT avg(CAST(coalesce(eq, false) AS DOUBLE)) * 100 AS match_pct, count_if(NOT coalesce(eq, false)) AS mismatches FROM f"""))
def eda27(spark, sf):
    p = pipeline(spark, sf)
    # a missing id on both sides counts as present
    present = p.sales_raw.select(F.col("buyer_id").alias("_id")).distinct().withColumn("_seen", F.lit(1))
    return PF.flag_redundancy(p.buyers_raw.join(present, F.col("buyer_id").eqNullSafe(F.col("_id")), "left"),
                              "is_active_buyer", F.coalesce("_seen", F.lit(0)))


@register("eda30_co_nulls", O.with_base("\nUNION ALL ".join(
    f"SELECT 'null_region' AS dataset, 'null_profile.{c}' AS metric, CAST(count_if({c} IS NULL) AS DOUBLE) AS value "
    f"FROM buyers_raw WHERE region IS NULL" for c in
    ["buyer_id", "customer_group", "customer_segment", "preferred_channel", "signup_date", "region", "state",
     "timezone", "is_referred", "wishlist_size", "is_active_buyer", "_ord"])))
def eda30(spark, sf):
    return PF.co_nulls(pipeline(spark, sf).buyers_raw, "region")


@register("eda32_multi_valued_keys", O.with_base("""
SELECT buyer_id, count(DISTINCT region) AS n_region, count(DISTINCT state) AS n_state, count(DISTINCT timezone) AS n_timezone
FROM b1 GROUP BY 1 HAVING count(DISTINCT region) > 1 OR count(DISTINCT state) > 1 OR count(DISTINCT timezone) > 1 ORDER BY 1"""))
def eda32(spark, sf):
    from orderlens.functions.text import strip_ws
    raw = pipeline(spark, sf).buyers_raw.withColumn("buyer_id", strip_ws("buyer_id"))
    return PF.multi_valued_keys(raw, "buyer_id", ["region", "state", "timezone"])


@register("eda33_dependency_profile", O.with_base("""
, c AS (SELECT state, timezone, count(*) AS m FROM buyers_raw WHERE timezone IS NOT NULL GROUP BY ALL),
mc AS (SELECT state, timezone AS most_common, m FROM c QUALIFY row_number() OVER (PARTITION BY state ORDER BY m DESC, timezone) = 1),
g AS (SELECT state, coalesce(list_sort(list(DISTINCT timezone) FILTER (WHERE timezone IS NOT NULL)), []::VARCHAR[]) AS vals,
             count(timezone) AS n FROM buyers_raw GROUP BY state)
SELECT g.state, vals AS "values", len(vals) = 1 AS single_valued, mc.most_common,
       CASE WHEN g.state IS NOT NULL AND n > 0 THEN mc.m / n * 100 END AS most_common_pct
FROM g LEFT JOIN mc ON g.state IS NOT DISTINCT FROM mc.state ORDER BY 1"""))
def eda33(spark, sf):
    return PF.dependency_profile(pipeline(spark, sf).buyers_raw, "state", "timezone")


# Features that the slice without a signup date is compared on.
_FEATURES = ["customer_group", "preferred_channel", "region", "is_referred"]
_BUYER_RAW = ["buyer_id", "customer_group", "customer_segment", "preferred_channel", "signup_date", "region", "state", "timezone",
              "is_referred", "wishlist_size", "is_active_buyer"]


@register("eda35_modal_in_null_slice", O.with_base("\n" + ", m AS (" + "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, sl, value FROM (SELECT signup_date IS NULL AS sl, CAST({c} AS VARCHAR) AS value, count(*) AS n
  FROM buyers_raw WHERE {c} IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY sl ORDER BY n DESC, value) = 1"""
    for c in _FEATURES) + """)
SELECT feature, max(value) FILTER (sl) AS mode_null_slice, max(value) FILTER (NOT sl) AS mode_valid_slice,
       CASE WHEN max(value) FILTER (sl) IS NOT DISTINCT FROM max(value) FILTER (NOT sl) THEN 'Same' ELSE 'DIFFERENT' END AS verdict
FROM m GROUP BY 1 ORDER BY 1"""))
def eda35(spark, sf):
    return PF.modal_in_null_slice(pipeline(spark, sf).buyers_raw, "signup_date", _FEATURES)


@register("eda35b_slice_quality", O.with_base(f"""
, s AS (SELECT count(*) * {len(_BUYER_RAW)} AS cells, {' + '.join(f'count({c})' for c in _BUYER_RAW)} AS valid_cells
        FROM buyers_raw WHERE signup_date IS NULL)
SELECT cells, valid_cells, cells - valid_cells AS null_cells, valid_cells / cells * 100 AS quality_score_pct FROM s"""))
def eda35b(spark, sf):
    return PF.slice_quality(pipeline(spark, sf).buyers_raw.select(*_BUYER_RAW), "signup_date")


@register("eda37_duplicate_diff", O.with_base("""
, d AS (SELECT * FROM sales_raw WHERE order_id IN (SELECT order_id FROM sales_raw GROUP BY 1 HAVING count(*) > 1)),
per AS (SELECT 'sku_id' AS "column", order_id, count(DISTINCT coalesce(CAST(sku_id AS STRING), chr(0) || 'NULL')) AS n FROM d GROUP BY order_id
        UNION ALL SELECT 'quantity', order_id, count(DISTINCT coalesce(CAST(quantity AS STRING), chr(0) || 'NULL')) FROM d GROUP BY order_id
        UNION ALL SELECT 'buyer_id', order_id, count(DISTINCT coalesce(CAST(buyer_id AS STRING), chr(0) || 'NULL')) FROM d GROUP BY order_id)
SELECT "column", count(*) AS keys_with_difference FROM per WHERE n > 1 GROUP BY 1 ORDER BY 2 DESC, 1"""))
def eda37(spark, sf):
    return PF.duplicate_diff(pipeline(spark, sf).sales_raw.select("order_id", "sku_id", "quantity", "buyer_id"), "order_id")


# One vendor's part of the catalogue: its name is the same everywhere, and so may be other columns.
_ONE_VENDOR = "vendor = 'Brand#7' AND coalesce(margin, 0) < 0"


def _columns_sql(table: str, cols: dict[str, str], where: str = "true") -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count_if({e} IS NULL) AS nulls, count(DISTINCT {e}) AS distinct_values,
       CAST(min({e}) AS VARCHAR) AS min_value, CAST(max({e}) AS VARCHAR) AS max_value FROM {table} WHERE {where}""" for c, e in cols.items())


_PRODUCT_CELLS = {c: c for c in ("sku_id", "subcategory_id", "vendor", "product_num", "category_name", "price", "margin",
                                 "margin_imputed", "active_product", "currently_active_vendor", "current_stock")}


@register("eda39_constant_columns", O.with_base(
    f"""SELECT "column", distinct_values FROM ({_columns_sql("products_clean", _PRODUCT_CELLS, _ONE_VENDOR)}) t WHERE distinct_values <= 1"""))
def eda39(spark, sf):
    return PF.constant_columns(pipeline(spark, sf).products.where(_ONE_VENDOR).select(*_PRODUCT_CELLS))


@register("eda40_whitespace_audit", O.with_base("\nUNION ALL ".join(
    f"SELECT 'whitespace' AS dataset, 'padded.{c}' AS metric, CAST(count_if(length({c}) <> length(trim({c}))) AS DOUBLE) AS value FROM sales_raw"
    for c in SALES_COLUMNS)))
def eda40(spark, sf):
    return PF.whitespace_audit(pipeline(spark, sf).sales_raw, SALES_COLUMNS)


# Columns of the profiled slice of buyers.
_SLICE = ["customer_group", "customer_segment", "preferred_channel", "region", "state", "timezone", "wishlist_size"]


@register("eda42_suspicious_buyers", O.with_base("""
, o AS (SELECT buyer_id, count(DISTINCT order_id) AS orders FROM sales_clean GROUP BY 1),
s AS (SELECT DISTINCT buyer_id FROM (SELECT buyer_id, try_strptime(""" + O.strip("signup_date") + """, '%m/%d/%y %H:%M') AS sd, customer_group
                                     FROM buyers_raw) r
      WHERE sd IS NULL AND customer_group IN ('Regular', 'Occasional', 'Frequent', 'VIP'))
SELECT o.orders IS NOT NULL AS has_sales, count(*) AS buyers, coalesce(sum(o.orders), 0) AS orders, round(avg(o.orders), 8) AS mean_orders
FROM s LEFT JOIN o USING (buyer_id) GROUP BY 1 ORDER BY 1"""))
def eda42(spark, sf):
    from orderlens.functions.timefn import SIGNUP_TS_FORMATS, parse_ts
    p = pipeline(spark, sf)
    raw = p.buyers_raw.withColumn("signup_date", parse_ts("signup_date", SIGNUP_TS_FORMATS))
    return PF.suspicious_buyers(raw, p.sales)


@register("eda45_slice_profile", O.with_base("\nUNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS "column", value, count, round(count / sum(count) OVER () * 100, 4) AS pct,
       CAST(row_number() OVER (ORDER BY count DESC, value ASC NULLS LAST) AS INTEGER) AS rank
FROM (SELECT CAST({c} AS STRING) AS value, count(*) AS count FROM buyers_clean WHERE is_referred_invalid GROUP BY 1) g
QUALIFY rank <= 5) t{i}""" for i, c in enumerate(_SLICE))))
def eda45(spark, sf):
    return PF.slice_profile(pipeline(spark, sf).buyers, "is_referred_invalid", _SLICE)
