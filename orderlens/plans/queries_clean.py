"""Catalog entries: cleaning-layer tables, line fact and join diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import clean as C
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register

SALES_COLS = ["order_id", "buyer_id", "sku_id", "order_status", "order_datetime", "quantity", "quantity_original",
              "quantity_was_capped", "quantity_cap_value"]
PRODUCT_COLS = ["sku_id", "subcategory_id", "vendor", "product_num", "category_name", "price", "margin", "margin_imputed"]
BUYER_COLS = ["buyer_id", "customer_group", "customer_segment", "state", "region", "timezone", "signup_date",
              "is_referred", "is_referred_invalid", "wishlist_size"]
LINE_COLS = ["order_id", "buyer_id", "sku_id", "order_datetime", "quantity", "customer_segment", "state", "region",
             "timezone", "price", "margin"]


def _sel(cols):
    return ", ".join(cols)


@register("cs11_sales_clean", O.with_base(f"SELECT {_sel(SALES_COLS)} FROM sales_clean"))
def cs11(spark, sf):
    return pipeline(spark, sf).sales.select(*SALES_COLS)


CS5_SQL = """
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'datetime_strict_parsed_count' AS metric, count_if(_ts_branch = 0) AS value FROM s2
  UNION ALL SELECT 'datetime_fallback_parsed_count', count_if(_ts_branch > 0) FROM s2
  UNION ALL SELECT 'datetime_unparsed_dropped_count', count_if(_ts_branch IS NULL) FROM s2
  UNION ALL SELECT 'invalid_quantity_dropped_count', count_if(quantity IS NULL OR quantity <= 0) FROM s3
  UNION ALL SELECT 'quantity_cap_value', max(quantity_cap_value) FROM sales_clean
  UNION ALL SELECT 'quantity_capped_row_count', count_if(quantity_was_capped) FROM sales_clean) t"""


@register("cs5_sales_audit", O.with_base(CS5_SQL))
def cs5(spark, sf):
    return pipeline(spark, sf).sales_audit


@register("cp12_products_clean", O.with_base(f"SELECT {_sel(PRODUCT_COLS)} FROM products_clean"))
def cp12(spark, sf):
    return pipeline(spark, sf).products.select(*PRODUCT_COLS)


@register("cp7_cp8_product_flags", O.with_base("""
SELECT sku_id, active_flag AS active_product_num, vendor_flag AS currently_active_vendor_num,
       CAST(coalesce(active_flag = 1 AND vendor_flag = 0, false) AS INTEGER) AS vendor_product_conflict,
       coalesce(active_flag = 0 AND TRY_CAST(current_stock AS DOUBLE) > 0, false) AS inactive_with_stock_flag,
       coalesce(margin < 0, false) AS is_loss_product
FROM (SELECT *, CASE WHEN lower(trim(active_product)) IN ('1', 'true', 'y') THEN 1
                     WHEN lower(trim(active_product)) IN ('0', 'false', 'n') THEN 0 END AS active_flag,
                CASE WHEN lower(trim(currently_active_vendor)) IN ('1', 'true', 'y') THEN 1
                     WHEN lower(trim(currently_active_vendor)) IN ('0', 'false', 'n') THEN 0 END AS vendor_flag
      FROM products_clean) t"""))
def cp7(spark, sf):
    d = C.loss_products(pipeline(spark, sf).products)
    return d.select("sku_id", "active_product_num", "currently_active_vendor_num", "vendor_product_conflict",
                    "inactive_with_stock_flag", "is_loss_product")


@register("cb11_buyers_clean", O.with_base(f"SELECT {_sel(BUYER_COLS)} FROM buyers_clean"))
def cb11(spark, sf):
    return pipeline(spark, sf).buyers.select(*BUYER_COLS)


@register("cb9_dormant_reclassify", O.with_base("""
, bf AS (SELECT b2.* FROM b2 QUALIFY row_number() OVER (PARTITION BY buyer_id ORDER BY _ord) = 1)
SELECT buyer_id, CASE WHEN signup_date IS NULL AND buyer_id NOT IN (SELECT buyer_id FROM sales_clean)
                       AND customer_group IN ('Regular', 'Occasional', 'Frequent', 'VIP') THEN 'Dormant'
                      ELSE customer_group END AS customer_group FROM bf"""))
def cb9(spark, sf):
    p = pipeline(spark, sf)
    # buyers before the coverage filter, first record per id
    from orderlens.functions.text import strip_ws
    from orderlens.functions.timefn import SIGNUP_TS_FORMATS, parse_ts
    from orderlens.operators.common import dedup_first
    raw = p.buyers_raw.withColumns({"buyer_id": strip_ws("buyer_id"),
                                    "signup_date": parse_ts("signup_date", SIGNUP_TS_FORMATS)})
    raw = dedup_first(C.impute_mode(raw, ["timezone", "region"], "state").where(F.col("buyer_id").isNotNull()),
                      ["buyer_id"], ["_ord"])
    return C.reclassify_dormant(raw, p.sales).select("buyer_id", "customer_group")


@register("j2_line_fact", O.with_base(f"SELECT {_sel(LINE_COLS)} FROM line_fact"))
def j2(spark, sf):
    return pipeline(spark, sf).lines.select(*LINE_COLS)


@register("j8_missing_sales_ids", O.with_base("""
SELECT DISTINCT trim(buyer_id) AS buyer_id FROM sales_clean WHERE buyer_id IS NOT NULL
  AND trim(buyer_id) NOT IN (SELECT trim(buyer_id) FROM line_fact WHERE buyer_id IS NOT NULL)"""))
def j8(spark, sf):
    from orderlens.operators.quality import missing_ids
    p = pipeline(spark, sf)
    return missing_ids(p.sales, p.lines)


@register("j11_key_overlap", O.with_base("""
, a AS (SELECT DISTINCT buyer_id AS k FROM sales_clean WHERE buyer_id IS NOT NULL),
b AS (SELECT DISTINCT buyer_id AS k FROM buyers_raw WHERE buyer_id IS NOT NULL)
SELECT count_if(a.k IS NOT NULL AND b.k IS NOT NULL) AS both, count_if(b.k IS NULL) AS left_only,
       count_if(a.k IS NULL) AS right_only FROM a FULL OUTER JOIN b USING (k)"""))
def j11(spark, sf):
    from orderlens.operators.joins import key_overlap
    p = pipeline(spark, sf)
    return key_overlap(p.sales, p.buyers_raw, "buyer_id")


def _canon_ctes(col: str, threshold: float = 0.92) -> str:
    """One token after the other by rank: the first leader that is similar enough, else a leader of its own."""
    return f"""raw_{col} AS (SELECT DISTINCT {col} AS raw, upper(regexp_replace({col}, '\\s+', '', 'g')) AS token FROM products_raw WHERE {col} IS NOT NULL),
ranked_{col} AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS rank
  FROM (SELECT upper(regexp_replace({col}, '\\s+', '', 'g')) AS token FROM products_raw WHERE {col} IS NOT NULL) t GROUP BY 1),
walk_{col} AS (
  SELECT CAST(0 AS BIGINT) AS rank, CAST([] AS VARCHAR[]) AS leaders, CAST(NULL AS VARCHAR) AS token, CAST(NULL AS VARCHAR) AS leader
  UNION ALL
  SELECT rank, CASE WHEN found IS NULL THEN list_append(leaders, token) ELSE leaders END, token, coalesce(found, token)
  FROM (SELECT r.rank, w.leaders, r.token, list_filter(w.leaders, lambda l:
          1.0 - levenshtein(l, r.token) / greatest(length(l), length(r.token), 1) >= {threshold})[1] AS found
        FROM walk_{col} w JOIN ranked_{col} r ON r.rank = w.rank + 1) s),
map_{col} AS (SELECT raw, token, leader AS canonical FROM raw_{col} JOIN walk_{col} USING (token))"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("cp11_canonical_map", _recursive(O.with_base(f", {_canon_ctes('subcategory_name')}\nSELECT raw, token, canonical FROM map_subcategory_name")))
def cp11(spark, sf):
    from orderlens.operators.canon import canonical_map
    return canonical_map(pipeline(spark, sf).products_raw, "subcategory_name")


_CANON = ["vendor", "category_name", "subcategory_name"]


@register("cp11_canonicalise_report", _recursive(O.with_base(
    ", " + ",\n".join(_canon_ctes(c) for c in _CANON) + "\n" + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT coalesce({c}, chr(1))) FROM products_raw) AS before_unique,
       (SELECT count(DISTINCT coalesce(canonical, chr(1))) FROM products_raw LEFT JOIN map_{c} ON raw = {c}) AS after_unique""" for c in _CANON))))
def cp11r(spark, sf):
    from orderlens.operators.canon import canonicalise
    _, rep = canonicalise(pipeline(spark, sf).products_raw, _CANON)
    return rep


@register("cp10_loss_products", O.with_base("""
SELECT coalesce(margin < 0, false) AS is_loss_product, count(*) AS products FROM products_clean GROUP BY 1 ORDER BY 1"""))
def cp10(spark, sf):
    return (C.loss_products(pipeline(spark, sf).products).groupBy("is_loss_product")
             .agg(F.count(F.lit(1)).alias("products")).orderBy("is_loss_product"))


@register("cb10_exact_duplicates", O.with_base("""
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (_ord) FROM buyers_raw) d) AS rows_after
FROM buyers_raw"""))
def cb10(spark, sf):
    raw = pipeline(spark, sf).buyers_raw
    after = C.drop_exact_duplicates(raw).agg(F.count(F.lit(1))).scalar()
    return raw.agg(F.count(F.lit(1)).alias("rows_before"), F.first(after).alias("rows_after"))


# A catalogue without a key column: some parts are missing.
_NO_VENDOR = "CASE WHEN length(category_name) % 4 = 1 THEN NULL ELSE vendor END"


@register("cp9_composed_keys", O.with_base(f"""
SELECT product_num, upper({O.squeeze('subcategory_id')} || '-' || {O.squeeze('vendor')} || '-' || {O.squeeze('product_num')}) AS sku_id
FROM (SELECT * REPLACE ({_NO_VENDOR} AS vendor) FROM products_raw)"""))
def cp9(spark, sf):
    p = pipeline(spark, sf)
    raw = p.products_raw.drop("sku_id").withColumn("vendor", F.expr(_NO_VENDOR))
    return C.clean_products(raw, p.params).select("product_num", "sku_id")


@register("j1_normalised_keys", O.with_base(f"""
, plain AS (SELECT count(*) AS n FROM sales_raw s JOIN products_raw p ON s.sku_id = p.sku_id JOIN buyers_raw b ON s.buyer_id = b.buyer_id),
normal AS (SELECT count(*) AS n FROM sales_raw s JOIN products_raw p ON upper({O.strip('s.sku_id')}) = upper({O.strip('p.sku_id')})
           JOIN buyers_raw b ON upper({O.strip('s.buyer_id')}) = upper({O.strip('b.buyer_id')}))
SELECT plain.n AS matches_as_they_come, normal.n AS matches_normalised FROM plain, normal"""))
def j1(spark, sf):
    """Lines that meet a product and a buyer with the keys as they come, and after J1."""
    from orderlens.operators.lines import normalize_ids
    p = pipeline(spark, sf)
    sides = [p.sales_raw.select("sku_id", "buyer_id"), p.products_raw.select("sku_id"), p.buyers_raw.select("buyer_id")]

    def matches(sales, products, buyers):
        return sales.join(products, "sku_id").join(buyers, "buyer_id").agg(F.count(F.lit(1)).alias("n")).scalar()

    return spark.range(1).select(matches(*sides).alias("matches_as_they_come"),
                                 matches(*[normalize_ids(s, ["sku_id", "buyer_id"]) for s in sides]).alias("matches_normalised"))


@register("pr3_year_filter", O.with_base("""
SELECT CAST(year(order_datetime_company) AS INTEGER) AS year, count(*) AS lines FROM l1
WHERE order_datetime_company IS NOT NULL AND year(order_datetime_company) >= 1998 GROUP BY 1 ORDER BY 1"""))
def pr3(spark, sf):
    """Lines by company year under a later bound, which drops the years before it."""
    from orderlens.operators.orders import prepare_lines
    p = pipeline(spark, sf)
    lines = prepare_lines(p.lines, p.params.with_(line_min_year=1998))
    return lines.groupBy(F.year("order_datetime_company").alias("year")).agg(F.count(F.lit(1)).alias("lines")).orderBy("year")
