"""Catalog entries of sources and sinks: the mapped tables go out through a sink under the
shared checkpoint folder and come back through the reader; the SQL states what must come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import clean, metrics as M, quality as Q
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.plans.queries_core import Q5_SQL
from orderlens.session import temporary_folder
from orderlens.sinks import write_metrics, write_report, write_table
from orderlens.sources.files import (
    BUYER_COLUMNS, SALES_COLUMNS, read_buyers, read_clean, read_metrics, read_products, read_sales, read_table,
)


def _folder(spark, name: str) -> str:
    return temporary_folder(spark, f"orderlens-io/{name}") + "/table"


def _no_token(c: str) -> str:
    """NaN is one of the texts that a CSV reader takes for a missing value."""
    return f"nullif({c}, 'NaN') AS {c}"


@register("src1_sales_csv", O.with_base(f"SELECT {', '.join(map(_no_token, SALES_COLUMNS))} FROM sales_raw"))
def src1(spark, sf):
    base = _folder(spark, "sales")
    write_table(pipeline(spark, sf).sales_raw.select(*SALES_COLUMNS), base, formats=("csv",))
    return read_sales(spark, f"{base}.csv").select(*SALES_COLUMNS)


_BUYERS = ["buyer_id", "customer_group", "customer_segment", "preferred_channel", "signup_date", "region", "state",
           "timezone", "is_referred", "wishlist_size", "is_active_buyer"]


@register("src2_buyers_csv", O.with_base(f"SELECT {', '.join(_BUYERS)} FROM buyers_raw"))
def src2(spark, sf):
    base = _folder(spark, "buyers")
    assert set(_BUYERS) <= set(BUYER_COLUMNS)
    write_table(pipeline(spark, sf).buyers_raw.select(*_BUYERS), base, formats=("csv",))
    return read_buyers(spark, f"{base}.csv", multi_line=False).select(*_BUYERS)


_LEFT, _RIGHT = ["sku_id", "vendor", "price", "current_stock"], ["price", "category_name", "sku_id"]


@register("src3_catalogues_csv", O.with_base("""
SELECT sku_id, price, vendor, current_stock, NULL AS category_name FROM products_raw WHERE length(product_num) % 2 = 0
UNION ALL SELECT sku_id, price, NULL, NULL, category_name FROM products_raw WHERE length(product_num) % 2 = 1"""))
def src3(spark, sf):
    """Two vendors' layouts, as many files as Spark writes, in one folder."""
    folder, p = _folder(spark, "catalogues"), pipeline(spark, sf).products_raw
    odd = F.length("product_num") % 2 == 1
    out = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    p.where(~odd).select(*_LEFT).write.options(**out).csv(folder)
    p.where(odd).select(*_RIGHT).write.mode("append").options(**out).csv(folder)
    return read_products(spark, folder).select("sku_id", "price", "vendor", "current_stock", "category_name")


@register("src4_required_columns", O.with_base("""
SELECT order_status AS name, count(*) AS rows FROM sales_clean GROUP BY 1
UNION ALL SELECT 'missing: buyer_id, sku_id', 0"""))
def src4(spark, sf):
    """SRC4: a table that fulfils its contract is read; one that lacks columns is refused with their names."""
    path = _folder(spark, "contract")
    pipeline(spark, sf).sales.select("order_id", "order_status").write.parquet(path)
    rows = read_table(spark, path, ["order_id", "order_status"]).groupBy(F.col("order_status").alias("name")).agg(
        F.count(F.lit(1)).alias("rows"))
    try:
        read_table(spark, path, ["order_id", "buyer_id", "sku_id"])
        refused = "nothing"
    except ValueError as e:
        refused = ", ".join(c for c in ("order_id", "buyer_id", "sku_id") if repr(c) in str(e))
    return rows.unionByName(spark.createDataFrame([(f"missing: {refused}", 0)], "name string, rows bigint"))


@register("src7_registry_json", O.with_base("""
SELECT customer_segment AS name, 'order' AS grain, min(quarter) AS definition, max(quarter) AS formula,
       list_sort(list(DISTINCT region)) AS inputs FROM order_level GROUP BY 1"""))
def src7(spark, sf):
    """SRC7: a JSON document with one entry for each segment goes out as the lineage registry does, and comes back as rows."""
    from orderlens.sources.files import read_registry
    path, orders = _folder(spark, "registry"), pipeline(spark, sf).orders
    pairs = orders.groupBy("customer_segment", "region").agg(F.min("quarter").alias("lo"), F.max("quarter").alias("hi"))
    entries = pairs.groupBy(F.col("customer_segment").alias("name")).agg(
        F.first(F.lit("order")).alias("grain"), F.min("lo").alias("definition"), F.max("hi").alias("formula"),
        F.sort_array(F.collect_list("region")).alias("inputs"))
    # one document, as small as the number of segments
    entries.agg(F.collect_list(F.struct("name", "grain", "definition", "formula", "inputs")).alias("fields")).coalesce(1).write.json(path)
    return read_registry(spark, path)


@register("src5_clean_tables", O.with_base("""
SELECT 'parquet' AS source, order_id, sku_id, CAST(quantity AS VARCHAR) AS quantity FROM sales_clean
UNION ALL SELECT 'csv', buyer_id, timezone, NULL FROM buyers_clean"""))
def src5(spark, sf):
    """SNK1 and SRC4 / SRC5: one table with Parquet, one with CSV only."""
    p, a, b = pipeline(spark, sf), _folder(spark, "sales_clean"), _folder(spark, "buyers_clean")
    write_table(p.sales.select("order_id", "sku_id", "quantity"), a)
    write_table(p.buyers.select("buyer_id", "timezone"), b, formats=("csv",))
    read_table(spark, f"{a}.parquet", ["order_id", "sku_id", "quantity"])
    left = read_clean(spark, a).select(F.lit("parquet").alias("source"), "order_id", "sku_id",
                                       F.col("quantity").cast("string").alias("quantity"))
    return left.unionByName(read_clean(spark, b).select(
        F.lit("csv").alias("source"), F.col("buyer_id").alias("order_id"), F.col("timezone").alias("sku_id"),
        F.lit(None).cast("string").alias("quantity")))


@register("src6_metric_tables", O.with_base(f"""
, q5 AS ({Q5_SQL})
SELECT 'q1' AS "table", CAST(year AS VARCHAR) || '-' || CAST(hour_company AS VARCHAR) AS key, CAST(count(DISTINCT order_id) AS DOUBLE) AS value
FROM ow GROUP BY 2
UNION ALL SELECT 'q5', customer_segment, total_profit FROM q5"""))
def src6(spark, sf):
    """SNK2 fan-out and SRC6 with its contract of columns."""
    folder, orders = _folder(spark, "metrics"), pipeline(spark, sf).orders
    write_metrics({"q1": M.hourly_volume(orders, P), "q5": M.segment_kpis(orders, P)}, folder)
    back = read_metrics(spark, folder, {"q1": ["year", "hour", "order_volume"], "q5": ["customer_segment", "total_profit"]})
    return back["q1"].select(
        F.lit("q1").alias("table"), F.concat_ws("-", F.col("year").cast("string"), F.col("hour").cast("string")).alias("key"),
        F.col("order_volume").cast("double").alias("value")).unionByName(
        back["q5"].select(F.lit("q5").alias("table"), F.col("customer_segment").alias("key"), F.col("total_profit").alias("value")))


@register("snk3_rule_report", O.with_base("""
SELECT 'DQ_B001' AS rule_id, CAST(count_if(buyer_id IS NULL) AS DOUBLE) AS value, count_if(buyer_id IS NULL) = 0 AS passed FROM buyers_clean
UNION ALL SELECT 'DQ_B002', CAST(count(*) - count(DISTINCT buyer_id) AS DOUBLE), count(*) = count(DISTINCT buyer_id) FROM buyers_clean"""))
def snk3(spark, sf):
    path = _folder(spark, "report")
    write_report(Q.check_buyers_clean(pipeline(spark, sf).buyers), path)
    return spark.read.schema("rule_id string, value double, passed boolean").json(path)


# Files by how they spell the flag: one with truth values only, one with a mixture.
_FILE = "CASE WHEN lower(trim(active_product)) IN ('true', 'false') THEN 'truth.csv' ELSE 'mixed.csv' END"


@register("cp5_compat_flags", O.with_base(f"""
, f AS (SELECT *, {_FILE} AS file FROM products_raw),
b AS (SELECT file, bool_and(active_product IS NULL OR lower(trim(active_product)) IN ('true', 'false')) AS a,
             bool_and(currently_active_vendor IS NULL OR lower(trim(currently_active_vendor)) IN ('true', 'false')) AS v FROM f GROUP BY 1)
SELECT upper(trim(sku_id)) AS sku_id, file,
       CASE WHEN a THEN CAST(lower(trim(active_product)) = 'true' AS DOUBLE) ELSE TRY_CAST(active_product AS DOUBLE) END AS active,
       CASE WHEN v THEN CAST(lower(trim(currently_active_vendor)) = 'true' AS DOUBLE)
            ELSE TRY_CAST(currently_active_vendor AS DOUBLE) END AS vendor_active FROM f JOIN b USING (file)"""))
def cp5(spark, sf):
    p = pipeline(spark, sf)
    done = clean.clean_products(p.products_raw.withColumn("_file", F.expr(_FILE)), p.params, "compat")
    return done.select("sku_id", F.col("_file").alias("file"), F.col("active_product_num").alias("active"),
                       F.col("currently_active_vendor_num").alias("vendor_active"))
