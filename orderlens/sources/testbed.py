"""Driver star schema -> the reference's raw entities (FIXTURES C).

Each raw column is one SQL expression that both Spark SQL and DuckDB accept,
so the Spark pipeline and the SQL oracle start from identical raw rows.  Raw
columns are strings, as in the CSV exports the cleaning layer is built for.

The mapping also plants what the cleaning layer is there for, by arithmetic on the
keys: padded and mixed-case keys, null ids, a mistyped and a null status, other
time layouts and no time at all, bad quantities and rare huge ones (fewer than one line
in a thousand, so that they lie above the cap), repeated buyers of
differing completeness or place, misspelt product group names, buyers whose sales carry no id, percent-only margins, a
vendor that sells at a loss, mixed flag spellings, doubled blanks, a legacy zone id
and orders within the hours that clock changes skip and repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ZONE_BY_NATION = (
    "CASE WHEN n_nationkey = 7 THEN 'EST5EDT' ELSE CASE n_nationkey % 6 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' "
    "WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Phoenix' WHEN 4 THEN 'America/Los_Angeles' "
    "ELSE 'Pacific/Honolulu' END END"
)

BUYER_EXPRS = [
    ("buyer_id", "CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 10 = 3 THEN '  ' || CAST(c_custkey AS STRING) || ' ' "
                 "ELSE CAST(c_custkey AS STRING) END"),
    ("customer_group", "CASE c_custkey % 5 WHEN 0 THEN 'Regular' WHEN 1 THEN 'Occasional' "
                       "WHEN 2 THEN 'Frequent' WHEN 3 THEN 'VIP' ELSE 'Dormant' END"),
    ("customer_segment", "c_mktsegment"),
    ("preferred_channel", "CASE c_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END"),
    ("signup_date", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(1 + c_custkey % 12 AS STRING) || '/' "
                    "|| CAST(1 + c_custkey % 28 AS STRING) || '/94 0:00' END"),
    ("region", "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE r_name END"),
    ("state", "n_name"),
    ("timezone", f"CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {ZONE_BY_NATION} END"),
    ("is_referred", "CASE WHEN c_custkey % 50 = 0 THEN '2' WHEN c_custkey % 5 = 1 THEN '1' ELSE '0' END"),
    ("wishlist_size", "CAST(c_custkey % 20 AS STRING)"),
    ("is_active_buyer", "CASE WHEN c_custkey % 53 = 0 THEN '0' WHEN c_custkey % 31 = 0 THEN '0' ELSE '1' END"),
    ("_ord", "2 * c_custkey"),
]
# Second records of some buyers: full copies, less complete ones, and ones from another place.
BUYER_COPY_FILTER = "c_custkey % 40 IN (5, 6)"
BUYER_COPY_CHANGES = {
    "signup_date": "CASE WHEN c_custkey % 40 = 5 THEN NULL ELSE {} END",
    "region": "CASE WHEN c_custkey % 40 = 5 THEN NULL WHEN c_custkey % 120 = 46 THEN 'ATLANTIS' ELSE {} END",
    "state": "CASE WHEN c_custkey % 120 = 86 THEN 'UTOPIA' ELSE {} END",
    "timezone": "CASE WHEN c_custkey % 120 = 6 THEN 'Pacific/Honolulu' ELSE {} END",
    "_ord": "2 * c_custkey - 1",
}
BUYER_COPY_EXPRS = [(n, BUYER_COPY_CHANGES.get(n, "{}").format(e)) for n, e in BUYER_EXPRS]

# Clock of an order: midnight, but in the hours that clock changes skip or repeat on the days around them.
_CLOCK = ("CASE WHEN month(o_orderdate) = 4 AND day(o_orderdate) <= 7 THEN '2:30' "
          "WHEN month(o_orderdate) = 10 AND day(o_orderdate) >= 25 THEN '1:30' ELSE '0:00' END")
_MONTH_DAY = "CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/'"
_YEAR = "CAST(year(o_orderdate) AS STRING)"

SALES_EXPRS = [
    ("order_id", "CASE WHEN l_orderkey % 211 = 0 THEN NULL WHEN l_orderkey % 9 = 2 THEN CAST(l_orderkey AS STRING) || '  ' "
                 "ELSE CAST(l_orderkey AS STRING) END"),
    ("buyer_id", "CASE WHEN o_custkey % 53 = 0 THEN NULL WHEN l_orderkey % 7 = 1 THEN ' ' || CAST(o_custkey AS STRING) "
                 "ELSE CAST(o_custkey AS STRING) END"),
    ("sku_id", "CASE WHEN l_partkey % 5 = 1 THEN ' sku-' || CAST(l_partkey AS STRING) || ' ' "
               "ELSE 'SKU-' || CAST(l_partkey AS STRING) END"),
    ("quantity", "CASE l_orderkey % 401 WHEN 0 THEN '0' WHEN 1 THEN '-3' WHEN 2 THEN 'many' WHEN 3 THEN '12d' WHEN 4 THEN 'NaN' "
                 "WHEN 5 THEN CASE WHEN l_linenumber = 1 THEN '900' ELSE CAST(l_quantity AS STRING) END "
                 "ELSE CAST(l_quantity AS STRING) END"),
    ("order_datetime", f"CASE WHEN l_orderkey % 101 = 0 THEN 'soon' "
                       f"WHEN l_orderkey % 13 = 1 THEN {_MONTH_DAY} || {_YEAR} || ' ' || {_CLOCK} "
                       f"WHEN l_orderkey % 13 = 2 THEN {_YEAR} || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' "
                       f"|| lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' ' || lpad({_CLOCK}, 5, '0') || ':00' "
                       f"ELSE {_MONTH_DAY} || lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0') || ' ' || {_CLOCK} END"),
    ("order_status", "CASE WHEN l_orderkey % 23 = 0 THEN 'Deliverred' WHEN l_orderkey % 29 = 0 THEN NULL ELSE o_orderstatus END"),
    ("_ord", "l_linenumber"),
]

PRODUCT_EXPRS = [
    ("category_name", "CASE WHEN p_partkey % 6 = 0 THEN replace(p_type, ' ', '  ') ELSE p_type END"),
    ("subcategory_id", "CASE WHEN p_partkey % 8 = 3 THEN ' ' || replace(p_type, ' ', '   ') ELSE p_type END"),
    ("subcategory_name", "CASE WHEN p_partkey % 17 = 3 THEN p_name || ' of typ ' || p_type "
                         "WHEN p_partkey % 23 = 5 THEN lower(p_name || ' off type ' || p_type) "
                         "WHEN p_partkey % 29 = 7 THEN p_name || '  of   type ' || p_type ELSE p_name || ' of type ' || p_type END"),
    ("vendor", "CASE WHEN p_partkey % 9 = 4 THEN p_brand || ' ' ELSE p_brand END"),
    ("product_num", "CAST(p_partkey AS STRING)"),
    ("sku_id", "CASE WHEN p_partkey % 4 = 2 THEN 'Sku-' || CAST(p_partkey AS STRING) || ' ' ELSE 'SKU-' || CAST(p_partkey AS STRING) END"),
    ("price", "CASE WHEN p_partkey % 4 = 0 THEN '$' || CAST(p_retailprice AS STRING) "
              "ELSE CAST(p_retailprice AS STRING) END"),
    ("profit_margin", "CASE WHEN p_partkey % 13 = 0 OR p_partkey % 11 = 5 THEN NULL WHEN p_brand = 'Brand#7' THEN -0.05 "
                      "ELSE CAST(p_partkey % 60 AS DOUBLE) / 100 END"),
    ("pct_profit_margin", "CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_brand = 'Brand#7' THEN '-5.0' "
                          "WHEN p_partkey % 19 = 7 THEN CAST(p_partkey % 60 + 1 AS STRING) "
                          "WHEN p_partkey % 3 = 0 OR p_partkey % 11 = 5 THEN CAST(p_partkey % 60 AS STRING) END"),
    ("active_product", "CASE p_partkey % 7 WHEN 0 THEN 'N' WHEN 1 THEN 'False' WHEN 2 THEN ' y ' WHEN 3 THEN 'TRUE' ELSE 'Y' END"),
    ("currently_active_vendor", "CASE WHEN p_partkey % 5 = 0 THEN '0' ELSE '1' END"),
    ("current_stock", "CAST(p_size AS STRING)"),
    ("_ord", "p_partkey"),
]

# Hourly demand from the event stream: purchases are one-line orders.
EVENT_ORDER_EXPRS = [
    ("order_id", "CAST(event_id AS STRING)"),
    ("buyer_id", "CAST(user_id AS STRING)"),
    ("order_datetime", "ts"),
    ("timezone", "CASE user_id % 6 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' "
                 "WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Phoenix' WHEN 4 THEN 'America/Los_Angeles' "
                 "ELSE 'Pacific/Honolulu' END"),
    ("value", "value"),
]
EVENT_FILTER = "event_type = 'purchase'"


def _select(exprs) -> list[str]:
    return [f"{e} AS {n}" for n, e in exprs]


class Testbed:
    """Raw entities derived from the driver parquet tables at ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def buyers_raw(self) -> DataFrame:
        # nation (25 rows) and region (5 rows) are fixed-size dimensions of the
        # star schema, so broadcasting them is size-safe at any scale factor.
        c = self.table("customer")
        n = F.broadcast(self.table("nation"))
        r = F.broadcast(self.table("region"))
        j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return j.selectExpr(*_select(BUYER_EXPRS)).unionByName(
            j.where(BUYER_COPY_FILTER).selectExpr(*_select(BUYER_COPY_EXPRS)))

    def sales_raw(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        # orders grows with lineitem: a shuffle join (never a broadcast) at any
        # scale, and sort-merge rather than shuffled-hash, because a hash build
        # side cannot spill and an orders partition at 100 TB is gigabytes.
        return li.join(o.hint("shuffle_merge"), li.l_orderkey == o.o_orderkey).selectExpr(*_select(SALES_EXPRS))

    def products_raw(self) -> DataFrame:
        return self.table("part").selectExpr(*_select(PRODUCT_EXPRS))

    def event_orders(self) -> DataFrame:
        return self.table("events").where(EVENT_FILTER).selectExpr(*_select(EVENT_ORDER_EXPRS))


def testbed_ctes() -> str:
    """The same mapping as SQL CTEs (for the DuckDB oracle)."""
    b = ", ".join(_select(BUYER_EXPRS))
    s = ", ".join(_select(SALES_EXPRS))
    p = ", ".join(_select(PRODUCT_EXPRS))
    e = ", ".join(_select(EVENT_ORDER_EXPRS))
    return (
        f"buyers_raw AS (SELECT {b} FROM customer JOIN nation ON c_nationkey = n_nationkey "
        f"JOIN region ON n_regionkey = r_regionkey "
        f"UNION ALL SELECT {', '.join(_select(BUYER_COPY_EXPRS))} FROM customer JOIN nation ON c_nationkey = n_nationkey "
        f"JOIN region ON n_regionkey = r_regionkey WHERE {BUYER_COPY_FILTER}),\n"
        f"sales_raw AS (SELECT {s} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),\n"
        f"products_raw AS (SELECT {p} FROM part),\n"
        f"event_orders AS (SELECT {e} FROM events WHERE {EVENT_FILTER})"
    )
