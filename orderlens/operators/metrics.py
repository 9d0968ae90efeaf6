"""Business metrics over the order-level table (Q1-Q5, QA).

All take ``(orders, params)`` and return small aggregated DataFrames.  Money
aggregates are exact fixed-point sums; means are exact sum / count; quantiles
are exact (linear interpolation, as Spark's ``percentile``), never
approximate.  Quantiles over order rows (groups as large as a whole segment)
come from ``quantiles.with_group_quantiles``, a distributed rank selection,
so no group's values are ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.numeric import exact_mean, money_sum, rounded, safe_ratio
from orderlens.operators.common import distinct_counts, join_groups
from orderlens.operators.quantiles import with_group_quantiles
from orderlens.params import Params


def in_window(orders: DataFrame, params: Params) -> DataFrame:
    lo, hi = params.metric_years
    return orders.where(F.col("year").between(lo, hi))


def _with_people(agg: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """``unique_customers`` and ``order_count`` after the group's keys.  Counted apart from the sums, which then need no
    row copied for each distinct count."""
    people = distinct_counts(src, keys, {"unique_customers": "buyer_id", "order_count": "order_id"})
    sums = [c for c in agg.columns if c not in keys]
    return join_groups(agg, people, keys).select(*keys, "unique_customers", "order_count", *sums)


def _with_median(agg: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """``median_profit_per_order`` of ``src`` per group, attached to ``agg``."""
    m = with_group_quantiles(agg, src, keys, "order_profit", [0.5], ["_median"])
    return m.withColumn("_median", rounded(F.col("_median")))


# ------------------------------------------------------------------ Q1
def hourly_volume(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q1: distinct orders by (year, company hour)."""
    return (in_window(orders, params)
            .groupBy("year", F.col("hour_company").alias("hour"))
            .agg(F.count_distinct("order_id").alias("order_volume"))
            .orderBy("year", "hour"))


# ------------------------------------------------------------------ Q2
def profit_by_quarter_segment(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q2: profit distribution per (quarter, segment) with IQR and volatility."""
    src = in_window(orders, params)
    keys = ["quarter", "customer_segment"]
    g = src.groupBy(*keys).agg(
        exact_mean("order_profit").alias("avg_profit_per_order"),
        money_sum("order_profit").alias("total_profit"),
        F.count_distinct("order_id").alias("order_count"),
        money_sum("order_revenue").alias("total_revenue"),
    )
    g = with_group_quantiles(g, src, keys, "order_profit", [0.25, 0.5, 0.75], ["_q25", "_q50", "_q75"])
    return (g.select(
        "quarter", "customer_segment", "avg_profit_per_order",
        rounded(F.col("_q50")).alias("median_profit_per_order"),
        rounded(F.col("_q25")).alias("q25_profit"),
        rounded(F.col("_q75")).alias("q75_profit"),
        "total_profit", "order_count", "total_revenue")
        .withColumn("profit_iqr", F.col("q75_profit") - F.col("q25_profit"))
        .withColumn("profit_volatility", F.col("profit_iqr") / (F.abs("median_profit_per_order") + F.lit(1.0)))
        .orderBy("quarter", "customer_segment"))


# ------------------------------------------------------------------ Q3
def referral_group(col: str = "is_referred") -> F.Column:
    return F.when(F.col(col) == 1, F.lit("referred")).otherwise(F.lit("non_referred"))


def referral_impact(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q3: referred vs non-referred economics, counterfactual and quality delta."""
    cf = (F.col("order_revenue").cast("decimal(20,6)") + F.col("referral_discount_amount").cast("decimal(20,6)")
          - F.col("order_cogs").cast("decimal(20,6)") - F.col("company_shipping_cost").cast("decimal(20,6)"))
    src = in_window(orders, params).withColumn("referral_group", referral_group())
    g = (src.groupBy("referral_group").agg(
             exact_mean("order_profit").alias("avg_profit_per_order"),
             money_sum("order_profit").alias("total_profit"),
             money_sum("order_revenue").alias("total_revenue"),
             money_sum("referral_discount_amount").alias("total_referral_discount"),
             money_sum("black_friday_discount_amount").alias("total_black_friday_discount"),
             money_sum("order_cogs").alias("total_cogs"),
             money_sum("company_shipping_cost").alias("total_company_shipping_cost"),
             F.sum(cf).alias("_cf"),
             F.sum(F.col("order_profit").cast("decimal(20,6)")).alias("_tp"),
         ))
    g = _with_median(_with_people(g, src, ["referral_group"]), src, ["referral_group"])
    names = [c for c in g.columns if c != "_median"]
    i = names.index("avg_profit_per_order") + 1
    g = g.select(*names[:i], F.col("_median").alias("median_profit_per_order"), *names[i:])
    # At most two rows (one per group): the cross-row window is over that.
    w = Window.partitionBy()
    ref_avg = F.max(F.when(F.col("referral_group") == "referred", F.col("avg_profit_per_order"))).over(w)
    non_avg = F.max(F.when(F.col("referral_group") == "non_referred", F.col("avg_profit_per_order"))).over(w)
    delta = F.when(F.col("referral_group") == "referred", (ref_avg - non_avg) * F.col("order_count"))
    return (g.withColumn("counterfactual_profit", F.col("_cf").cast("double"))
             .withColumn("net_lift_from_referral", (F.col("_cf") - F.col("_tp")).cast("double"))
             .withColumn("profit_quality_delta", F.coalesce(delta, F.lit(0.0)))
             .withColumn("total_referral_cost", F.col("net_lift_from_referral") + F.col("profit_quality_delta"))
             .drop("_cf", "_tp"))


# ------------------------------------------------------------------ Q4
def daily_segment(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q4 stage 1: one row per (year, segment, company date)."""
    return (in_window(orders, params)
            .withColumn("order_date_company", F.to_date("order_datetime_company"))
            .where(F.col("order_date_company").isNotNull())
            .groupBy("year", "customer_segment", "order_date_company").agg(
                F.count_distinct("order_id").alias("daily_orders"),
                F.sum(F.col("order_revenue").cast("decimal(20,6)")).alias("daily_revenue"),
                F.sum(F.col("order_profit").cast("decimal(20,6)")).alias("daily_profit"),
                F.sum(F.col("black_friday_discount_amount").cast("decimal(20,6)")).alias("daily_discount"),
                F.bool_or("is_black_friday").alias("is_black_friday")))


def peak_day_impact(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q4: holiday vs median active non-holiday day per (year, segment)."""
    d = daily_segment(orders, params)
    bf = F.col("is_black_friday")

    def on_bf(c):
        return F.when(bf, F.col(c))

    def off_bf(c):
        return F.when(~bf, F.col(c).cast("double"))

    # Medians here are over days (at most 366 values per segment-year), so
    # the exact in-aggregate percentile buffer is bounded.
    g = d.groupBy("year", "customer_segment").agg(
        F.sum("daily_orders").alias("annual_orders"),
        F.sum("daily_revenue").cast("double").alias("annual_revenue"),
        F.sum("daily_profit").cast("double").alias("annual_profit"),
        F.coalesce(F.sum(on_bf("daily_orders")), F.lit(0)).alias("bf_orders"),
        F.coalesce(F.sum(on_bf("daily_revenue")).cast("double"), F.lit(0.0)).alias("bf_revenue"),
        F.coalesce(F.sum(on_bf("daily_profit")).cast("double"), F.lit(0.0)).alias("bf_profit"),
        F.coalesce(F.sum(on_bf("daily_discount")).cast("double"), F.lit(0.0)).alias("bf_discount_amount"),
        F.coalesce(rounded(F.percentile(off_bf("daily_orders"), F.lit(0.5))), F.lit(0.0)).alias("median_daily_orders"),
        F.coalesce(rounded(F.percentile(off_bf("daily_revenue"), F.lit(0.5))), F.lit(0.0)).alias("median_daily_revenue"),
        F.coalesce(rounded(F.percentile(off_bf("daily_profit"), F.lit(0.5))), F.lit(0.0)).alias("median_daily_profit"),
    )
    return (g.withColumn("volume_lift_x", safe_ratio("bf_orders", "median_daily_orders"))
             .withColumn("revenue_lift_x", safe_ratio("bf_revenue", "median_daily_revenue"))
             .withColumn("bf_profit_impact", F.col("bf_profit") - F.col("median_daily_profit"))
             .withColumn("bf_order_share_pct", safe_ratio("bf_orders", "annual_orders") * 100)
             .withColumn("bf_revenue_share_pct", safe_ratio("bf_revenue", "annual_revenue") * 100)
             .orderBy("year", "customer_segment"))


# ------------------------------------------------------------------ Q5
def segment_aggs() -> list:
    """The per-segment aggregates but the distinct counts and the median (see ``segment_table``)."""
    return [
        exact_mean("order_profit").alias("avg_profit_per_order"),
        money_sum("order_profit").alias("total_profit"),
        money_sum("order_revenue").alias("total_revenue"),
        money_sum("order_cogs").alias("total_cogs"),
        F.sum(F.col("referral_discount_amount").cast("decimal(20,6)")).alias("_ref"),
        F.sum(F.col("black_friday_discount_amount").cast("decimal(20,6)")).alias("_bf"),
        money_sum("company_shipping_cost").alias("total_company_shipping"),
    ]


def segment_table(src: DataFrame, keys: list[str]) -> DataFrame:
    """The ten aggregates per group (median attached by distributed selection)."""
    g = _with_median(_with_people(src.groupBy(*keys).agg(*segment_aggs()), src, keys), src, keys)
    names = [c for c in g.columns if c != "_median"]
    i = names.index("avg_profit_per_order") + 1
    return g.select(*names[:i], F.col("_median").alias("median_profit_per_order"), *names[i:])


def add_derived(df: DataFrame) -> DataFrame:
    """Five derived ratios (guarded divisions -> 0)."""
    return (df.withColumn("total_referral_discount", F.col("_ref").cast("double"))
              .withColumn("total_black_friday_discount", F.col("_bf").cast("double"))
              .withColumn("orders_per_customer", safe_ratio("order_count", "unique_customers"))
              .withColumn("total_discounts", (F.col("_ref") + F.col("_bf")).cast("double"))
              .withColumn("discount_pct", safe_ratio("total_discounts", "total_revenue") * 100)
              .withColumn("cogs_pct", safe_ratio("total_cogs", "total_revenue") * 100)
              .withColumn("shipping_per_order", safe_ratio("total_company_shipping", "order_count"))
              .drop("_ref", "_bf"))


def segment_kpis(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q5: segment KPIs with strategic bucket by medians across segments."""
    seg = add_derived(segment_table(in_window(orders, params), ["customer_segment"]))
    seg = (seg.withColumn("profit_per_customer", safe_ratio("total_profit", "unique_customers"))
              .withColumn("ltv_proxy", F.col("median_profit_per_order") * F.col("orders_per_customer")))
    # One row per segment: medians across segments over that small table.
    w = Window.partitionBy()
    m_profit = F.percentile("median_profit_per_order", F.lit(0.5)).over(w)
    m_volume = F.percentile("order_count", F.lit(0.5)).over(w)
    hp = F.col("median_profit_per_order") >= m_profit
    hv = F.col("order_count") >= m_volume
    bucket = (F.when(hp & hv, "CORE").when(hp & ~hv, "EXPAND").when(~hp & hv, "OPTIMIZE")
               .otherwise("DEPRIORITIZE"))
    return seg.withColumn("strategic_bucket", bucket).orderBy(F.col("total_profit").desc())


def segment_kpis_quarterly(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """The same aggregates per (quarter, segment)."""
    q = add_derived(segment_table(in_window(orders, params), ["quarter", "customer_segment"]))
    return q.orderBy(F.col("quarter").asc(), F.col("total_profit").desc())


METRIC_TABLES = {
    "q1_hourly_order_volume": hourly_volume,
    "q2_profit_by_quarter_segment": profit_by_quarter_segment,
    "q3_referral_impact": referral_impact,
    "q4_black_friday_impact": peak_day_impact,
    "q5_customer_base_kpis": segment_kpis,
    "q5_quarterly_segment_analysis": segment_kpis_quarterly,
}


def build_metrics(orders: DataFrame, params: Params = Params()) -> dict[str, DataFrame]:
    """QA: the six metric tables over one (materialised) order table."""
    return {name: fn(orders, params) for name, fn in METRIC_TABLES.items()}
