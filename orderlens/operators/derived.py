"""Derived metric tables (Q1b-Q5j): the numbers behind the dashboards,
notebooks and audits, each a plain DataFrame function.

Windows without a partition key appear only over already-aggregated tables
whose row count is the number of groups (hours, quarters, segments, ranks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.numeric import exact_mean, money_sum, rounded, safe_ratio
from orderlens.operators import metrics as M
from orderlens.operators.quantiles import quantiles_row, with_group_quantiles
from orderlens.operators.running import global_rank, running_rank_sum
from orderlens.params import Params

NIGHT_HOURS = (0, 5)
def _all():
    return Window.partitionBy()


# ------------------------------------------------------------------ Q1 family
def hourly_rows_as_utc(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Row count by (year, hour) where the naive company timestamp is read
    as UTC and converted to the company zone (the interactive variant)."""
    ts = F.convert_timezone(F.lit("UTC"), F.lit(params.company_timezone), F.col("order_datetime_company"))
    d = orders.select(F.year(ts).alias("year"), F.hour(ts).alias("hour")).where(F.col("year").isNotNull())
    lo, hi = params.metric_years
    return (d.where(F.col("year").between(lo, hi)).groupBy("year", "hour")
             .agg(F.count(F.lit(1)).alias("order_volume")).orderBy("year", "hour"))


def hourly_profile(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Dense 24-hour histogram (missing hours 0) with percent of total."""
    counts = orders.groupBy(F.col("hour_company").alias("hour")).agg(F.count(F.lit(1)).alias("order_count"))
    hours = orders.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    d = hours.join(counts, "hour", "left").na.fill(0, ["order_count"])
    return (d.withColumn("pct", F.col("order_count") / F.sum("order_count").over(_all()) * 100)
             .orderBy("hour"))


def staffing_kpis(hourly: DataFrame) -> DataFrame:
    """Q1d: totals, night share, first peak row, peak-to-mean-night ratio over (year, hour) rows."""
    night = F.col("hour").between(*NIGHT_HOURS)
    peak = F.max_by(F.struct("year", "hour", "order_volume"),
                    F.struct(F.col("order_volume"), -F.col("year"), -F.col("hour")))
    g = hourly.agg(
        F.sum("order_volume").alias("total_orders"),
        F.coalesce(F.sum(F.when(night, F.col("order_volume"))), F.lit(0)).alias("night_orders"),
        F.avg(F.when(night, F.col("order_volume").cast("double"))).alias("night_avg"),
        peak.alias("peak"))
    return g.select(
        "total_orders", "night_orders",
        safe_ratio("night_orders", "total_orders").alias("_np"),
        F.col("peak.year").alias("peak_year"), F.col("peak.hour").alias("peak_hour"),
        F.col("peak.order_volume").alias("peak_orders"), rounded(F.col("night_avg")).alias("night_avg"),
    ).withColumn("night_pct", F.col("_np") * 100).drop("_np") \
     .withColumn("peak_to_night", rounded(safe_ratio("peak_orders", "night_avg")))


def hourly_pivot(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q1e: year x hour distinct-order matrix, missing cells 0."""
    return (M.in_window(orders, params).groupBy("year").pivot("hour_company", list(range(24)))
            .agg(F.count_distinct("order_id")).na.fill(0).orderBy("year"))


def headline_counts(orders: DataFrame, lines: DataFrame, sales: DataFrame) -> DataFrame:
    """Q1f: distinct buyers and orders, and buyer-key coverage of sales in the line fact."""
    sales_ids = sales.select("buyer_id").where(F.col("buyer_id").isNotNull()).distinct()
    line_ids = lines.select("buyer_id").distinct().withColumn("_hit", F.lit(1))
    cov = sales_ids.join(line_ids, "buyer_id", "left").agg(
        F.count(F.lit(1)).alias("_n"), F.count("_hit").alias("_c"))
    o = orders.agg(F.count_distinct("buyer_id").alias("num_customers"),
                   F.count_distinct("order_id").alias("num_orders"))
    return o.select("*", cov.select(F.round(safe_ratio("_c", "_n") * 100, 2).alias("c")).scalar().alias("coverage_pct"))


def night_audit(orders: DataFrame) -> DataFrame:
    """Q1g: distinct orders per hour over all years with night share and mean night volume."""
    h = orders.groupBy(F.col("hour_company").alias("hour")).agg(F.count_distinct("order_id").alias("orders"))
    night = F.col("hour").between(*NIGHT_HOURS)
    return h.agg(
        F.sum("orders").alias("total_orders"),
        (safe_ratio(F.sum(F.when(night, F.col("orders"))), F.sum("orders")) * 100).alias("night_share_pct"),
        F.max_by("hour", F.struct(F.col("orders"), -F.col("hour"))).alias("peak_hour"),
        rounded(F.avg(F.when(night, F.col("orders").cast("double")))).alias("mean_night_hour_orders"))


# ------------------------------------------------------------------ Q2 family
def quarter_segment_avg(orders: DataFrame) -> DataFrame:
    return orders.groupBy("quarter", "customer_segment").agg(
        exact_mean("order_profit").alias("avg_profit_per_order"),
        F.count_distinct("order_id").alias("order_count"))


def segment_stability(orders: DataFrame) -> DataFrame:
    """Mean and sample std of quarterly average profit per segment; CV."""
    q = quarter_segment_avg(orders)
    s = q.groupBy("customer_segment").agg(
        rounded(F.avg("avg_profit_per_order")).alias("avg_profit"),
        rounded(F.stddev_samp("avg_profit_per_order")).alias("std_profit"))
    return s.withColumn("cv", rounded(F.try_divide("std_profit", "avg_profit"))).orderBy(F.col("avg_profit").desc())


def stability_kpis(orders: DataFrame) -> DataFrame:
    """Portfolio average, top / lowest segment, most stable segment (min CV)."""
    s = segment_stability(orders)
    port = quarter_segment_avg(orders).agg(rounded(F.avg("avg_profit_per_order")).alias("v")).scalar()
    return s.agg(
        F.max_by("customer_segment", F.struct("avg_profit", F.col("customer_segment"))).alias("top_segment"),
        F.max("avg_profit").alias("top_segment_avg"),
        F.min_by("customer_segment", F.struct("avg_profit", F.col("customer_segment"))).alias("lowest_segment"),
        F.min("avg_profit").alias("lowest_segment_avg"),
        F.min_by("customer_segment", F.struct("cv", F.col("customer_segment"))).alias("most_stable_segment"),
        F.min("cv").alias("most_stable_cv"),
    ).withColumn("portfolio_avg", port)


def quarter_labels(params: Params) -> list[str]:
    lo, hi = params.metric_years
    return [f"{y}Q{q}" for y in range(lo, hi + 1) for q in range(1, 5)]


def segment_quarter_pivot(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q2d: segment x quarter average profit in calendar order (window quarters)."""
    q = quarter_segment_avg(M.in_window(orders, params))
    return (q.groupBy("customer_segment").pivot("quarter", quarter_labels(params))
             .agg(F.first("avg_profit_per_order")).orderBy("customer_segment"))


def quarter_kpis(q2: DataFrame) -> DataFrame:
    """Q2e: per quarter orders, profit, median of segment medians, top / lowest segment."""
    key = F.struct(F.col("median_profit_per_order"), F.col("customer_segment"))
    return q2.groupBy("quarter").agg(
        F.sum("order_count").alias("total_orders"),
        money_sum("total_profit").alias("total_profit"),
        rounded(F.median("median_profit_per_order")).alias("overall_median_profit_per_order"),
        F.max_by("customer_segment", key).alias("top_segment"),
        F.max("median_profit_per_order").alias("top_segment_profit"),
        F.min_by("customer_segment", key).alias("lowest_segment"),
        F.min("median_profit_per_order").alias("lowest_segment_profit"),
    ).orderBy("quarter")


def segment_highlights(q2: DataFrame) -> DataFrame:
    """Q2f: top-4 and bottom-2 segments by total profit with a stability label."""
    s = q2.groupBy("customer_segment").agg(money_sum("total_profit").alias("total_profit"),
                                           rounded(F.avg("profit_volatility")).alias("mean_volatility"))
    down = F.row_number().over(Window.orderBy(F.col("total_profit").desc(), "customer_segment"))
    up = F.row_number().over(Window.orderBy(F.col("total_profit").asc(), F.col("customer_segment").desc()))
    s = s.withColumn("_d", down).withColumn("_u", up).where((F.col("_d") <= 4) | (F.col("_u") <= 2))
    top = F.col("_d") <= 4
    label = (F.when(top, F.when(F.col("mean_volatility") < 0.5, "Stable").otherwise("Moderate"))
              .otherwise(F.when(F.col("mean_volatility") > 1.0, "Volatile").otherwise("Moderate")))
    return s.select("customer_segment", "total_profit", "mean_volatility",
                    F.when(top, "top").otherwise("bottom").alias("group"), label.alias("stability"))


def segment_rank_by_profit(orders: DataFrame) -> DataFrame:
    """Q2i: mean, median and sample std of order profit per segment."""
    g = orders.groupBy("customer_segment").agg(
        exact_mean("order_profit").alias("mean_profit"),
        rounded(F.stddev_samp("order_profit")).alias("std_profit"),
        F.count(F.lit(1)).alias("orders"))
    g = with_group_quantiles(g, orders, ["customer_segment"], "order_profit", [0.5], ["_m"])
    return g.select("customer_segment", "mean_profit", rounded(F.col("_m")).alias("median_profit"),
                    "std_profit", "orders").orderBy(F.col("mean_profit").desc())


def peak_flag_profit(orders: DataFrame) -> DataFrame:
    """Q2h: mean order profit on holiday vs other days, per segment."""
    bf = F.col("is_black_friday")
    return orders.groupBy("customer_segment").agg(
        exact_mean(F.when(~bf, F.col("order_profit"))).alias("non_peak_avg_profit"),
        exact_mean(F.when(bf, F.col("order_profit"))).alias("peak_avg_profit"))


def line_profit_by_quarter(lines_max_amount: DataFrame) -> DataFrame:
    """Q2g: line-level profit by customer-local ``YYYY-Qn`` and segment (the
    notebook rounds to cents for display; values here are unrounded)."""
    q = F.concat(F.year("order_datetime").cast("string"), F.lit("-Q"), F.quarter("order_datetime").cast("string"))
    return lines_max_amount.groupBy(q.alias("quarter"), "customer_segment").agg(
        exact_mean("profit").alias("avg_profit"),
        money_sum("profit").alias("total_profit"),
        F.count("profit").alias("lines")).orderBy("quarter", "customer_segment")


# ------------------------------------------------------------------ Q3 family
def referral_economics(q3: DataFrame) -> DataFrame:
    """Orders per customer, CAC, LTV, ROI and decision (referred row vs non-referred)."""
    r = F.col("referral_group") == "referred"

    def pick(c, cond):
        return F.max(F.when(cond, F.col(c)))

    g = q3.agg(pick("order_count", r).alias("ro"), pick("unique_customers", r).alias("rc"),
               pick("avg_profit_per_order", r).alias("rp"), pick("total_referral_discount", r).alias("rd"),
               pick("order_count", ~r).alias("no"), pick("unique_customers", ~r).alias("nc"),
               pick("avg_profit_per_order", ~r).alias("np"))
    opc = safe_ratio("ro", "rc")
    cac = safe_ratio("rd", "rc")
    ltv = F.col("rp") * opc
    roi = F.when(cac > 0, ltv / cac).otherwise(F.lit(0.0))
    return g.select(
        opc.alias("referred_orders_per_customer"), safe_ratio("no", "nc").alias("non_referred_orders_per_customer"),
        cac.alias("cac"), ltv.alias("ltv"), roi.alias("roi"),
        F.when(roi > 20, "CONTINUE").when(roi > 5, "OPTIMIZE").otherwise("RECONSIDER").alias("decision"))


def referred_order_counts(orders: DataFrame) -> DataFrame:
    return (orders.where(F.col("is_referred") == 1).groupBy("buyer_id")
                  .agg(F.count_distinct("order_id").alias("orders")))


def referred_orders_per_buyer(orders: DataFrame) -> DataFrame:
    """Distinct orders per referred buyer: median (int) and mean."""
    c = referred_order_counts(orders)
    # one row per referred buyer: the median is the distributed exact selection
    med = quantiles_row(c, "orders", [0.5], ["m"]).select(F.floor("m").cast("long")).scalar()
    return c.agg(rounded(F.avg("orders")).alias("mean_orders_per_buyer"),
                 F.count(F.lit(1)).alias("referred_buyers")).select(
        med.alias("median_orders_per_buyer"), "mean_orders_per_buyer", "referred_buyers")


def payback_curve(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q3d: cumulative revenue by order rank per buyer (time, then order id);
    per rank the cohort means / std / n, difference, SE and 95 % band; ranks
    capped at ``params.payback_max_rank``."""
    base = (orders.where(F.col("order_datetime_company").isNotNull())
            .select("buyer_id", "is_referred", "order_datetime_company", "order_id", "order_revenue"))
    # per-buyer running order: distributed prefix scan (a hot buyer spans many tasks)
    d = running_rank_sum(base, "buyer_id", ["order_datetime_company", "order_id"], "order_revenue",
                         rank_col="order_rank", sum_col="cum")
    d = d.withColumn("cum", F.col("cum").cast("double"))
    ref = F.col("is_referred") == 1
    r = d.where(F.col("order_rank") <= params.payback_max_rank).groupBy("order_rank").agg(
        exact_mean(F.when(ref, F.col("cum"))).alias("mean_ref"),
        rounded(F.stddev_samp(F.when(ref, F.col("cum"))), 5).alias("std_ref"),
        F.count(F.when(ref, F.lit(1))).alias("n_ref"),
        exact_mean(F.when(~ref, F.col("cum"))).alias("mean_nonref"),
        rounded(F.stddev_samp(F.when(~ref, F.col("cum"))), 5).alias("std_nonref"),
        F.count(F.when(~ref, F.lit(1))).alias("n_nonref"))
    r = r.where((F.col("n_ref") > 0) & (F.col("n_nonref") > 0))
    se = F.sqrt(F.col("std_ref") ** 2 / F.col("n_ref") + F.col("std_nonref") ** 2 / F.col("n_nonref"))
    inc = F.col("mean_ref") - F.col("mean_nonref")
    return (r.withColumn("se_diff", rounded(se)).withColumn("inc_mean", inc)
             .withColumn("inc_low", rounded(F.col("inc_mean") - 1.96 * F.col("se_diff")))
             .withColumn("inc_high", rounded(F.col("inc_mean") + 1.96 * F.col("se_diff")))
             .withColumn("n_effective", F.least("n_ref", "n_nonref")).orderBy("order_rank"))


def payback_point(curve: DataFrame, q3: DataFrame) -> DataFrame:
    """Q3e, from the curve of Q3d: first rank whose incremental mean covers the discount per referred
    buyer, and incremental revenue = last difference x referred buyers."""
    r = q3.where(F.col("referral_group") == "referred")
    disc = r.select(safe_ratio("total_referral_discount", "unique_customers").alias("d")).scalar()
    buyers = r.select(F.col("unique_customers").alias("b")).scalar()
    return curve.agg(
        F.min(F.when(F.col("inc_mean") >= disc, F.col("order_rank"))).alias("payback_order"),
        (F.max_by("inc_mean", "order_rank") * buyers).alias("incremental_revenue_total"),
    ).withColumn("discount_per_buyer", disc)


def referred_cumulative_revenue(orders: DataFrame) -> DataFrame:
    """Q3f: final cumulative revenue per referred buyer, ranked descending."""
    t = orders.where(F.col("is_referred") == 1).groupBy("buyer_id").agg(money_sum("order_revenue").alias("cum_revenue"))
    # one row per referred buyer (grows with the data): a distributed rank
    return global_rank(t, [F.col("cum_revenue").desc(), F.col("buyer_id")]).select("buyer_id", "cum_revenue", "rank")


def order_frequency(orders: DataFrame, top: int = 15) -> DataFrame:
    """Q3g: how many referred buyers have n orders (order rows), first ``top`` n."""
    n = orders.where(F.col("is_referred") == 1).groupBy("buyer_id").agg(F.count(F.lit(1)).alias("orders"))
    return n.groupBy("orders").agg(F.count(F.lit(1)).alias("customers")).orderBy("orders").limit(top)


# Order-count bins (right-closed) and their labels.
FREQ_BINS = [(0, 3, "1-3"), (3, 6, "4-6"), (6, 10, "7-10"), (10, 20, "11-20"), (20, 50, "21-50"), (50, None, "50+")]


def order_frequency_bins(orders: DataFrame) -> DataFrame:
    """Q3h: referred buyers per order-count bin, empty bins kept."""
    c = referred_order_counts(orders)
    label = None
    for lo, hi, name in FREQ_BINS:
        cond = (F.col("orders") > lo) if hi is None else ((F.col("orders") > lo) & (F.col("orders") <= hi))
        label = F.when(cond, name) if label is None else label.when(cond, name)
    counts = c.groupBy(label.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    spark = orders.sparkSession
    bins = spark.createDataFrame([(i, name) for i, (_, _, name) in enumerate(FREQ_BINS)], "bin_order int, bin string")
    return bins.join(counts, "bin", "left").na.fill(0, ["customers"]).orderBy("bin_order")


def referral_direct_loss(orders: DataFrame) -> DataFrame:
    """Q3i: total referral discount, discounted orders, average, share of orders."""
    disc = F.col("is_referral_discount")
    return orders.agg(
        money_sum("referral_discount_amount").alias("total_referral_discount"),
        F.count_if(disc).alias("referral_orders"),
        F.count(F.lit(1)).alias("all_orders")).select(
        "total_referral_discount", "referral_orders",
        safe_ratio("total_referral_discount", "referral_orders").alias("avg_discount"),
        (safe_ratio("referral_orders", "all_orders") * 100).alias("referral_order_share_pct"))


def repeat_analysis(orders: DataFrame) -> DataFrame:
    """Q3j: referred buyers with / without repeat orders and their mean lifetime profit."""
    b = orders.where(F.col("is_referred") == 1).groupBy("buyer_id").agg(
        F.sum(F.col("order_profit").cast("decimal(20,6)")).cast("double").alias("total_profit"),
        F.count_distinct("order_id").alias("orders")).withColumn("has_repeat", F.col("orders") > 1)
    g = b.groupBy("has_repeat").agg(F.count(F.lit(1)).alias("customers"),
                                    exact_mean("total_profit").alias("avg_lifetime_profit"))
    return g.withColumn("pct", F.col("customers") / F.sum("customers").over(_all()) * 100)


def referred_segment_value(orders: DataFrame) -> DataFrame:
    """Q3k: referred orders by segment with discount efficiency (profit / discount, NULL if 0)."""
    g = orders.where(F.col("is_referred") == 1).groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("order_profit").alias("total_profit"),
        money_sum("referral_discount_amount").alias("total_discount"))
    eff = F.when(F.col("total_discount") != 0, F.col("total_profit") / F.col("total_discount"))
    return (g.withColumn("discount_efficiency", eff)
             .withColumn("roi", F.coalesce(eff, F.lit(0.0))).orderBy(F.col("roi").desc()))


def cohort_profile(orders: DataFrame) -> DataFrame:
    """Q3l: customers, orders, mean / median profit, discount and profit per cohort."""
    src = orders.withColumn("cohort", M.referral_group())
    g = src.groupBy("cohort").agg(
        F.count_distinct("buyer_id").alias("customers"), F.count(F.lit(1)).alias("orders"),
        exact_mean("order_profit").alias("avg_profit"),
        money_sum("referral_discount_amount").alias("total_discount"), money_sum("order_profit").alias("total_profit"))
    g = with_group_quantiles(g, src, ["cohort"], "order_profit", [0.5], ["_m"])
    return g.select("cohort", "customers", "orders", "avg_profit", rounded(F.col("_m")).alias("median_profit"),
                    "total_discount", "total_profit")


# ------------------------------------------------------------------ Q4 family
def peak_day_overall(q4: DataFrame) -> DataFrame:
    """Total holiday orders / sum of segment medians; profit lift; net profit lift."""
    g = q4.agg(F.sum("bf_orders").alias("bf_orders"), rounded(F.sum("median_daily_orders")).alias("median_orders"),
               money_sum("bf_profit").alias("bf_profit"), money_sum("median_daily_profit").alias("median_profit"),
               money_sum("bf_discount_amount").alias("bf_discount"))
    return (g.withColumn("volume_lift", safe_ratio("bf_orders", "median_orders"))
             .withColumn("profit_lift", safe_ratio("bf_profit", "median_profit"))
             .withColumn("net_profit_lift", F.col("bf_profit") - F.col("median_profit")))


def peak_day_latest(q4: DataFrame) -> DataFrame:
    """Latest year's segment rows with profit lift, sorted by revenue lift."""
    latest = q4.select(F.max("year").alias("y")).scalar()
    return (q4.where(F.col("year") == latest)
              .withColumn("profit_lift", safe_ratio("bf_profit", "median_daily_profit"))
              .orderBy("revenue_lift_x"))


def peak_day_aov(orders: DataFrame) -> DataFrame:
    """Q4d: average order value, revenue and discount by segment for holiday vs other days."""
    bf = F.col("is_black_friday")
    return orders.groupBy("customer_segment").agg(
        F.coalesce(exact_mean(F.when(~bf, F.col("order_revenue"))), F.lit(0.0)).alias("normal_aov"),
        F.coalesce(exact_mean(F.when(bf, F.col("order_revenue"))), F.lit(0.0)).alias("bf_aov"),
        F.coalesce(money_sum(F.when(bf, F.col("order_revenue"))), F.lit(0.0)).alias("bf_net_revenue"),
        F.coalesce(money_sum(F.when(bf, F.col("black_friday_discount_amount"))), F.lit(0.0)).alias("bf_discount_foregone"),
    ).orderBy(F.col("bf_aov").desc(), "customer_segment")


def peak_day_segment_summary(q4: DataFrame) -> DataFrame:
    """Q4f: cross-year segment means of shares and total profit impact."""
    return q4.groupBy("customer_segment").agg(
        rounded(F.avg("bf_order_share_pct")).alias("mean_order_share_pct"),
        rounded(F.avg("bf_revenue_share_pct")).alias("mean_revenue_share_pct"),
        money_sum("bf_profit_impact").alias("total_profit_impact")).orderBy("customer_segment")


def peak_day_audit(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q4g: per year effective holiday discount rate, all-segment median daily
    orders on other days, holiday share of profit and of orders."""
    o = M.in_window(orders, params).withColumn("day", F.to_date("order_datetime_company"))
    daily = o.groupBy("year", "day").agg(F.count_distinct("order_id").alias("n"),
                                         F.bool_or("is_black_friday").alias("bf"))
    med = daily.where(~F.col("bf")).groupBy("year").agg(
        rounded(F.median(F.col("n").cast("double"))).alias("median_daily_orders"))
    bf = F.col("is_black_friday")
    g = o.groupBy("year").agg(
        F.count_if(bf).alias("bf_orders"), F.count(F.lit(1)).alias("orders"),
        F.sum(F.when(bf, F.col("black_friday_discount_amount").cast("decimal(20,6)"))).alias("_d"),
        F.sum(F.when(bf, F.col("order_base_revenue").cast("decimal(20,6)"))).alias("_b"),
        F.sum(F.when(bf, F.col("order_profit").cast("decimal(20,6)"))).alias("_p"),
        F.sum(F.col("order_profit").cast("decimal(20,6)")).alias("_tp"))
    g = g.select("year", "bf_orders",
                 safe_ratio(F.col("_d").cast("double"), F.col("_b").cast("double")).alias("effective_discount_rate"),
                 (safe_ratio(F.col("_p").cast("double"), F.col("_tp").cast("double")) * 100).alias("bf_profit_share_pct"),
                 (safe_ratio("bf_orders", "orders") * 100).alias("bf_order_share_pct"))
    return g.join(med, "year", "left").orderBy("year")


# ------------------------------------------------------------------ Q5 family
# Quadrant names of the profit / volume matrix.
QUADRANTS = {"hh": "Defend and Scale", "lh": "High Demand, Improve Margin", "hl": "Niche Premium",
             "ll": "Low Priority"}


def segment_quadrants(q5: DataFrame) -> DataFrame:
    """Quadrant of each segment by medians across segments; segments listed by profit."""
    x_mid = F.percentile("median_profit_per_order", F.lit(0.5)).over(_all())
    y_mid = F.percentile("order_count", F.lit(0.5)).over(_all())
    hx, hy = F.col("median_profit_per_order") >= x_mid, F.col("order_count") >= y_mid
    quad = (F.when(hx & hy, QUADRANTS["hh"]).when(~hx & hy, QUADRANTS["lh"])
             .when(hx & ~hy, QUADRANTS["hl"]).otherwise(QUADRANTS["ll"]))
    d = q5.select("customer_segment", "total_profit", quad.alias("quadrant"))
    return d.groupBy("quadrant").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(-F.col("total_profit"), F.col("customer_segment")))),
                    lambda s: s.getField("customer_segment")).alias("segments"),
        F.count(F.lit(1)).alias("n_segments")).orderBy("quadrant")


def bucket_rollup(q5: DataFrame) -> DataFrame:
    """Q5d: per strategic bucket: segments, profit, profit share, and the means over its
    segments of median profit per order, orders per customer, discount % and COGS %.
    The pooled ratios (sums over sums) carry that word in their names."""
    def mean_of(c):
        return rounded(F.avg(c))

    share = lambda c: safe_ratio(c, "total_revenue") * 100
    g = q5.withColumns({"_discount": share("total_discounts"), "_cogs": share("total_cogs")}) \
        .groupBy("strategic_bucket").agg(
        F.count(F.lit(1)).alias("segments"), money_sum("total_profit").alias("total_profit"),
        money_sum("total_revenue").alias("total_revenue"), money_sum("total_cogs").alias("total_cogs"),
        money_sum("total_discounts").alias("total_discounts"),
        F.sum("order_count").alias("orders"), F.sum("unique_customers").alias("customers"),
        mean_of("median_profit_per_order").alias("mean_margin_per_order"),
        mean_of("orders_per_customer").alias("mean_orders_per_customer"),
        mean_of("_discount").alias("mean_discount_pct"), mean_of("_cogs").alias("mean_cogs_pct"))
    return (g.withColumn("profit_share_pct", rounded(F.col("total_profit") / F.sum("total_profit").over(_all()) * 100))
             .withColumn("pooled_margin_pct", rounded(safe_ratio(F.col("total_revenue") - F.col("total_cogs"), "total_revenue") * 100))
             .withColumn("pooled_orders_per_customer", safe_ratio("orders", "customers"))
             .orderBy(F.col("total_profit").desc()))


def top_segments(q5: DataFrame, n: int = 3) -> DataFrame:
    """Q5d labels: the ``n`` segments of largest profit with their shares of all profit and all customers."""
    shared = q5.select(
        "customer_segment", "strategic_bucket", "total_profit", "unique_customers",
        rounded(safe_ratio("total_profit", F.sum("total_profit").over(_all())) * 100).alias("profit_share_pct"),
        rounded(safe_ratio("unique_customers", F.sum("unique_customers").over(_all())) * 100).alias("customer_share_pct"))
    return shared.orderBy(F.col("total_profit").desc(), "customer_segment").limit(n)


def line_segment_ranking(priced_lines: DataFrame) -> DataFrame:
    """Q5e: line-level segment ranking (buyers, lines, profit, revenue, quantity, per-customer ratios)."""
    profit = F.col("line_net_revenue_before_shipping") - F.col("line_cogs")
    g = priced_lines.groupBy("customer_segment").agg(
        F.count_distinct("buyer_id").alias("buyers"), F.count(F.lit(1)).alias("lines"),
        F.sum(profit).alias("_p"), F.sum("line_net_revenue_before_shipping").alias("_r"),
        F.sum(F.col("quantity").cast("decimal(20,6)")).alias("_q"))
    return g.select(
        "customer_segment", "buyers", "lines",
        (F.col("_p").cast("double") / F.col("lines")).alias("avg_line_profit"),
        F.col("_p").cast("double").alias("total_profit"), F.col("_r").cast("double").alias("total_revenue"),
        F.col("_q").cast("double").alias("total_quantity"),
        safe_ratio(F.col("_p").cast("double"), "buyers").alias("profit_per_customer"),
        safe_ratio("lines", "buyers").alias("lines_per_customer")).orderBy(F.col("total_profit").desc())


def state_share(orders: DataFrame, top: int = 10) -> DataFrame:
    """Q5f: buyers, orders and profit per state with buyer market share; top ``top`` by buyers."""
    g = orders.groupBy("state").agg(F.count_distinct("buyer_id").alias("buyers"),
                                    F.count_distinct("order_id").alias("orders"),
                                    money_sum("order_profit").alias("total_profit"))
    return (g.withColumn("market_share_pct", F.col("buyers") / F.sum("buyers").over(_all()) * 100)
             .orderBy(F.col("buyers").desc(), "state").limit(top))


def best_segment_by_state(orders: DataFrame) -> DataFrame:
    """Q5g: states ranked for the segment with the highest total profit."""
    seg = orders.groupBy("customer_segment").agg(F.sum(F.col("order_profit").cast("decimal(20,6)")).alias("p"))
    best = seg.select(F.max_by("customer_segment", F.struct("p", "customer_segment")).alias("s")).scalar()
    g = orders.where(F.col("customer_segment") == best).groupBy("state").agg(
        F.count_distinct("order_id").alias("orders"), money_sum("order_profit").alias("total_profit"))
    return g.withColumn("customer_segment", best).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("total_profit").desc(), "state")))


def repeat_share_by_segment(lines_max_amount: DataFrame) -> DataFrame:
    """Q5h: share of line rows that are a buyer's 2nd+ line, per segment."""
    return lines_max_amount.groupBy("customer_segment").agg(
        (F.avg((F.col("order_number") > 1).cast("double")) * 100).alias("repeat_share_pct"),
        F.count(F.lit(1)).alias("lines")).orderBy(F.col("repeat_share_pct").desc(), "customer_segment")


def active_buyer_growth(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q5i: active buyers per (quarter, segment) and first-to-last quarter growth %."""
    a = M.in_window(orders, params).groupBy("customer_segment", "quarter").agg(
        F.count_distinct("buyer_id").alias("active_buyers"))
    return a.groupBy("customer_segment").agg(
        F.min_by("active_buyers", "quarter").alias("first_quarter_buyers"),
        F.max_by("active_buyers", "quarter").alias("last_quarter_buyers"),
        F.min("quarter").alias("first_quarter"), F.max("quarter").alias("last_quarter"),
    ).withColumn("growth_pct", rounded(safe_ratio(F.col("last_quarter_buyers") - F.col("first_quarter_buyers"),
                                                  "first_quarter_buyers", None) * 100)).orderBy("customer_segment")


def state_value(orders: DataFrame, pattern: str = r"^[A-Z]{2}$") -> DataFrame:
    """Q5j: per state buyers, orders, profit per customer and per order; states
    kept when their trimmed upper-case code matches ``pattern``."""
    st = F.upper(F.trim(F.col("state")))
    g = orders.where(st.rlike(pattern)).groupBy(st.alias("state")).agg(
        F.count_distinct("buyer_id").alias("buyers"), F.count_distinct("order_id").alias("orders"),
        money_sum("order_profit").alias("total_profit"))
    return (g.withColumn("profit_per_customer", safe_ratio("total_profit", "buyers"))
             .withColumn("profit_per_order", safe_ratio("total_profit", "orders")).orderBy(F.col("total_profit").desc()))


def peak_day_revenue_impact(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Q4e: holiday base and net revenue, discount impact and share of annual net revenue."""
    bf = F.col("is_black_friday")
    g = M.in_window(orders, params).groupBy("year", "customer_segment").agg(
        F.sum(F.when(bf, F.col("order_base_revenue").cast("decimal(20,6)"))).alias("_b"),
        F.sum(F.when(bf, F.col("order_net_revenue_before_shipping").cast("decimal(20,6)"))).alias("_n"),
        F.sum(F.col("order_net_revenue_before_shipping").cast("decimal(20,6)")).alias("_a"))
    return g.select(
        "year", "customer_segment",
        F.coalesce(F.col("_b").cast("double"), F.lit(0.0)).alias("bf_base_revenue"),
        F.coalesce(F.col("_n").cast("double"), F.lit(0.0)).alias("bf_net_revenue"),
        F.coalesce((F.col("_b") - F.col("_n")).cast("double"), F.lit(0.0)).alias("discount_impact"),
        (safe_ratio(F.coalesce(F.col("_n").cast("double"), F.lit(0.0)), F.col("_a").cast("double")) * 100).alias("pct_of_annual"),
    ).orderBy("year", "customer_segment")
