"""Catalog entries: order table and the six headline metrics (PR16, Q1-Q5b)."""

from __future__ import annotations

from orderlens.operators import metrics as M
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.sources.testbed import Testbed

Y0, Y1 = P.metric_years


@register("pr16_order_level", O.with_base("SELECT * FROM order_level"))
def pr16_order_level(spark, sf):
    return pipeline(spark, sf).orders


@register("q1_hourly_order_volume", O.with_base(
    "SELECT year, hour_company AS hour, count(DISTINCT order_id) AS order_volume FROM ow GROUP BY 1, 2 ORDER BY 1, 2"))
def q1_hourly_order_volume(spark, sf):
    return M.hourly_volume(pipeline(spark, sf).orders, P)


Q2_SELECT = f"""
SELECT *, q75_profit - q25_profit AS profit_iqr,
       (q75_profit - q25_profit) / (abs(median_profit_per_order) + 1.0) AS profit_volatility
FROM (SELECT quarter, customer_segment, {O.mean('order_profit')} AS avg_profit_per_order,
             {O.q('order_profit', 0.5)} AS median_profit_per_order, {O.q('order_profit', 0.25)} AS q25_profit,
             {O.q('order_profit', 0.75)} AS q75_profit, {O.msum('order_profit')} AS total_profit,
             count(DISTINCT order_id) AS order_count, {O.msum('order_revenue')} AS total_revenue
      FROM ow GROUP BY 1, 2) t"""


@register("q2_profit_by_quarter_segment", O.with_base(Q2_SELECT + " ORDER BY 1, 2"))
def q2_profit_by_quarter_segment(spark, sf):
    return M.profit_by_quarter_segment(pipeline(spark, sf).orders, P)


_CF = ("CAST(order_revenue AS DECIMAL(20,6)) + CAST(referral_discount_amount AS DECIMAL(20,6)) "
       "- CAST(order_cogs AS DECIMAL(20,6)) - CAST(company_shipping_cost AS DECIMAL(20,6))")


@register("q3_referral_impact", O.with_base(f"""
, g AS (
  SELECT CASE WHEN is_referred = 1 THEN 'referred' ELSE 'non_referred' END AS referral_group,
         count(DISTINCT buyer_id) AS unique_customers, count(DISTINCT order_id) AS order_count,
         {O.mean('order_profit')} AS avg_profit_per_order, {O.q('order_profit', 0.5)} AS median_profit_per_order,
         {O.msum('order_profit')} AS total_profit, {O.msum('order_revenue')} AS total_revenue,
         {O.msum('referral_discount_amount')} AS total_referral_discount,
         {O.msum('black_friday_discount_amount')} AS total_black_friday_discount,
         {O.msum('order_cogs')} AS total_cogs, {O.msum('company_shipping_cost')} AS total_company_shipping_cost,
         SUM({_CF}) AS _cf, SUM(CAST(order_profit AS DECIMAL(20,6))) AS _tp
  FROM ow GROUP BY 1),
h AS (
  SELECT * EXCLUDE (_cf, _tp), CAST(_cf AS DOUBLE) AS counterfactual_profit,
         CAST(_cf - _tp AS DOUBLE) AS net_lift_from_referral,
         coalesce(CASE WHEN referral_group = 'referred' THEN
             (max(CASE WHEN referral_group = 'referred' THEN avg_profit_per_order END) OVER ()
              - max(CASE WHEN referral_group = 'non_referred' THEN avg_profit_per_order END) OVER ()) * order_count END,
           0.0) AS profit_quality_delta
  FROM g)
SELECT *, net_lift_from_referral + profit_quality_delta AS total_referral_cost FROM h""".replace("\n, g AS", ", g AS")))
def q3_referral_impact(spark, sf):
    return M.referral_impact(pipeline(spark, sf).orders, P)


Q4_SQL = f"""WITH d AS (
  SELECT year, customer_segment, CAST(order_datetime_company AS DATE) AS day,
         count(DISTINCT order_id) AS daily_orders, SUM(CAST(order_revenue AS DECIMAL(20,6))) AS daily_revenue,
         SUM(CAST(order_profit AS DECIMAL(20,6))) AS daily_profit,
         SUM(CAST(black_friday_discount_amount AS DECIMAL(20,6))) AS daily_discount,
         bool_or(is_black_friday) AS bf
  FROM ow WHERE order_datetime_company IS NOT NULL GROUP BY 1, 2, 3),
g AS (
  SELECT year, customer_segment, CAST(SUM(daily_orders) AS BIGINT) AS annual_orders,
         CAST(SUM(daily_revenue) AS DOUBLE) AS annual_revenue, CAST(SUM(daily_profit) AS DOUBLE) AS annual_profit,
         coalesce(CAST(SUM(CASE WHEN bf THEN daily_orders END) AS BIGINT), 0) AS bf_orders,
         coalesce(CAST(SUM(CASE WHEN bf THEN daily_revenue END) AS DOUBLE), 0.0) AS bf_revenue,
         coalesce(CAST(SUM(CASE WHEN bf THEN daily_profit END) AS DOUBLE), 0.0) AS bf_profit,
         coalesce(CAST(SUM(CASE WHEN bf THEN daily_discount END) AS DOUBLE), 0.0) AS bf_discount_amount,
         coalesce({O.q("CASE WHEN NOT bf THEN CAST(daily_orders AS DOUBLE) END", 0.5)}, 0.0) AS median_daily_orders,
         coalesce({O.q("CASE WHEN NOT bf THEN CAST(daily_revenue AS DOUBLE) END", 0.5)}, 0.0) AS median_daily_revenue,
         coalesce({O.q("CASE WHEN NOT bf THEN CAST(daily_profit AS DOUBLE) END", 0.5)}, 0.0) AS median_daily_profit
  FROM d GROUP BY 1, 2)
SELECT *, {O.ratio('bf_orders', 'median_daily_orders')} AS volume_lift_x,
       {O.ratio('bf_revenue', 'median_daily_revenue')} AS revenue_lift_x,
       bf_profit - median_daily_profit AS bf_profit_impact,
       {O.ratio('bf_orders', 'annual_orders')} * 100 AS bf_order_share_pct,
       {O.ratio('bf_revenue', 'annual_revenue')} * 100 AS bf_revenue_share_pct
FROM g"""


@register("q4_black_friday_impact", O.with_base(", q4 AS (" + Q4_SQL + ") SELECT * FROM q4 ORDER BY 1, 2"))
def q4_black_friday_impact(spark, sf):
    return M.peak_day_impact(pipeline(spark, sf).orders, P)


def _segment_sql(keys: str) -> str:
    return f"""
  SELECT {keys}, count(DISTINCT buyer_id) AS unique_customers, count(DISTINCT order_id) AS order_count,
         {O.mean('order_profit')} AS avg_profit_per_order, {O.q('order_profit', 0.5)} AS median_profit_per_order,
         {O.msum('order_profit')} AS total_profit, {O.msum('order_revenue')} AS total_revenue,
         {O.msum('order_cogs')} AS total_cogs,
         SUM(CAST(referral_discount_amount AS DECIMAL(20,6))) AS _ref,
         SUM(CAST(black_friday_discount_amount AS DECIMAL(20,6))) AS _bf,
         {O.msum('company_shipping_cost')} AS total_company_shipping
  FROM ow GROUP BY {keys}"""


def _derived_sql(src: str) -> str:
    return f"""
  SELECT * EXCLUDE (_ref, _bf), CAST(_ref AS DOUBLE) AS total_referral_discount,
         CAST(_bf AS DOUBLE) AS total_black_friday_discount,
         {O.ratio('order_count', 'unique_customers')} AS orders_per_customer,
         CAST(_ref + _bf AS DOUBLE) AS total_discounts,
         {O.ratio('CAST(_ref + _bf AS DOUBLE)', 'total_revenue')} * 100 AS discount_pct,
         {O.ratio('total_cogs', 'total_revenue')} * 100 AS cogs_pct,
         {O.ratio('total_company_shipping', 'order_count')} AS shipping_per_order
  FROM {src}"""


Q5_SQL = f"""WITH s AS ({_segment_sql('customer_segment')}),
t AS ({_derived_sql('s')}),
u AS (SELECT *, {O.ratio('total_profit', 'unique_customers')} AS profit_per_customer,
             median_profit_per_order * orders_per_customer AS ltv_proxy,
             median_profit_per_order >= quantile_cont(median_profit_per_order, 0.5) OVER () AS hp,
             order_count >= quantile_cont(order_count, 0.5) OVER () AS hv FROM t)
SELECT * EXCLUDE (hp, hv), CASE WHEN hp AND hv THEN 'CORE' WHEN hp AND NOT hv THEN 'EXPAND'
       WHEN NOT hp AND hv THEN 'OPTIMIZE' ELSE 'DEPRIORITIZE' END AS strategic_bucket
FROM u"""


@register("q5_customer_base_kpis", O.with_base(", q5 AS (" + Q5_SQL + ") SELECT * FROM q5 ORDER BY total_profit DESC"))
def q5_customer_base_kpis(spark, sf):
    return M.segment_kpis(pipeline(spark, sf).orders, P)


@register("q5_quarterly_segment_analysis", O.with_base(f"""
, s AS ({_segment_sql('quarter, customer_segment')})
{_derived_sql('s')} ORDER BY quarter, total_profit DESC""".replace("\n, s AS", ", s AS")))
def q5_quarterly_segment_analysis(spark, sf):
    return M.segment_kpis_quarterly(pipeline(spark, sf).orders, P)


@register("pr15_year_distribution", O.with_base(
    "SELECT CAST(year(order_datetime_company) AS INTEGER) AS year, count(*) AS orders FROM o2 GROUP BY 1 ORDER BY 1"))
def pr15_year_distribution(spark, sf):
    from orderlens.operators.orders import roll_up_orders, year_distribution
    p = pipeline(spark, sf)
    return year_distribution(roll_up_orders(p.priced_lines, p.params, year_band=False))
