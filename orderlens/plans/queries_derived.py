"""Catalog entries: derived metric tables (Q1b-Q5j) and pricing variants."""

from __future__ import annotations

from orderlens.operators import derived as D, metrics as M, orders as OP
from orderlens.params import TESTBED as P
from orderlens.plans import oracle as O
from orderlens.plans.catalog import pipeline, register
from orderlens.plans.pipeline import lines_max_amount
from orderlens.plans.queries_core import Q4_SQL, Q5_SQL

Q5 = "q5 AS (" + Q5_SQL + ")"

Y0, Y1 = P.metric_years
CT = P.company_timezone
R8 = "round({}, 8)"


def r8(x: str) -> str:
    return f"round({x}, 8)"


def orders(spark, sf):
    return pipeline(spark, sf).orders


# ---------------------------------------------------------------- Q1 family
Q1B = f"""SELECT year, hour, count(*) AS order_volume FROM (
  SELECT CAST(year(timezone('{CT}', timezone('UTC', order_datetime_company))) AS INTEGER) AS year,
         CAST(hour(timezone('{CT}', timezone('UTC', order_datetime_company))) AS INTEGER) AS hour
  FROM order_level) t WHERE year BETWEEN {Y0} AND {Y1} GROUP BY 1, 2"""


@register("q1b_hourly_rows_as_utc", O.with_base(Q1B))
def q1b(spark, sf):
    return D.hourly_rows_as_utc(orders(spark, sf), P)


@register("q1c_hourly_profile", O.with_base("""
, c AS (SELECT hour_company AS hour, count(*) AS order_count FROM order_level GROUP BY 1),
h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
d AS (SELECT h.hour, coalesce(c.order_count, 0) AS order_count FROM h LEFT JOIN c USING (hour))
SELECT hour, order_count, order_count / sum(order_count) OVER () * 100 AS pct FROM d ORDER BY hour"""))
def q1c(spark, sf):
    return D.hourly_profile(orders(spark, sf), P)


@register("q1d_staffing_kpis", O.with_base(f"""
, q AS ({Q1B}),
a AS (SELECT CAST(sum(order_volume) AS BIGINT) AS total_orders,
             CAST(coalesce(sum(CASE WHEN hour BETWEEN 0 AND 5 THEN order_volume END), 0) AS BIGINT) AS night_orders,
             {r8('avg(CASE WHEN hour BETWEEN 0 AND 5 THEN CAST(order_volume AS DOUBLE) END)')} AS night_avg FROM q),
pk AS (SELECT year AS peak_year, hour AS peak_hour, order_volume AS peak_orders FROM q
       ORDER BY order_volume DESC, year, hour LIMIT 1)
SELECT total_orders, night_orders, peak_year, peak_hour, peak_orders, night_avg,
       {O.ratio('night_orders', 'total_orders')} * 100 AS night_pct,
       {r8(O.ratio('peak_orders', 'night_avg'))} AS peak_to_night FROM a, pk"""))
def q1d(spark, sf):
    return D.staffing_kpis(D.hourly_rows_as_utc(orders(spark, sf), P))


_PIV = ", ".join(f'count(DISTINCT CASE WHEN hour_company = {h} THEN order_id END) AS "{h}"' for h in range(24))


@register("q1e_hourly_pivot", O.with_base(f"SELECT year, {_PIV} FROM ow GROUP BY year ORDER BY year"))
def q1e(spark, sf):
    return D.hourly_pivot(orders(spark, sf), P)


@register("q1f_headline_counts", O.with_base("""
, cov AS (SELECT count(*) AS n, count(l.hit) AS c FROM (SELECT DISTINCT buyer_id FROM sales_clean WHERE buyer_id IS NOT NULL) s
          LEFT JOIN (SELECT DISTINCT buyer_id, 1 AS hit FROM line_fact) l USING (buyer_id))
SELECT (SELECT count(DISTINCT buyer_id) FROM order_level) AS num_customers,
       (SELECT count(DISTINCT order_id) FROM order_level) AS num_orders,
       round(""" + O.ratio("c", "n") + """ * 100, 2) AS coverage_pct FROM cov"""))
def q1f(spark, sf):
    p = pipeline(spark, sf)
    return D.headline_counts(p.orders, p.line_amounts, p.sales)


@register("q1g_night_audit", O.with_base(f"""
, h AS (SELECT hour_company AS hour, count(DISTINCT order_id) AS orders FROM order_level GROUP BY 1)
SELECT CAST(sum(orders) AS BIGINT) AS total_orders,
       {O.ratio('sum(CASE WHEN hour BETWEEN 0 AND 5 THEN orders END)', 'sum(orders)')} * 100 AS night_share_pct,
       (SELECT hour FROM h ORDER BY orders DESC, hour LIMIT 1) AS peak_hour,
       {r8('avg(CASE WHEN hour BETWEEN 0 AND 5 THEN CAST(orders AS DOUBLE) END)')} AS mean_night_hour_orders FROM h"""))
def q1g(spark, sf):
    return D.night_audit(orders(spark, sf))


# ---------------------------------------------------------------- Q2 family
QSA = f"SELECT quarter, customer_segment, {O.mean('order_profit')} AS avg_profit_per_order, count(DISTINCT order_id) AS order_count FROM order_level GROUP BY 1, 2"
Q2B = f"""SELECT customer_segment, avg_profit, std_profit, round(std_profit / avg_profit, 8) AS cv FROM (
  SELECT customer_segment, {r8('avg(avg_profit_per_order)')} AS avg_profit, {r8('stddev_samp(avg_profit_per_order)')} AS std_profit
  FROM ({QSA}) q GROUP BY 1) s"""


@register("q2b_segment_stability", O.with_base(Q2B + " ORDER BY avg_profit DESC"))
def q2b(spark, sf):
    return D.segment_stability(orders(spark, sf))


@register("q2c_stability_kpis", O.with_base(f"""
, s AS ({Q2B})
SELECT (SELECT customer_segment FROM s ORDER BY avg_profit DESC, customer_segment DESC LIMIT 1) AS top_segment,
       max(avg_profit) AS top_segment_avg,
       (SELECT customer_segment FROM s ORDER BY avg_profit, customer_segment LIMIT 1) AS lowest_segment,
       min(avg_profit) AS lowest_segment_avg,
       (SELECT customer_segment FROM s ORDER BY cv, customer_segment LIMIT 1) AS most_stable_segment,
       min(cv) AS most_stable_cv,
       (SELECT {r8('avg(avg_profit_per_order)')} FROM ({QSA}) q) AS portfolio_avg FROM s"""))
def q2c(spark, sf):
    return D.stability_kpis(orders(spark, sf))


_QL = D.quarter_labels(P)
_QPIV = ", ".join(f"max(CASE WHEN quarter = '{q}' THEN avg_profit_per_order END) AS \"{q}\"" for q in _QL)


@register("q2d_segment_quarter_pivot", O.with_base(f"""
SELECT customer_segment, {_QPIV} FROM (
  SELECT quarter, customer_segment, {O.mean('order_profit')} AS avg_profit_per_order FROM ow GROUP BY 1, 2) q
GROUP BY customer_segment ORDER BY customer_segment"""))
def q2d(spark, sf):
    return D.segment_quarter_pivot(orders(spark, sf), P)


Q2_SQL = f"""SELECT *, q75_profit - q25_profit AS profit_iqr,
       (q75_profit - q25_profit) / (abs(median_profit_per_order) + 1.0) AS profit_volatility
FROM (SELECT quarter, customer_segment, {O.mean('order_profit')} AS avg_profit_per_order,
             {O.q('order_profit', 0.5)} AS median_profit_per_order, {O.q('order_profit', 0.25)} AS q25_profit,
             {O.q('order_profit', 0.75)} AS q75_profit, {O.msum('order_profit')} AS total_profit,
             count(DISTINCT order_id) AS order_count, {O.msum('order_revenue')} AS total_revenue
      FROM ow GROUP BY 1, 2) t"""


@register("q2e_quarter_kpis", O.with_base(f"""
, q2 AS ({Q2_SQL})
SELECT quarter, CAST(sum(order_count) AS BIGINT) AS total_orders, {O.msum('total_profit')} AS total_profit,
       {r8('median(median_profit_per_order)')} AS overall_median_profit_per_order,
       arg_max(customer_segment, (median_profit_per_order, customer_segment)) AS top_segment,
       max(median_profit_per_order) AS top_segment_profit,
       arg_min(customer_segment, (median_profit_per_order, customer_segment)) AS lowest_segment,
       min(median_profit_per_order) AS lowest_segment_profit
FROM q2 GROUP BY quarter ORDER BY quarter"""))
def q2e(spark, sf):
    return D.quarter_kpis(M.profit_by_quarter_segment(orders(spark, sf), P))


@register("q2f_segment_highlights", O.with_base(f"""
, q2 AS ({Q2_SQL}),
s AS (SELECT customer_segment, {O.msum('total_profit')} AS total_profit, {r8('avg(profit_volatility)')} AS mean_volatility
      FROM q2 GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY total_profit DESC, customer_segment) AS d,
             row_number() OVER (ORDER BY total_profit ASC, customer_segment DESC) AS u FROM s)
SELECT customer_segment, total_profit, mean_volatility, CASE WHEN d <= 4 THEN 'top' ELSE 'bottom' END AS "group",
       CASE WHEN d <= 4 THEN (CASE WHEN mean_volatility < 0.5 THEN 'Stable' ELSE 'Moderate' END)
            ELSE (CASE WHEN mean_volatility > 1.0 THEN 'Volatile' ELSE 'Moderate' END) END AS stability
FROM r WHERE d <= 4 OR u <= 2"""))
def q2f(spark, sf):
    return D.segment_highlights(M.profit_by_quarter_segment(orders(spark, sf), P))


@register("q2g_line_profit_by_quarter", O.with_base(f"""
SELECT CAST(year(order_datetime) AS STRING) || '-Q' || CAST(quarter(order_datetime) AS STRING) AS quarter, customer_segment,
       {O.mean('profit')} AS avg_profit, {O.msum('profit')} AS total_profit, count(profit) AS lines
FROM lines_max_amount GROUP BY 1, 2 ORDER BY 1, 2"""))
def q2g(spark, sf):
    return D.line_profit_by_quarter(lines_max_amount(pipeline(spark, sf)))


@register("q2h_peak_flag_profit", O.with_base(f"""
SELECT customer_segment, {O.mean('CASE WHEN NOT is_black_friday THEN order_profit END')} AS non_peak_avg_profit,
       {O.mean('CASE WHEN is_black_friday THEN order_profit END')} AS peak_avg_profit
FROM order_level GROUP BY 1"""))
def q2h(spark, sf):
    return D.peak_flag_profit(orders(spark, sf))


@register("q2i_segment_rank_by_profit", O.with_base(f"""
SELECT customer_segment, {O.mean('order_profit')} AS mean_profit, {r8('median(order_profit)')} AS median_profit,
       {r8('stddev_samp(order_profit)')} AS std_profit, count(*) AS orders
FROM order_level GROUP BY 1 ORDER BY mean_profit DESC"""))
def q2i(spark, sf):
    return D.segment_rank_by_profit(orders(spark, sf))


# ---------------------------------------------------------------- Q3 family
Q3_SQL = f"""SELECT CASE WHEN is_referred = 1 THEN 'referred' ELSE 'non_referred' END AS referral_group,
         count(DISTINCT buyer_id) AS unique_customers, count(DISTINCT order_id) AS order_count,
         {O.mean('order_profit')} AS avg_profit_per_order, {O.msum('referral_discount_amount')} AS total_referral_discount
  FROM ow GROUP BY 1"""


@register("q3b_referral_economics", O.with_base(f"""
, g AS ({Q3_SQL}),
p AS (SELECT max(CASE WHEN referral_group = 'referred' THEN order_count END) AS ro,
             max(CASE WHEN referral_group = 'referred' THEN unique_customers END) AS rc,
             max(CASE WHEN referral_group = 'referred' THEN avg_profit_per_order END) AS rp,
             max(CASE WHEN referral_group = 'referred' THEN total_referral_discount END) AS rd,
             max(CASE WHEN referral_group <> 'referred' THEN order_count END) AS no,
             max(CASE WHEN referral_group <> 'referred' THEN unique_customers END) AS nc FROM g),
e AS (SELECT {O.ratio('ro', 'rc')} AS opc, {O.ratio('no', 'nc')} AS nopc, {O.ratio('rd', 'rc')} AS cac, rp FROM p),
f AS (SELECT opc, nopc, cac, rp * opc AS ltv FROM e),
h AS (SELECT *, CASE WHEN cac > 0 THEN ltv / cac ELSE 0.0 END AS roi FROM f)
SELECT opc AS referred_orders_per_customer, nopc AS non_referred_orders_per_customer, cac, ltv, roi,
       CASE WHEN roi > 20 THEN 'CONTINUE' WHEN roi > 5 THEN 'OPTIMIZE' ELSE 'RECONSIDER' END AS decision FROM h"""))
def q3b(spark, sf):
    return D.referral_economics(M.referral_impact(orders(spark, sf), P))


RC = "SELECT buyer_id, count(DISTINCT order_id) AS orders FROM order_level WHERE is_referred = 1 GROUP BY 1"


@register("q3c_referred_orders_per_buyer", O.with_base(f"""
SELECT CAST(floor(median(CAST(orders AS DOUBLE))) AS BIGINT) AS median_orders_per_buyer,
       {r8('avg(CAST(orders AS DOUBLE))')} AS mean_orders_per_buyer, count(*) AS referred_buyers FROM ({RC}) c"""))
def q3c(spark, sf):
    return D.referred_orders_per_buyer(orders(spark, sf))


CURVE = f"""SELECT CAST(order_rank AS INTEGER) AS order_rank,
    {O.mean('CASE WHEN ref THEN cum END')} AS mean_ref, round(stddev_samp(CASE WHEN ref THEN cum END), 5) AS std_ref,
    count(CASE WHEN ref THEN 1 END) AS n_ref,
    {O.mean('CASE WHEN NOT ref THEN cum END')} AS mean_nonref, round(stddev_samp(CASE WHEN NOT ref THEN cum END), 5) AS std_nonref,
    count(CASE WHEN NOT ref THEN 1 END) AS n_nonref
  FROM (SELECT is_referred = 1 AS ref,
               row_number() OVER (PARTITION BY buyer_id ORDER BY order_datetime_company, order_id) AS order_rank,
               CAST(sum(CAST(order_revenue AS DECIMAL(20,6))) OVER (PARTITION BY buyer_id ORDER BY order_datetime_company, order_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum
        FROM order_level WHERE order_datetime_company IS NOT NULL) d
  WHERE order_rank <= {P.payback_max_rank} GROUP BY 1"""
CURVE2 = f"""SELECT *, round(sqrt(pow(std_ref, 2) / n_ref + pow(std_nonref, 2) / n_nonref), 8) AS se_diff,
       mean_ref - mean_nonref AS inc_mean FROM ({CURVE}) c WHERE n_ref > 0 AND n_nonref > 0"""


@register("q3d_payback_curve", O.with_base(f"""
SELECT *, round(inc_mean - 1.96 * se_diff, 8) AS inc_low, round(inc_mean + 1.96 * se_diff, 8) AS inc_high,
       least(n_ref, n_nonref) AS n_effective FROM ({CURVE2}) c ORDER BY order_rank"""))
def q3d(spark, sf):
    return pipeline(spark, sf).payback_curve.orderBy("order_rank")


@register("q3e_payback_point", O.with_base(f"""
, g AS (SELECT count(DISTINCT buyer_id) AS b, {O.msum('referral_discount_amount')} AS d FROM ow WHERE is_referred = 1),
c AS ({CURVE2})
SELECT min(CASE WHEN inc_mean >= (SELECT {O.ratio('d', 'b')} FROM g) THEN order_rank END) AS payback_order,
       arg_max(inc_mean, order_rank) * (SELECT b FROM g) AS incremental_revenue_total,
       (SELECT {O.ratio('d', 'b')} FROM g) AS discount_per_buyer FROM c"""))
def q3e(spark, sf):
    p = pipeline(spark, sf)
    return D.payback_point(p.payback_curve, M.referral_impact(p.orders, P))


@register("q3f_referred_cumulative_revenue", O.with_base(f"""
SELECT buyer_id, cum_revenue, CAST(row_number() OVER (ORDER BY cum_revenue DESC, buyer_id) AS INTEGER) AS rank FROM (
  SELECT buyer_id, {O.msum('order_revenue')} AS cum_revenue FROM order_level WHERE is_referred = 1 GROUP BY 1) t"""))
def q3f(spark, sf):
    return D.referred_cumulative_revenue(orders(spark, sf))


@register("q3g_order_frequency", O.with_base("""
SELECT orders, count(*) AS customers FROM (SELECT buyer_id, count(*) AS orders FROM order_level WHERE is_referred = 1 GROUP BY 1) t
GROUP BY 1 ORDER BY 1 LIMIT 15"""))
def q3g(spark, sf):
    return D.order_frequency(orders(spark, sf))


_BINS = " ".join(f"WHEN orders > {lo}" + (f" AND orders <= {hi}" if hi is not None else "") + f" THEN '{n}'"
                 for lo, hi, n in D.FREQ_BINS)
_BINV = ", ".join(f"({i}, '{n}')" for i, (_, _, n) in enumerate(D.FREQ_BINS))


@register("q3h_order_frequency_bins", O.with_base(f"""
, c AS (SELECT CASE {_BINS} END AS bin, count(*) AS customers FROM ({RC}) t GROUP BY 1),
b AS (SELECT * FROM (VALUES {_BINV}) v(bin_order, bin))
SELECT b.bin, CAST(b.bin_order AS INTEGER) AS bin_order, coalesce(c.customers, 0) AS customers
FROM b LEFT JOIN c USING (bin) ORDER BY bin_order"""))
def q3h(spark, sf):
    return D.order_frequency_bins(orders(spark, sf))


@register("q3i_referral_direct_loss", O.with_base(f"""
SELECT total_referral_discount, referral_orders, {O.ratio('total_referral_discount', 'referral_orders')} AS avg_discount,
       {O.ratio('referral_orders', 'all_orders')} * 100 AS referral_order_share_pct
FROM (SELECT {O.msum('referral_discount_amount')} AS total_referral_discount,
             count_if(is_referral_discount) AS referral_orders, count(*) AS all_orders FROM order_level) t"""))
def q3i(spark, sf):
    return D.referral_direct_loss(orders(spark, sf))


@register("q3j_repeat_analysis", O.with_base(f"""
, b AS (SELECT buyer_id, CAST(sum(CAST(order_profit AS DECIMAL(20,6))) AS DOUBLE) AS total_profit,
               count(DISTINCT order_id) > 1 AS has_repeat FROM order_level WHERE is_referred = 1 GROUP BY 1)
SELECT has_repeat, count(*) AS customers, {O.mean('total_profit')} AS avg_lifetime_profit,
       count(*) / sum(count(*)) OVER () * 100 AS pct FROM b GROUP BY 1"""))
def q3j(spark, sf):
    return D.repeat_analysis(orders(spark, sf))


@register("q3k_referred_segment_value", O.with_base(f"""
SELECT *, CASE WHEN total_discount <> 0 THEN total_profit / total_discount END AS discount_efficiency,
       coalesce(CASE WHEN total_discount <> 0 THEN total_profit / total_discount END, 0.0) AS roi
FROM (SELECT customer_segment, count(*) AS orders, {O.msum('order_profit')} AS total_profit,
             {O.msum('referral_discount_amount')} AS total_discount FROM order_level WHERE is_referred = 1 GROUP BY 1) t
ORDER BY roi DESC"""))
def q3k(spark, sf):
    return D.referred_segment_value(orders(spark, sf))


@register("q3l_cohort_profile", O.with_base(f"""
SELECT CASE WHEN is_referred = 1 THEN 'referred' ELSE 'non_referred' END AS cohort, count(DISTINCT buyer_id) AS customers,
       count(*) AS orders, {O.mean('order_profit')} AS avg_profit, {r8('median(order_profit)')} AS median_profit,
       {O.msum('referral_discount_amount')} AS total_discount, {O.msum('order_profit')} AS total_profit
FROM order_level GROUP BY 1"""))
def q3l(spark, sf):
    return D.cohort_profile(orders(spark, sf))


# ---------------------------------------------------------------- Q4 family
Q4 = "q4 AS (" + Q4_SQL + ")"


@register("q4b_peak_day_overall", O.with_base(f"""
, {Q4}, g AS (SELECT CAST(sum(bf_orders) AS BIGINT) AS bf_orders, {r8('sum(median_daily_orders)')} AS median_orders,
      {O.msum('bf_profit')} AS bf_profit, {O.msum('median_daily_profit')} AS median_profit,
      {O.msum('bf_discount_amount')} AS bf_discount FROM q4)
SELECT *, {O.ratio('bf_orders', 'median_orders')} AS volume_lift, {O.ratio('bf_profit', 'median_profit')} AS profit_lift,
       bf_profit - median_profit AS net_profit_lift FROM g"""))
def q4b(spark, sf):
    return D.peak_day_overall(M.peak_day_impact(orders(spark, sf), P))


@register("q4c_peak_day_latest", O.with_base(f"""
, {Q4} SELECT *, {O.ratio('bf_profit', 'median_daily_profit')} AS profit_lift FROM q4
WHERE year = (SELECT max(year) FROM q4) ORDER BY revenue_lift_x"""))
def q4c(spark, sf):
    return D.peak_day_latest(M.peak_day_impact(orders(spark, sf), P))


@register("q4d_peak_day_aov", O.with_base(f"""
SELECT customer_segment,
       coalesce({O.mean('CASE WHEN NOT is_black_friday THEN order_revenue END')}, 0.0) AS normal_aov,
       coalesce({O.mean('CASE WHEN is_black_friday THEN order_revenue END')}, 0.0) AS bf_aov,
       coalesce({O.msum('CASE WHEN is_black_friday THEN order_revenue END')}, 0.0) AS bf_net_revenue,
       coalesce({O.msum('CASE WHEN is_black_friday THEN black_friday_discount_amount END')}, 0.0) AS bf_discount_foregone
FROM order_level GROUP BY 1 ORDER BY bf_aov DESC, customer_segment"""))
def q4d(spark, sf):
    return D.peak_day_aov(orders(spark, sf))


@register("q4f_peak_day_segment_summary", O.with_base(f"""
, {Q4} SELECT customer_segment, {r8('avg(bf_order_share_pct)')} AS mean_order_share_pct,
       {r8('avg(bf_revenue_share_pct)')} AS mean_revenue_share_pct, {O.msum('bf_profit_impact')} AS total_profit_impact
FROM q4 GROUP BY 1 ORDER BY 1"""))
def q4f(spark, sf):
    return D.peak_day_segment_summary(M.peak_day_impact(orders(spark, sf), P))


@register("q4g_peak_day_audit", O.with_base(f"""
, o AS (SELECT *, CAST(order_datetime_company AS DATE) AS day FROM ow),
d AS (SELECT year, day, count(DISTINCT order_id) AS n, bool_or(is_black_friday) AS bf FROM o GROUP BY 1, 2),
m AS (SELECT year, {r8('median(CAST(n AS DOUBLE))')} AS median_daily_orders FROM d WHERE NOT bf GROUP BY 1),
g AS (SELECT year, count_if(is_black_friday) AS bf_orders, count(*) AS orders,
             sum(CASE WHEN is_black_friday THEN CAST(black_friday_discount_amount AS DECIMAL(20,6)) END) AS _d,
             sum(CASE WHEN is_black_friday THEN CAST(order_base_revenue AS DECIMAL(20,6)) END) AS _b,
             sum(CASE WHEN is_black_friday THEN CAST(order_profit AS DECIMAL(20,6)) END) AS _p,
             sum(CAST(order_profit AS DECIMAL(20,6))) AS _tp FROM o GROUP BY 1)
SELECT g.year, bf_orders, {O.ratio('CAST(_d AS DOUBLE)', 'CAST(_b AS DOUBLE)')} AS effective_discount_rate,
       {O.ratio('CAST(_p AS DOUBLE)', 'CAST(_tp AS DOUBLE)')} * 100 AS bf_profit_share_pct,
       {O.ratio('bf_orders', 'orders')} * 100 AS bf_order_share_pct, m.median_daily_orders
FROM g LEFT JOIN m USING (year) ORDER BY 1"""))
def q4g(spark, sf):
    return D.peak_day_audit(orders(spark, sf), P)


# ---------------------------------------------------------------- Q5 family
@register("q5e_line_segment_ranking", O.with_base("""
, g AS (SELECT customer_segment, count(DISTINCT buyer_id) AS buyers, count(*) AS lines,
               sum(line_net_revenue_before_shipping - line_cogs) AS _p, sum(line_net_revenue_before_shipping) AS _r,
               sum(CAST(quantity AS DECIMAL(20,6))) AS _q FROM line_priced GROUP BY 1)
SELECT customer_segment, buyers, lines, CAST(_p AS DOUBLE) / lines AS avg_line_profit, CAST(_p AS DOUBLE) AS total_profit,
       CAST(_r AS DOUBLE) AS total_revenue, CAST(_q AS DOUBLE) AS total_quantity,
       """ + O.ratio("CAST(_p AS DOUBLE)", "buyers") + " AS profit_per_customer, " + O.ratio("lines", "buyers") +
    """ AS lines_per_customer FROM g ORDER BY total_profit DESC"""))
def q5e(spark, sf):
    return D.line_segment_ranking(pipeline(spark, sf).priced_lines)


@register("q5f_state_share", O.with_base(f"""
SELECT *, buyers / sum(buyers) OVER () * 100 AS market_share_pct FROM (
  SELECT state, count(DISTINCT buyer_id) AS buyers, count(DISTINCT order_id) AS orders, {O.msum('order_profit')} AS total_profit
  FROM order_level GROUP BY 1) t ORDER BY buyers DESC, state LIMIT 10"""))
def q5f(spark, sf):
    return D.state_share(orders(spark, sf))


@register("q5g_best_segment_by_state", O.with_base(f"""
, best AS (SELECT customer_segment FROM order_level GROUP BY 1
           ORDER BY sum(CAST(order_profit AS DECIMAL(20,6))) DESC, customer_segment DESC LIMIT 1)
SELECT state, count(DISTINCT order_id) AS orders, {O.msum('order_profit')} AS total_profit,
       (SELECT customer_segment FROM best) AS customer_segment,
       CAST(row_number() OVER (ORDER BY {O.msum('order_profit')} DESC, state) AS INTEGER) AS rank
FROM order_level WHERE customer_segment = (SELECT customer_segment FROM best) GROUP BY state"""))
def q5g(spark, sf):
    return D.best_segment_by_state(orders(spark, sf))


@register("q5h_repeat_share_by_segment", O.with_base("""
SELECT customer_segment, avg(CAST(order_number > 1 AS DOUBLE)) * 100 AS repeat_share_pct, count(*) AS lines
FROM lines_max_amount GROUP BY 1 ORDER BY repeat_share_pct DESC, customer_segment"""))
def q5h(spark, sf):
    return D.repeat_share_by_segment(lines_max_amount(pipeline(spark, sf)))


@register("q5i_active_buyer_growth", O.with_base(f"""
SELECT customer_segment, arg_min(active_buyers, quarter) AS first_quarter_buyers, arg_max(active_buyers, quarter) AS last_quarter_buyers,
       min(quarter) AS first_quarter, max(quarter) AS last_quarter,
       round(CASE WHEN arg_min(active_buyers, quarter) > 0 THEN
         CAST(arg_max(active_buyers, quarter) - arg_min(active_buyers, quarter) AS DOUBLE) / CAST(arg_min(active_buyers, quarter) AS DOUBLE) END * 100, 8) AS growth_pct
FROM (SELECT customer_segment, quarter, count(DISTINCT buyer_id) AS active_buyers FROM ow GROUP BY 1, 2) t
GROUP BY 1 ORDER BY 1"""))
def q5i(spark, sf):
    return D.active_buyer_growth(orders(spark, sf), P)


# Driver states are NATION_<n>, not two-letter codes: the code pattern is a parameter.
STATE_PATTERN = r"^[A-Z0-9_]+$"


@register("q5j_state_value", O.with_base(f"""
SELECT *, {O.ratio('total_profit', 'buyers')} AS profit_per_customer, {O.ratio('total_profit', 'orders')} AS profit_per_order
FROM (SELECT upper(trim(state)) AS state, count(DISTINCT buyer_id) AS buyers, count(DISTINCT order_id) AS orders,
             {O.msum('order_profit')} AS total_profit FROM order_level
      WHERE regexp_matches(upper(trim(state)), '{STATE_PATTERN}') GROUP BY 1) t ORDER BY total_profit DESC"""))
def q5j(spark, sf):
    return D.state_value(orders(spark, sf), STATE_PATTERN)


@register("q5c_segment_quadrants", O.with_base(f"""
, s AS (SELECT customer_segment, {O.q('order_profit', 0.5)} AS m, count(DISTINCT order_id) AS n,
               {O.msum('order_profit')} AS total_profit FROM ow GROUP BY 1),
t AS (SELECT *, m >= quantile_cont(m, 0.5) OVER () AS hx, n >= quantile_cont(n, 0.5) OVER () AS hy FROM s)
SELECT CASE WHEN hx AND hy THEN 'Defend and Scale' WHEN NOT hx AND hy THEN 'High Demand, Improve Margin'
            WHEN hx AND NOT hy THEN 'Niche Premium' ELSE 'Low Priority' END AS quadrant,
       list(customer_segment ORDER BY total_profit DESC, customer_segment) AS segments, count(*) AS n_segments
FROM t GROUP BY 1 ORDER BY 1"""))
def q5c(spark, sf):
    return D.segment_quadrants(M.segment_kpis(orders(spark, sf), P))


@register("q5d_bucket_rollup", O.with_base(f"""
, {Q5} , g AS (
  SELECT strategic_bucket, count(*) AS segments, {O.msum('total_profit')} AS total_profit, {O.msum('total_revenue')} AS total_revenue,
         {O.msum('total_cogs')} AS total_cogs, {O.msum('total_discounts')} AS total_discounts,
         CAST(sum(order_count) AS BIGINT) AS orders, CAST(sum(unique_customers) AS BIGINT) AS customers,
         round(avg(median_profit_per_order), 8) AS mean_margin_per_order,
         round(avg(orders_per_customer), 8) AS mean_orders_per_customer,
         round(avg(CASE WHEN total_revenue > 0 THEN total_discounts / total_revenue ELSE 0 END * 100), 8) AS mean_discount_pct,
         round(avg(CASE WHEN total_revenue > 0 THEN total_cogs / total_revenue ELSE 0 END * 100), 8) AS mean_cogs_pct
  FROM q5 GROUP BY 1)
SELECT *, round(total_profit / sum(total_profit) OVER () * 100, 8) AS profit_share_pct,
       round({O.ratio('total_revenue - total_cogs', 'total_revenue')} * 100, 8) AS pooled_margin_pct,
       {O.ratio('orders', 'customers')} AS pooled_orders_per_customer FROM g ORDER BY total_profit DESC"""))
def q5d(spark, sf):
    return D.bucket_rollup(M.segment_kpis(orders(spark, sf), P))


@register("q5d2_top_segments", O.with_base(f"""
, {Q5} SELECT customer_segment, strategic_bucket, total_profit, unique_customers,
       round(total_profit / (SELECT sum(total_profit) FROM q5) * 100, 8) AS profit_share_pct,
       round(unique_customers / (SELECT sum(unique_customers) FROM q5) * 100, 8) AS customer_share_pct
FROM q5 ORDER BY total_profit DESC, customer_segment LIMIT 3"""))
def q5d2(spark, sf):
    return D.top_segments(M.segment_kpis(orders(spark, sf), P))


# ---------------------------------------------------------------- pricing variants
@register("pr9_stacked_orders", O.with_base(O.variant_orders_sql("stacked", "base") + "SELECT * FROM order_level_v"))
def pr9(spark, sf):
    p = pipeline(spark, sf)
    priced = OP.apply_discounts(OP.flag_first_orders(p.order_lines), P, "stacked")
    return OP.roll_up_orders(priced, P)


@register("pr12_net_basis_orders", O.with_base(O.variant_orders_sql("max", "net") + "SELECT * FROM order_level_v"))
def pr12(spark, sf):
    return OP.roll_up_orders(pipeline(spark, sf).priced_lines, P, shipping_basis="net")


@register("pr10_lines_max_amount", O.with_base("""
SELECT order_id, buyer_id, sku_id, order_number, CAST(referral_discount_amount AS DOUBLE) AS referral_discount_amount,
       CAST(black_friday_discount_amount AS DOUBLE) AS black_friday_discount_amount, CAST(revenue AS DOUBLE) AS revenue,
       CAST(cost AS DOUBLE) AS cost, CAST(profit AS DOUBLE) AS profit FROM lines_max_amount"""))
def pr10(spark, sf):
    from pyspark.sql import functions as F
    d = lines_max_amount(pipeline(spark, sf))
    return d.select("order_id", "buyer_id", "sku_id", "order_number",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("referral_discount_amount", "black_friday_discount_amount", "revenue", "cost", "profit")])


@register("pr17_buyer_order_rollup", O.with_base("""
SELECT order_id, buyer_id, min(order_datetime_company) AS order_datetime_company, min(customer_segment) AS customer_segment,
       max(is_referred) AS is_referred, CAST(sum(line_base_revenue) AS DOUBLE) AS order_base_revenue,
       CAST(sum(line_net_revenue_before_shipping) AS DOUBLE) AS order_net_revenue, CAST(sum(line_cogs) AS DOUBLE) AS order_cogs
FROM line_priced GROUP BY 1, 2"""))
def pr17(spark, sf):
    return OP.roll_up_buyer_orders(pipeline(spark, sf).priced_lines)


@register("pr18_peak_order_rollup", O.with_base(f"""
SELECT order_id, customer_segment, CAST(sum(line_base_revenue) AS DOUBLE) AS base_revenue,
       CAST(sum(line_base_revenue) * {1 - P.black_friday_discount_rate:.2f} AS DOUBLE) AS net_revenue
FROM line_priced WHERE is_black_friday GROUP BY 1, 2"""))
def pr18(spark, sf):
    return OP.roll_up_peak_orders(pipeline(spark, sf).priced_lines, P.black_friday_discount_rate)
