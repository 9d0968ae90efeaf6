"""Independent SQL text (DuckDB dialect) for every catalog query.

It re-states the pipeline on the driver's star schema from the raw testbed
mapping on, so the Spark operators can be checked against a second engine.
The chain is plain CTEs; each query appends its own final SELECT.
"""

from __future__ import annotations

from orderlens.params import TESTBED, Params
from orderlens.sources.testbed import testbed_ctes

WS = r"'^\s+|\s+$'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {WS}, '', 'g')"


def squeeze(c: str) -> str:
    return f"regexp_replace({strip(c)}, '\\s+', ' ', 'g')"


def num(c: str) -> str:
    """Finite double of a text; DuckDB's own cast takes NaN and infinities."""
    return f"CASE WHEN isfinite(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END"


def money(c: str) -> str:
    return f"CAST({c} AS DECIMAL(20,6))"


def msum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(20,6))) AS DOUBLE)"


def mean(c: str, scale: int = 6) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(30,{scale}))) AS DOUBLE) / COUNT({c})"


def q(c: str, p: float) -> str:
    return f"round(quantile_cont({c}, {p}), 8)"


def ratio(n: str, d: str) -> str:
    return f"(CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE 0.0 END)"


def holiday(y: str) -> str:
    nov1 = f"make_date(CAST({y} AS INTEGER), 11, 1)"
    return f"({nov1} + CAST((4 - dayofweek({nov1}) + 7) % 7 AS INTEGER) + 22)"


def parse_sales_ts(c: str) -> tuple[str, str]:
    s = strip(c)
    fmts = ["%m/%d/%y %H:%M", "%m/%d/%Y %H:%M", "%Y-%m-%d %H:%M:%S", "%m/%d/%y %H:%M:%S", "%m/%d/%Y %H:%M:%S"]
    parts = [f"try_strptime({s}, '{f}')" for f in fmts]
    branch = "CASE " + " ".join(f"WHEN {p} IS NOT NULL THEN {i}" for i, p in enumerate(parts)) + " END"
    return f"coalesce({', '.join(parts)})", branch


def company_ts(local: str, tz: str, company: str) -> str:
    z = f"coalesce({tz}, '{company}')"
    u = f"timezone({z}, {local})"
    back = lambda shift: f"timezone({z}, {u}{shift})"
    bad = (f"{back('')} <> {local} OR {back(' + INTERVAL 60 MINUTE')} = {local} OR "
           f"{back(' - INTERVAL 60 MINUTE')} = {local} OR {back(' + INTERVAL 30 MINUTE')} = {local} OR "
           f"{back(' - INTERVAL 30 MINUTE')} = {local}")
    return f"CASE WHEN {bad} THEN NULL ELSE timezone('{company}', {u}) END"


def base_ctes(p: Params = TESTBED) -> str:
    ts, branch = parse_sales_ts("order_datetime_raw")
    ref, bf = Params.dec(p.referral_discount_rate), Params.dec(p.black_friday_discount_rate)
    return f"""{testbed_ctes()},
s1 AS (
  SELECT {strip('order_id')} AS order_id, {strip('buyer_id')} AS buyer_id, {strip('sku_id')} AS sku_id,
         quantity, order_datetime AS order_datetime_raw,
         CASE WHEN order_status = 'Deliverred' THEN 'Delivered' ELSE order_status END AS order_status, _ord
  FROM sales_raw),
s2 AS (
  SELECT * EXCLUDE (order_datetime_raw), {ts} AS order_datetime, {branch} AS _ts_branch
  FROM s1 WHERE order_status IS NOT NULL AND order_id IS NOT NULL AND buyer_id IS NOT NULL AND sku_id IS NOT NULL),
s3 AS (
  SELECT * EXCLUDE (quantity), {num('quantity')} AS quantity FROM s2 WHERE order_datetime IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id, buyer_id, sku_id ORDER BY _ord) = 1),
s4 AS (SELECT * FROM s3 WHERE quantity > 0),
qcap AS (SELECT greatest({p.quantity_cap_floor}, coalesce(CAST(floor(quantile_cont(quantity, {p.quantity_cap_quantile})) AS DOUBLE), {p.quantity_cap_floor})) AS cap FROM s4),
sales_clean AS (
  SELECT order_id, buyer_id, upper({strip('sku_id')}) AS sku_id, order_status, order_datetime, _ord,
         least(quantity, (SELECT cap FROM qcap)) AS quantity, quantity AS quantity_original,
         quantity > (SELECT cap FROM qcap) AS quantity_was_capped, (SELECT cap FROM qcap) AS quantity_cap_value
  FROM s4),
p1 AS (
  SELECT {squeeze('subcategory_id')} AS subcategory_id, {squeeze('vendor')} AS vendor,
         {squeeze('product_num')} AS product_num, {squeeze('category_name')} AS category_name,
         upper({strip('sku_id')}) AS sku_id,
         TRY_CAST(replace(CAST(price AS STRING), '$', '') AS DOUBLE) AS price,
         coalesce(TRY_CAST(profit_margin AS DOUBLE), TRY_CAST(pct_profit_margin AS DOUBLE) / 100) AS margin,
         active_product, currently_active_vendor, current_stock
  FROM products_raw),
pmean AS (SELECT subcategory_id, {mean('margin', 10)} AS m FROM p1
          WHERE subcategory_id IS NOT NULL AND margin IS NOT NULL GROUP BY subcategory_id),
products_clean AS (
  SELECT p1.* EXCLUDE (margin), coalesce(p1.margin, pmean.m) AS margin,
         p1.margin IS NULL AND coalesce(p1.margin, pmean.m) IS NOT NULL AS margin_imputed
  FROM p1 LEFT JOIN pmean USING (subcategory_id)),
b1 AS (
  SELECT {strip('buyer_id')} AS buyer_id, customer_group, customer_segment, preferred_channel,
         try_strptime({strip('signup_date')}, '%m/%d/%y %H:%M') AS signup_date,
         region, state, timezone, is_referred, TRY_CAST(wishlist_size AS INTEGER) AS wishlist_size, _ord
  FROM buyers_raw),
tzc AS (SELECT state, timezone, count(*) AS c FROM b1 WHERE state IS NOT NULL AND timezone IS NOT NULL GROUP BY ALL),
tzm AS (SELECT state, timezone AS tz_mode FROM tzc QUALIFY row_number() OVER (PARTITION BY state ORDER BY c DESC, timezone) = 1),
rgc AS (SELECT state, region, count(*) AS c FROM b1 WHERE state IS NOT NULL AND region IS NOT NULL GROUP BY ALL),
rgm AS (SELECT state, region AS region_mode FROM rgc QUALIFY row_number() OVER (PARTITION BY state ORDER BY c DESC, region) = 1),
b2 AS (
  SELECT b1.* EXCLUDE (timezone, region), coalesce(b1.timezone, tzm.tz_mode) AS timezone,
         coalesce(b1.region, rgm.region_mode) AS region
  FROM b1 LEFT JOIN tzm USING (state) LEFT JOIN rgm USING (state) WHERE b1.buyer_id IS NOT NULL),
first_sale AS (SELECT buyer_id, min(order_datetime) AS first_order_datetime FROM sales_clean GROUP BY buyer_id),
b3 AS (
  SELECT b2.* EXCLUDE (signup_date), coalesce(b2.signup_date, f.first_order_datetime) AS signup_date
  FROM b2 {'JOIN' if p.buyers_coverage_filter else 'LEFT JOIN'} first_sale f USING (buyer_id)),
b4 AS (
  SELECT * FROM b3
  QUALIFY row_number() OVER (PARTITION BY buyer_id ORDER BY
     (CAST(signup_date IS NOT NULL AS INTEGER) + CAST(region IS NOT NULL AS INTEGER)
      + CAST(timezone IS NOT NULL AS INTEGER) + CAST(state IS NOT NULL AS INTEGER)) DESC, _ord) = 1),
buyers_clean AS (
  SELECT * EXCLUDE (is_referred),
         NOT coalesce(TRY_CAST(is_referred AS DOUBLE) IN (0, 1), false) AS is_referred_invalid,
         CASE WHEN coalesce(TRY_CAST(is_referred AS DOUBLE) IN (0, 1), false)
              THEN CAST(TRY_CAST(is_referred AS DOUBLE) AS INTEGER) END AS is_referred
  FROM b4),
line_fact AS (
  SELECT s.* EXCLUDE (buyer_id, sku_id, _ord), upper({strip('s.buyer_id')}) AS buyer_id, upper({strip('s.sku_id')}) AS sku_id,
         b.* EXCLUDE (buyer_id, _ord), pr.* EXCLUDE (sku_id)
  FROM sales_clean s
  JOIN buyers_clean b ON upper({strip('s.buyer_id')}) = upper({strip('b.buyer_id')})
  JOIN products_clean pr ON upper({strip('s.sku_id')}) = upper({strip('pr.sku_id')})),
l1 AS (
  SELECT * EXCLUDE (is_referred), CAST(coalesce(TRY_CAST(is_referred AS DOUBLE), 0) AS INTEGER) AS is_referred,
         {company_ts('order_datetime', 'timezone', p.company_timezone)} AS order_datetime_company
  FROM line_fact WHERE order_datetime IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL AND margin IS NOT NULL),
l2 AS (
  SELECT *, CAST(price * quantity AS DECIMAL(20,6)) AS line_base_revenue,
         CAST(price * quantity * (1.0 - margin) AS DECIMAL(20,6)) AS line_cogs,
         CAST(order_datetime_company AS DATE) = {holiday('year(order_datetime_company)')} AS is_black_friday
  FROM l1 WHERE order_datetime_company IS NOT NULL AND year(order_datetime_company) >= {p.line_min_year}),
l3 AS (
  SELECT l2.*, l2.order_datetime_company = f.ft AS is_first_order
  FROM l2 JOIN (SELECT buyer_id, min(order_datetime_company) AS ft FROM l2 GROUP BY buyer_id) f USING (buyer_id)),
l4 AS (
  SELECT *, CASE WHEN is_referred = 1 AND is_first_order THEN {ref} ELSE 0 END AS ref_rate,
         CASE WHEN is_black_friday THEN {bf} ELSE 0 END AS bf_rate
  FROM l3),
line_priced AS (
  SELECT *, CAST(line_base_revenue * (1 - greatest(ref_rate, bf_rate)) AS DECIMAL(20,6)) AS line_net_revenue_before_shipping,
         CAST(line_base_revenue * CASE WHEN ref_rate >= bf_rate THEN ref_rate ELSE 0 END AS DECIMAL(20,6)) AS line_referral_discount,
         CAST(line_base_revenue * CASE WHEN bf_rate > ref_rate THEN bf_rate ELSE 0 END AS DECIMAL(20,6)) AS line_black_friday_discount
  FROM l4),
o1 AS (
  SELECT order_id, buyer_id, customer_segment, state, region,
         min(order_datetime_company) AS order_datetime_company, max(is_referred) AS is_referred,
         bool_or(is_first_order) AS is_first_order, bool_or(is_black_friday) AS is_black_friday,
         SUM(line_base_revenue) AS b, SUM(line_net_revenue_before_shipping) AS n, SUM(line_cogs) AS c,
         SUM(line_referral_discount) AS r, SUM(line_black_friday_discount) AS f
  FROM line_priced
  WHERE order_id IS NOT NULL AND buyer_id IS NOT NULL AND customer_segment IS NOT NULL AND state IS NOT NULL AND region IS NOT NULL
  GROUP BY order_id, buyer_id, customer_segment, state, region),
o2 AS (
  SELECT *, CAST(CASE WHEN b < {Params.dec(p.shipping_threshold_1)} THEN {Params.dec(p.shipping_fee_low)}
                      WHEN b < {Params.dec(p.shipping_threshold_2)} THEN {Params.dec(p.shipping_fee_mid)}
                      ELSE {Params.dec(p.shipping_fee_high)} END AS DECIMAL(20,6)) AS fee,
         CAST({Params.dec(p.company_shipping_cost)} AS DECIMAL(20,6)) AS ship
  FROM o1),
order_level AS (
  SELECT order_id, buyer_id, customer_segment, state, region, order_datetime_company, is_referred,
         is_first_order, is_black_friday, CAST(b AS DOUBLE) AS order_base_revenue,
         CAST(n AS DOUBLE) AS order_net_revenue_before_shipping, CAST(c AS DOUBLE) AS order_cogs,
         CAST(r AS DOUBLE) AS referral_discount_amount, CAST(f AS DOUBLE) AS black_friday_discount_amount,
         CAST(fee AS DOUBLE) AS customer_shipping_fee, CAST(ship AS DOUBLE) AS company_shipping_cost,
         CAST(n + fee AS DOUBLE) AS order_revenue, CAST(n + fee - c - ship AS DOUBLE) AS order_profit,
         CAST(year(order_datetime_company) AS INTEGER) AS year,
         CAST(year(order_datetime_company) AS STRING) || 'Q' || CAST(quarter(order_datetime_company) AS STRING) AS quarter,
         CAST(hour(order_datetime_company) AS INTEGER) AS hour_company, r > 0 AS is_referral_discount
  FROM o2
  WHERE year(order_datetime_company) BETWEEN {p.order_year_band[0]} AND {p.order_year_band[1]}),
ow AS (SELECT * FROM order_level WHERE year BETWEEN {p.metric_years[0]} AND {p.metric_years[1]}),
pr10a AS (SELECT *, CAST(row_number() OVER (PARTITION BY buyer_id ORDER BY order_datetime, order_id, sku_id) AS INTEGER) AS order_number FROM l2),
pr10b AS (
  SELECT *, CAST(CASE WHEN is_referred = 1 AND order_number = 1 THEN line_base_revenue * {ref} ELSE 0 END AS DECIMAL(20,6)) AS referral_discount_amount,
         CAST(CASE WHEN is_black_friday THEN line_base_revenue * {bf} ELSE 0 END AS DECIMAL(20,6)) AS black_friday_discount_amount
  FROM pr10a),
lines_max_amount AS (
  SELECT *, greatest(referral_discount_amount, black_friday_discount_amount) AS total_discount,
         CAST(line_base_revenue - greatest(referral_discount_amount, black_friday_discount_amount) + 4.99 AS DECIMAL(20,6)) AS revenue,
         CAST(CAST(line_base_revenue AS DOUBLE) * (1.0 - coalesce(margin, 0.0)) AS DECIMAL(20,6)) AS cost,
         CAST(CAST(line_base_revenue - greatest(referral_discount_amount, black_friday_discount_amount) + 4.99 AS DECIMAL(20,6))
              - CAST(CAST(line_base_revenue AS DOUBLE) * (1.0 - coalesce(margin, 0.0)) AS DECIMAL(20,6)) - 4.99 AS DECIMAL(20,6)) AS profit
  FROM pr10b)"""


def with_base(select: str, p: Params = TESTBED) -> str:
    return f"WITH {base_ctes(p)}\n{select}"


def variant_orders_sql(policy: str, basis: str, p: Params = TESTBED) -> str:
    """Extra CTEs ``order_level_v`` for a discount policy / shipping basis variant."""
    ref, bf = Params.dec(p.referral_discount_rate), Params.dec(p.black_friday_discount_rate)
    if policy == "stacked":
        amounts = (f"CAST(line_base_revenue * (1 - ref_rate) * (1 - bf_rate) AS DECIMAL(20,6)) AS line_net_revenue_before_shipping, "
                   f"CAST(line_base_revenue * ref_rate AS DECIMAL(20,6)) AS line_referral_discount, "
                   f"CAST(line_base_revenue * (1 - ref_rate) * bf_rate AS DECIMAL(20,6)) AS line_black_friday_discount")
    else:
        amounts = (f"CAST(line_base_revenue * (1 - greatest(ref_rate, bf_rate)) AS DECIMAL(20,6)) AS line_net_revenue_before_shipping, "
                   f"CAST(line_base_revenue * CASE WHEN ref_rate >= bf_rate THEN ref_rate ELSE 0 END AS DECIMAL(20,6)) AS line_referral_discount, "
                   f"CAST(line_base_revenue * CASE WHEN bf_rate > ref_rate THEN bf_rate ELSE 0 END AS DECIMAL(20,6)) AS line_black_friday_discount")
    fee_basis = "b" if basis == "base" else "n"
    return f""", lpv AS (SELECT *, {amounts} FROM l4),
o1v AS (
  SELECT order_id, buyer_id, customer_segment, state, region,
         min(order_datetime_company) AS order_datetime_company, max(is_referred) AS is_referred,
         bool_or(is_first_order) AS is_first_order, bool_or(is_black_friday) AS is_black_friday,
         SUM(line_base_revenue) AS b, SUM(line_net_revenue_before_shipping) AS n, SUM(line_cogs) AS c,
         SUM(line_referral_discount) AS r, SUM(line_black_friday_discount) AS f
  FROM lpv
  WHERE order_id IS NOT NULL AND buyer_id IS NOT NULL AND customer_segment IS NOT NULL AND state IS NOT NULL AND region IS NOT NULL
  GROUP BY order_id, buyer_id, customer_segment, state, region),
o2v AS (
  SELECT *, CAST(CASE WHEN {fee_basis} < {Params.dec(p.shipping_threshold_1)} THEN {Params.dec(p.shipping_fee_low)}
                      WHEN {fee_basis} < {Params.dec(p.shipping_threshold_2)} THEN {Params.dec(p.shipping_fee_mid)}
                      ELSE {Params.dec(p.shipping_fee_high)} END AS DECIMAL(20,6)) AS fee,
         CAST({Params.dec(p.company_shipping_cost)} AS DECIMAL(20,6)) AS ship
  FROM o1v),
order_level_v AS (
  SELECT order_id, buyer_id, customer_segment, state, region, order_datetime_company, is_referred,
         is_first_order, is_black_friday, CAST(b AS DOUBLE) AS order_base_revenue,
         CAST(n AS DOUBLE) AS order_net_revenue_before_shipping, CAST(c AS DOUBLE) AS order_cogs,
         CAST(r AS DOUBLE) AS referral_discount_amount, CAST(f AS DOUBLE) AS black_friday_discount_amount,
         CAST(fee AS DOUBLE) AS customer_shipping_fee, CAST(ship AS DOUBLE) AS company_shipping_cost,
         CAST(n + fee AS DOUBLE) AS order_revenue, CAST(n + fee - c - ship AS DOUBLE) AS order_profit,
         CAST(year(order_datetime_company) AS INTEGER) AS year,
         CAST(year(order_datetime_company) AS STRING) || 'Q' || CAST(quarter(order_datetime_company) AS STRING) AS quarter,
         CAST(hour(order_datetime_company) AS INTEGER) AS hour_company, r > 0 AS is_referral_discount
  FROM o2v
  WHERE year(order_datetime_company) BETWEEN {p.order_year_band[0]} AND {p.order_year_band[1]})
"""
