"""Pricing rules and the order roll-up (PR1-PR18)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType

from orderlens.functions.numeric import MONEY, SUM_TYPE, dec, try_num
from orderlens.functions.timefn import SALES_TS_FORMATS, holiday_date, parse_ts, quarter_label, with_company_ts
from orderlens.operators.common import group_lookup
from orderlens.params import Params

ORDER_KEYS = ["order_id", "buyer_id", "customer_segment", "state", "region"]
ORDER_COLUMNS = [
    "order_id", "buyer_id", "customer_segment", "state", "region", "order_datetime_company",
    "is_referred", "is_first_order", "is_black_friday", "order_base_revenue",
    "order_net_revenue_before_shipping", "order_cogs", "referral_discount_amount",
    "black_friday_discount_amount", "customer_shipping_fee", "company_shipping_cost",
    "order_revenue", "order_profit", "year", "quarter", "hour_company", "is_referral_discount",
]
MONEY_COLUMNS = [
    "order_base_revenue", "order_net_revenue_before_shipping", "order_cogs", "referral_discount_amount",
    "black_friday_discount_amount", "customer_shipping_fee", "company_shipping_cost", "order_revenue",
    "order_profit",
]


# What pricing, the roll-ups and PR10 read of a line.
LINE_AMOUNT_COLUMNS = [
    "order_id", "buyer_id", "sku_id", "customer_segment", "state", "region", "is_referred", "order_datetime", "price",
    "quantity", "margin", "order_datetime_company", "line_base_revenue", "line_cogs", "is_black_friday", "_usable",
]


# What PR10 reads of a line, and its readers of the PR10 table.
PR10_COLUMNS = ["order_id", "buyer_id", "sku_id", "customer_segment", "is_referred", "order_datetime", "margin",
                "line_base_revenue", "is_black_friday"]


def _d(x) -> F.Column:
    return F.lit(Decimal(repr(float(x))))


def _ts(df: DataFrame, col: str) -> F.Column:
    if isinstance(df.schema[col].dataType, StringType):
        return parse_ts(col, SALES_TS_FORMATS)
    return F.col(col).cast("timestamp_ntz")


def _num(df: DataFrame, col: str) -> F.Column:
    """``try_num``; a column that is a double already is not written out as text and read again."""
    if isinstance(df.schema[col].dataType, DoubleType):
        return F.when(F.abs(col) < F.lit(float("inf")), F.col(col))          # NaN is above infinity
    return try_num(col)


def prepare_lines(lines: DataFrame, params: Params = Params()) -> DataFrame:
    """PR1-PR6: typing, company time, sanity year, line money, holiday flag."""
    return usable_lines(add_line_values(lines, params))


def add_line_values(lines: DataFrame, params: Params = Params()) -> DataFrame:
    """Every line, as it is, with order_datetime_company, line_base_revenue, line_cogs, is_black_friday, and
    ``_usable``: whether PR1-PR3 keep it."""
    held = lines.columns
    df = lines.withColumns({"_ts": _ts(lines, "order_datetime"), "_price": _num(lines, "price"), "_quantity": _num(lines, "quantity"),
                            "_margin": _num(lines, "margin")})
    tz = "timezone" if "timezone" in held else None
    df = with_company_ts(df, "_ts", tz, params.company_timezone)               # PR2
    ts = F.col("order_datetime_company")
    rev = F.col("_price") * F.col("_quantity")                                  # PR4
    return df.select(
        *held, "order_datetime_company", dec(rev).alias("line_base_revenue"),
        dec(rev * (F.lit(1.0) - F.col("_margin"))).alias("line_cogs"),
        (F.to_date(ts) == holiday_date(F.year(ts))).alias("is_black_friday"),   # PR5, PR6
        (F.col("_ts").isNotNull() & F.col("_price").isNotNull() & F.col("_quantity").isNotNull() & F.col("_margin").isNotNull()
         & ts.isNotNull() & F.coalesce(F.year(ts) >= params.line_min_year, F.lit(False))).alias("_usable"))      # PR1, PR3


def usable_lines(df: DataFrame) -> DataFrame:
    """Typed lines that PR1-PR3 keep, of a table with line values."""
    return df.where("_usable").withColumns({                                    # PR1
        "order_datetime": _ts(df, "order_datetime"), "price": _num(df, "price"), "quantity": _num(df, "quantity"),
        "margin": _num(df, "margin"), "is_referred": F.coalesce(try_num("is_referred"), F.lit(0.0)).cast("int")}).drop("_usable")


def flag_first_orders(df: DataFrame, ts: str = "order_datetime_company") -> DataFrame:
    """PR7: every line at its buyer's earliest timestamp is a first order.

    Per-buyer minimum as partial+final aggregate joined back (skew-safe),
    not a window over the buyer (a hot buyer would be one task).
    """
    first = df.groupBy("buyer_id").agg(F.min(ts).alias("_first_ts"))
    return group_lookup(df, "buyer_id", first, "inner") \
        .withColumn("is_first_order", F.col(ts) == F.col("_first_ts")).drop("_first_ts")


def apply_discounts(df: DataFrame, params: Params = Params(), policy: str = "max") -> DataFrame:
    """PR8 (``max``) / PR9 (``stacked``) line discounts, exact fixed-point."""
    rev = F.col("line_base_revenue")
    ref = F.when((F.col("is_referred") == 1) & F.col("is_first_order"),
                 _d(params.referral_discount_rate)).otherwise(_d(0))
    bf = F.when(F.col("is_black_friday"), _d(params.black_friday_discount_rate)).otherwise(_d(0))
    df = df.withColumns({"ref_disc_rate": ref, "bf_disc_rate": bf})
    ref, bf = F.col("ref_disc_rate"), F.col("bf_disc_rate")
    one = _d(1)
    if policy == "max":
        net = rev * (one - F.greatest(ref, bf))
        ref_amt = rev * F.when(ref >= bf, ref).otherwise(_d(0))
        bf_amt = rev * F.when(bf > ref, bf).otherwise(_d(0))
    elif policy == "stacked":
        net = rev * (one - ref) * (one - bf)
        ref_amt = rev * ref
        bf_amt = rev * (one - ref) * bf
    else:
        raise ValueError(f"unknown discount policy {policy!r}")
    return df.withColumns({
        "discount_rate": F.greatest(ref, bf) if policy == "max" else one - (one - ref) * (one - bf),
        "line_referral_discount": ref_amt.cast(MONEY),
        "line_black_friday_discount": bf_amt.cast(MONEY),
        "line_net_revenue_before_shipping": net.cast(MONEY)})


def shipping_fee(basis: F.Column, params: Params = Params()) -> F.Column:
    """PR12: tiered fee."""
    return (F.when(basis < _d(params.shipping_threshold_1), _d(params.shipping_fee_low))
             .when(basis < _d(params.shipping_threshold_2), _d(params.shipping_fee_mid))
             .otherwise(_d(params.shipping_fee_high))).cast(MONEY)


def roll_up_orders(lines: DataFrame, params: Params = Params(), shipping_basis: str = "base",
                   year_band: bool = True) -> DataFrame:
    """PR11-PR15 on priced lines."""
    keyed = lines.where(F.col("order_id").isNotNull() & F.col("buyer_id").isNotNull()
                        & F.col("customer_segment").isNotNull() & F.col("state").isNotNull()
                        & F.col("region").isNotNull())
    o = keyed.groupBy(*ORDER_KEYS).agg(                                          # PR11
        F.min("order_datetime_company").alias("order_datetime_company"),
        F.max("is_referred").alias("is_referred"),
        F.bool_or("is_first_order").alias("is_first_order"),
        F.bool_or("is_black_friday").alias("is_black_friday"),
        F.sum("line_base_revenue").cast(SUM_TYPE).alias("order_base_revenue"),
        F.sum("line_net_revenue_before_shipping").cast(SUM_TYPE).alias("order_net_revenue_before_shipping"),
        F.sum("line_cogs").cast(SUM_TYPE).alias("order_cogs"),
        F.sum("line_referral_discount").cast(SUM_TYPE).alias("referral_discount_amount"),
        F.sum("line_black_friday_discount").cast(SUM_TYPE).alias("black_friday_discount_amount"),
    )
    basis = F.col("order_base_revenue" if shipping_basis == "base" else "order_net_revenue_before_shipping")
    ts = F.col("order_datetime_company")
    fee = shipping_fee(basis, params)                                            # PR12
    cost = _d(params.company_shipping_cost).cast(MONEY)
    revenue = F.col("order_net_revenue_before_shipping") + fee                   # PR13
    o = o.withColumns({
        "customer_shipping_fee": fee,
        "company_shipping_cost": cost,
        "order_revenue": revenue,
        "order_profit": revenue - F.col("order_cogs") - cost,
        "year": F.year(ts),                                                      # PR14
        "quarter": quarter_label(ts),
        "hour_company": F.hour(ts),
        "is_referral_discount": F.col("referral_discount_amount") > 0})
    if year_band:
        lo, hi = params.order_year_band
        o = o.where(F.col("year").between(lo, hi))                               # PR15
    return o.select(*[F.col(c).cast("double").alias(c) if c in MONEY_COLUMNS else F.col(c) for c in ORDER_COLUMNS])


def build_orders(lines: DataFrame, params: Params = Params(), policy: str = "max",
                 shipping_basis: str = "base") -> DataFrame:
    """PR16: line fact -> order-level table (22 columns)."""
    priced = apply_discounts(flag_first_orders(prepare_lines(lines, params)), params, policy)
    return roll_up_orders(priced, params, shipping_basis)


def year_distribution(orders_unfiltered: DataFrame) -> DataFrame:
    """PR15 side output: order count per year, before the year band drops any."""
    return orders_unfiltered.groupBy("year").agg(F.count(F.lit(1)).alias("orders")).orderBy("year")


def lines_max_amount(lines: DataFrame, params: Params = Params(), fee: float = 4.99) -> DataFrame:
    """PR10: per-line discount = max(referral on the buyer's first line, holiday);
    the flat fee is both charged and paid.  First line = rank 1 by (time, order, sku)."""
    return lines_max_amount_from_prepared(prepare_lines(lines, params), params, fee)


def lines_max_amount_from_prepared(df: DataFrame, params: Params = Params(), fee: float = 4.99) -> DataFrame:
    from orderlens.operators.running import running_rank_sum

    rev = F.col("line_base_revenue")
    # buyer line number by (time, order, sku): distributed prefix scan, not a window over the buyer
    df = running_rank_sum(df, "buyer_id", ["order_datetime", "order_id", "sku_id"], None, rank_col="order_number")
    ref_amt = F.when((F.col("is_referred") == 1) & (F.col("order_number") == 1),
                     rev * _d(params.referral_discount_rate)).otherwise(_d(0))
    bf_amt = F.when(F.col("is_black_friday"), rev * _d(params.black_friday_discount_rate)).otherwise(_d(0))
    cost = dec(F.col("line_base_revenue").cast("double") * (F.lit(1.0) - F.coalesce("margin", F.lit(0.0))))
    return (df.withColumn("referral_discount_amount", ref_amt.cast(MONEY))
              .withColumn("black_friday_discount_amount", bf_amt.cast(MONEY))
              .withColumn("total_discount", F.greatest("referral_discount_amount", "black_friday_discount_amount"))
              .withColumn("revenue", (rev - F.col("total_discount") + _d(fee)).cast(MONEY))
              .withColumn("cost", cost)
              .withColumn("profit", (F.col("revenue") - F.col("cost") - _d(fee)).cast(MONEY)))


def roll_up_buyer_orders(lines_priced: DataFrame) -> DataFrame:
    """PR17: (order, buyer) roll-up with the smallest segment and max referred."""
    return lines_priced.groupBy("order_id", "buyer_id").agg(
        F.min("order_datetime_company").alias("order_datetime_company"),
        F.min("customer_segment").alias("customer_segment"),
        F.max("is_referred").alias("is_referred"),
        F.sum("line_base_revenue").cast("double").alias("order_base_revenue"),
        F.sum("line_net_revenue_before_shipping").cast("double").alias("order_net_revenue"),
        F.sum("line_cogs").cast("double").alias("order_cogs"),
    )


def roll_up_peak_orders(lines_priced: DataFrame, peak_rate: float = 0.20) -> DataFrame:
    """PR18: holiday-only (order, segment) roll-up: base and discounted revenue."""
    bf = lines_priced.where(F.col("is_black_friday"))
    return bf.groupBy("order_id", "customer_segment").agg(
        F.sum("line_base_revenue").cast("double").alias("base_revenue"),
        (F.sum("line_base_revenue") * _d(1 - peak_rate)).cast("double").alias("net_revenue"),
    )
