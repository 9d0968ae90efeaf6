"""Pricing rules and the order roll-up on a hand-checked line fixture."""

import datetime as dt

import pytest

from orderlens.operators import orders as O
from orderlens.params import Params

LINE_SCHEMA = ("order_id string, buyer_id string, sku_id string, customer_segment string, state string, region string, "
               "timezone string, is_referred int, order_datetime timestamp_ntz, price double, quantity double, margin double")


def lines(spark):
    t = dt.datetime
    return spark.createDataFrame([
        ("O1", "B1", "S1", "Seg", "TX", "South", "America/Chicago", 1, t(2024, 3, 1, 10), 10.0, 2.0, 0.5),   # first, referred
        ("O1", "B1", "S2", "Seg", "TX", "South", "America/Chicago", 1, t(2024, 3, 1, 10), 30.0, 1.0, 0.5),
        ("O2", "B1", "S1", "Seg", "TX", "South", "America/Chicago", 1, t(2024, 11, 29, 12), 100.0, 1.0, 0.25),  # holiday
        ("O3", "B2", "S1", "Seg", "NY", "East", "America/New_York", 0, t(2024, 11, 30, 0, 30), 60.0, 1.0, 0.5),  # -> 11/29 23:30 Chicago
        ("O4", "B3", "S1", "Seg", "TX", "South", None, 1, t(2023, 6, 1, 8), 5.0, 1.0, 0.1),                 # fee 7.99
        ("O5", "B4", "S1", "Seg", "TX", None, "America/Chicago", 0, t(2024, 6, 1, 8), 5.0, 1.0, 0.1),       # null region -> dropped
        ("O6", "B5", "S1", "Seg", "TX", "South", "Bad/Zone", 0, t(2024, 6, 1, 8), 5.0, 1.0, 0.1),          # unknown zone
    ], LINE_SCHEMA)


def test_order_level(spark):
    o = {r.order_id: r for r in O.build_orders(lines(spark), Params()).collect()}
    assert set(o) == {"O1", "O2", "O3", "O4"}
    o1 = o["O1"]
    assert o1.is_first_order and o1.order_base_revenue == 50.0
    assert o1.referral_discount_amount == 5.0 and o1.order_net_revenue_before_shipping == 45.0
    # base revenue 50 is in the middle tier (>= 50, < 100)
    assert o1.customer_shipping_fee == 4.99 and o1.order_revenue == pytest.approx(49.99)
    assert o1.order_profit == pytest.approx(49.99 - 25.0 - 4.99) and o1.quarter == "2024Q1" and o1.hour_company == 10
    o2 = o["O2"]
    assert o2.is_black_friday and not o2.is_first_order and o2.black_friday_discount_amount == 20.0
    assert o2.customer_shipping_fee == 0.0
    o3 = o["O3"]
    assert o3.is_black_friday and o3.hour_company == 23 and o3.customer_shipping_fee == 4.99
    assert o["O4"].referral_discount_amount == 0.5 and o["O4"].year == 2023 and o["O4"].customer_shipping_fee == 7.99


def test_stacked_and_net_basis(spark):
    p = O.apply_discounts(O.flag_first_orders(O.prepare_lines(lines(spark), Params())), Params(), "stacked")
    o = {r.order_id: r for r in O.roll_up_orders(p, Params(), shipping_basis="net").collect()}
    # net 45 < 50 -> low tier on the net basis
    assert o["O1"].order_net_revenue_before_shipping == 45.0 and o["O1"].customer_shipping_fee == 7.99


def test_params_checks():
    with pytest.raises(ValueError):
        Params(shipping_threshold_1=100, shipping_threshold_2=50)
    with pytest.raises(ValueError):
        Params(referral_discount_rate=1.5)
    assert Params(shipping_fee_low=1.0).warnings
