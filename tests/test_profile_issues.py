"""EDA43 buyer issue table, EDA38 duplicate scenarios and EDA44 mean date on inline fixtures."""

import datetime as dt

from orderlens.operators import profile as PF

BUYERS = "buyer_id string, region string, timezone string, signup_date timestamp_ntz, is_referred int, customer_group string"


def test_buyer_issue_table_counts_every_copy(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([
        ("B1", "East", "America/New_York", t, 1, "VIP"),
        ("B1", "East", None, t, 0, "VIP"),            # duplicate id, missing zone
        (None, None, "UTC", None, 2, "Dormant"),      # missing id, region, signup; invalid code
        (None, "West", "UTC", t, None, "Regular"),    # second NULL id: NULLs count as equal
        ("B2", "West", "UTC", t, 1, "Regular"),
    ], BUYERS)
    got = {r.issue_no: (r.remaining_issue_rows, r.status) for r in PF.buyer_issue_table(df).collect()}
    assert got[1] == (2, "FAIL")
    assert got[2] == (4, "FAIL")                      # both copies of B1 and both NULL ids
    assert got[3] == (1, "FAIL") and got[4] == (1, "FAIL") and got[5] == (1, "FAIL")
    assert got[6] == (1, "FAIL")
    assert got[7] == (None, PF.NOT_COMPUTED)          # no is_active_buyer column


def test_duplicate_scenarios_compare_whole_payloads(spark):
    df = spark.createDataFrame([
        ("O1", "B1", "S1", "1", None), ("O1", "B1", "S1", "1", None),          # same payload (NULL equal)
        ("O2", "B1", "S1", "1", "x"), ("O2", "B1", "S1", "2", "x"),            # different payload
        ("O3", "B1", "S1", "1", "x"),                                          # single row: not a duplicate
    ], "order_id string, buyer_id string, sku_id string, quantity string, order_status string")
    got = {r.scenario: (r.rows, r.groups) for r in PF.duplicate_scenarios(
        df, "order_id", ["order_id", "buyer_id", "sku_id"], ["order_id", "sku_id"]).collect()}
    assert got == {"duplicate_order_id": (4, 2), "duplicate_strict_key": (4, 2),
                   "A_full_copies": (2, 1), "B_differing_rows": (2, 1)}


def test_mean_date_is_exact(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0)), ("a", dt.datetime(2024, 1, 1, 0, 1)),
            ("a", dt.datetime(2024, 1, 1, 0, 1)), ("b", None)]
    df = spark.createDataFrame(rows, "g string, d timestamp_ntz")
    got = {r.g: (r.mean_date, r.n) for r in PF.date_stats_by(df, "g", "d").collect()}
    assert got["a"] == (dt.datetime(2024, 1, 1, 0, 0, 40), 3)   # (0 + 60 + 60) / 3 s
    assert got["b"] == (None, 0)
