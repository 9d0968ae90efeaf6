import datetime as dt

from pyspark.sql import functions as F

from orderlens.functions import holiday_date, parse_ts, safe_ratio, strip_ws, squeeze_ws, flag_robust, money
from orderlens.functions.timefn import to_company_ts, with_company_ts


def test_holiday_dates(spark):
    # Friday after the fourth Thursday of November
    years = [2018, 2019, 2023, 2024, 2025]
    rows = spark.createDataFrame([(y,) for y in years], "y int").select(holiday_date("y").alias("d")).collect()
    assert [r.d for r in rows] == [dt.date(2018, 11, 23), dt.date(2019, 11, 29), dt.date(2023, 11, 24),
                                   dt.date(2024, 11, 29), dt.date(2025, 11, 28)]


def test_century_pivot_and_fallbacks(spark):
    df = spark.createDataFrame([("1/1/70 0:00",), ("12/31/68 23:59",), ("3/4/2024 5:06",), ("2024-03-04 05:06:07",),
                                ("abc",), (None,)], "s string")
    out, branch = parse_ts("s", with_branch=True)
    rows = df.select(out.alias("t"), branch.alias("b")).collect()
    assert rows[0].t == dt.datetime(1970, 1, 1) and rows[0].b == 0
    assert rows[1].t == dt.datetime(2068, 12, 31, 23, 59)
    assert rows[2].t == dt.datetime(2024, 3, 4, 5, 6) and rows[2].b == 1
    assert rows[3].t == dt.datetime(2024, 3, 4, 5, 6, 7) and rows[3].b == 2
    assert rows[4].t is None and rows[4].b is None and rows[5].t is None


def test_dst_gap_overlap_unknown_zone(spark):
    df = spark.createDataFrame([
        ("2024-03-10 02:30:00", "America/Chicago"),   # gap -> drop
        ("2024-11-03 01:30:00", "America/Chicago"),   # ambiguous -> drop
        ("2024-11-03 02:30:00", "America/Chicago"),   # keep
        ("2024-06-01 12:00:00", None),                # company zone
        ("2024-06-01 12:00:00", "Nope/Zone"),         # unknown -> drop
        ("2024-06-01 12:00:00", "America/New_York"),  # -1h in company time
    ], "s string, z string").withColumn("l", F.col("s").cast("timestamp_ntz"))
    got = [r.c for r in with_company_ts(df, "l", "z", "America/Chicago", "c").orderBy("s", "z").collect()]
    exp = {dt.datetime(2024, 11, 3, 2, 30), dt.datetime(2024, 6, 1, 12, 0), dt.datetime(2024, 6, 1, 11, 0)}
    assert sorted(x for x in got if x is not None) == sorted(exp)
    assert sum(x is None for x in got) == 3
    # single-expression form agrees
    one = [r.c for r in df.select(to_company_ts("l", "z", "America/Chicago")[1].alias("c")).orderBy("s", "z").collect()]
    assert sorted(x for x in one if x is not None) == sorted(exp)


def test_text_and_money(spark):
    r = spark.createDataFrame([("\t a  b \n", "$12.50", " y ")], "a string, p string, f string").select(
        strip_ws("a").alias("s"), squeeze_ws("a").alias("q"), money("p").alias("m"), flag_robust("f").alias("f")).first()
    assert r.s == "a  b" and r.q == "a b" and r.m == 12.5 and r.f == 1


def test_safe_ratio(spark):
    r = spark.range(1).select(safe_ratio(F.lit(1), F.lit(0)).alias("a"), safe_ratio(F.lit(1), F.lit(4)).alias("b")).first()
    assert r.a == 0.0 and r.b == 0.25


def test_zone_paths_agree(spark):
    """The UTC-session form (to/from_utc_timestamp) and the convert_timezone
    fallback used in other session zones give the same wall clocks."""
    zones = ["America/Chicago", "America/New_York", "America/Los_Angeles", "Europe/London", "Australia/Lord_Howe",
             "Asia/Kolkata", None, "Bad/Zone"]
    stamps = ["2024-03-10 01:59:00", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "2024-11-03 00:59:00",
              "2024-11-03 01:30:00", "2024-11-03 02:00:00", "2024-03-31 01:30:00", "2024-10-27 01:30:00",
              "2024-04-07 01:45:00", "2024-10-06 02:15:00", "2024-07-04 12:00:00"]
    df = spark.createDataFrame([(s, z) for s in stamps for z in zones], "s string, z string") \
        .withColumn("l", F.col("s").cast("timestamp_ntz"))

    def run():
        return sorted(((r.s, r.z or ""), r.c) for r in with_company_ts(df, "l", "z", "America/Chicago", "c").collect())

    fast = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        slow = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert fast == slow
    assert any(c is None for _, c in fast) and any(c is not None for _, c in fast)


def test_numbers_take_no_suffix_nan_or_infinity(spark):
    from orderlens.functions.numeric import try_num
    texts = ["12", " 3.5 ", "-.5", "1e3", "12d", "12f", "NaN", " NaN ", "Infinity", "1e999", "", "0x1", "1,2", None]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select(try_num("s").alias("n"), money("s").alias("m")).collect()
    assert [r.n for r in rows] == [12.0, 3.5, -0.5, 1000.0] + [None] * 10 and [r.m for r in rows] == [r.n for r in rows]
    d = spark.createDataFrame([(1.25,), (float("nan"),), (float("inf"),)], "x double").select(try_num("x").alias("n")).collect()
    assert [r.n for r in d] == [1.25, None, None]


def test_legacy_zone_ids_are_valid(spark):
    zones = ["GMT", "EST", "Japan", "EST5EDT", "MST", "Etc/GMT+5", "America/Chicago", "UTC", "Nope"]
    df = spark.createDataFrame([("2024-06-01 12:00:00", z) for z in zones], "s string, z string") \
        .withColumn("l", F.col("s").cast("timestamp_ntz"))
    got = {r.z: r.c and r.c.hour for r in with_company_ts(df, "l", "z", "America/Chicago", "c").collect()}
    assert got == {"GMT": 7, "EST": 12, "Japan": 22, "EST5EDT": 11, "MST": 14, "Etc/GMT+5": 12, "America/Chicago": 12,
                   "UTC": 7, "Nope": None}
