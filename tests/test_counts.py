"""Melted value counts: modes, distinct counts and column profiles against the built-in aggregates."""

import datetime as dt
import random

from pyspark.sql import functions as F

from orderlens.operators import profile as PF
from orderlens.operators.clean import impute_mode
from orderlens.operators.common import distinct_counts, top_values, value_counts


def rows(n=400):
    rng = random.Random(3)
    pick = lambda xs: rng.choice(xs)
    # a third of all rows under one key, ties among the values, NULL keys and values
    return [(pick(["k1", "k1", "k2", "k3", None, "k4"]), pick(["a", "b", "c", None]), rng.choice([1, 2, 2, None]),
             pick([0.5, 10.0, -3.25, None]), dt.datetime(2024, 1, rng.randint(1, 28)) if rng.random() < 0.9 else None) for _ in range(n)]


SCHEMA = "k string, v string, n int, x double, t timestamp_ntz"


def test_modes_equal_the_built_in_mode(spark):
    df = spark.createDataFrame(rows() + [("tie", "z", 1, None, None), ("tie", "y", 1, None, None), ("none", None, None, None, None)], SCHEMA)
    got = {(r.k, r.column): (r.top_value, r.present, r.distinct_values)
           for r in top_values(value_counts(df, ["v", "n"], ["k"]), ["k"]).collect()}
    for c in ("v", "n"):
        for r in df.groupBy("k").agg(F.mode(c, True).cast("string").alias("m"), F.count(c).alias("p"), F.count_distinct(c).alias("d")).collect():
            assert got[r.k, c] == (r.m, r.p, r.d)
    assert got["tie", "v"][0] == "y"
    filled = impute_mode(df, ["v"], "k")
    assert filled.columns == df.columns and filled.where("v is null and k not in ('none')").count() == 0
    assert filled.where("v is null").count() == df.where("v is null and (k is null or k = 'none')").count()


def test_distinct_counts_equal_count_distinct(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {r.k: (r.vs, r.ns) for r in distinct_counts(df, ["k"], {"vs": "v", "ns": "n"}).collect()}
    assert got == {r.k: (r.a, r.b) for r in df.groupBy("k").agg(F.count_distinct("v").alias("a"), F.count_distinct("n").alias("b")).collect()}
    plan = distinct_counts(df, ["k"], {"vs": "v", "ns": "n"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    one = distinct_counts(df, [], {"vs": "v"}).first()
    assert one.vs == df.select("v").where("v is not null").distinct().count()


def test_distinct_profile_equals_plain_aggregates(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {r.column: r for r in PF.distinct_profile(df).collect()}
    for c in df.columns:
        w = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("d"),
                   F.min(c).cast("string").alias("lo"), F.max(c).cast("string").alias("hi")).first()
        assert tuple(got[c])[1:] == (w.rows, w.nulls, w.d, w.lo, w.hi)
    assert PF.distinct_profile(df.limit(0)).count() == 0
    constant = PF.constant_columns(df.where("k = 'k2'")).collect()
    assert ("k", 1) in [tuple(r) for r in constant]


def test_null_slice_comparison_and_quality(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "x", 1), ("b", "x", 1), (None, None, None)], "f string, d string, g int")
    got = {r.feature: (r.mode_null_slice, r.mode_valid_slice, r.verdict) for r in PF.modal_in_null_slice(df, "d", ["f", "g"]).collect()}
    assert got == {"f": ("a", "b", "DIFFERENT"), "g": ("1", "1", "Same")}
    q = PF.slice_quality(df, "d").first()
    assert (q.cells, q.valid_cells, q.null_cells) == (9, 4, 5) and abs(q.quality_score_pct - 400 / 9) < 1e-9
    assert PF.slice_quality(df.where("false"), "d").first().quality_score_pct is None
