"""Distributed exact quantiles equal Spark's exact ``percentile``, also on a hot group."""

from pyspark.sql import functions as F

from orderlens.operators.quantiles import group_quantiles, quantiles_row, with_group_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
NAMES = ["p0", "p25", "p50", "p75", "p999", "p100"]


def _skewed(spark):
    # group "hot" holds ~2/3 of the rows; values repeat; some NULL values and a NULL group key
    return spark.range(4000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot"))
         .when(F.col("id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(((F.col("id") * 7919) % 1013) / 8.0 - 40).alias("v"))


def _exact(df, keys):
    return df.groupBy(*keys).agg(*[F.percentile("v", F.lit(p)).alias(n) for p, n in zip(PROBS, NAMES)])


def _rows(df, keys):
    return sorted((tuple(str(r[k]) for k in keys), tuple(round(r[n], 9) for n in NAMES)) for r in df.collect())


def test_group_quantiles_match_percentile(spark):
    df = _skewed(spark)
    exp = _rows(_exact(df, ["g"]), ["g"])
    assert _rows(group_quantiles(df, ["g"], "v", PROBS, NAMES), ["g"]) == exp
    # many small range blocks: the hot group's ranks cross block boundaries
    assert _rows(group_quantiles(df, ["g"], "v", PROBS, NAMES, blocks=13), ["g"]) == exp


def test_global_quantiles_and_empty_groups(spark):
    df = _skewed(spark)
    got = quantiles_row(df, "v", PROBS, NAMES).collect()
    exp = df.agg(*[F.percentile("v", F.lit(p)).alias(n) for p, n in zip(PROBS, NAMES)]).collect()
    assert [round(got[0][n], 9) for n in NAMES] == [round(exp[0][n], 9) for n in NAMES]
    # a group whose values are all NULL keeps its row with NULL quantiles
    src = df.withColumn("v", F.when(F.col("g") == "k1", F.lit(None)).otherwise(F.col("v")))
    agg = src.groupBy("g").count()
    out = {r.g: r.p50 for r in with_group_quantiles(agg, src, ["g"], "v", [0.5], ["p50"]).collect()}
    assert out["k1"] is None and out["hot"] is not None and None in out
