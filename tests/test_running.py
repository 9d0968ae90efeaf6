"""Distributed per-key running rank / sum equals the window form, also for a hot key."""

from pyspark.sql import Window, functions as F

from orderlens.operators.running import running_rank_sum


def test_prefix_scan_matches_window_on_skewed_key(spark):
    # key "hot" holds ~2/3 of the rows, spread over several range partitions
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 17).cast("string"))).alias("k"),
        ((F.col("id") * 7919) % 3001).alias("t"), F.col("id").alias("oid"), ((F.col("id") % 100) / 4).alias("v"))
    got = running_rank_sum(df, "k", ["t", "oid"], "v", partitions=6)
    w = Window.partitionBy("k").orderBy("t", "oid")
    exp = df.withColumn("rank", F.row_number().over(w)).withColumn(
        "running", F.sum(F.col("v").cast("decimal(20,6)")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = sorted((r.oid, r.rank, r.running) for r in got.select("oid", "rank", "running").collect())
    b = sorted((r.oid, r.rank, r.running) for r in exp.select("oid", "rank", "running").collect())
    assert a == b
    # the hot key really was split over several partitions
    parts = (df.repartitionByRange(6, "k", "t", "oid").where(F.col("k") == "hot")
               .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_global_rank_matches_row_number(spark):
    from orderlens.operators.running import global_rank
    df = spark.range(2500).select(F.col("id").alias("oid"), ((F.col("id") * 7919) % 97).alias("v"))
    order = [F.col("v").desc(), F.col("oid")]
    got = sorted((r.oid, r.rank) for r in global_rank(df, order, partitions=7).collect())
    exp = sorted((r.oid, r.rank) for r in df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).collect())
    assert got == exp
