"""Join diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def semi_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Keep rows whose key occurs in ``keys`` (distinct first: the join
    then shuffles one row per key, so a hot key is not replicated)."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of A∩B, A-B and B-A over distinct non-NULL keys (full outer join of key sets)."""
    a = left.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct().withColumn("_a", F.lit(True))
    b = right.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct().withColumn("_b", F.lit(True))
    j = a.join(b, "_k", "full")
    return j.agg(F.count_if(F.col("_a") & F.col("_b")).alias("both"),
                 F.count_if(F.col("_b").isNull()).alias("left_only"),
                 F.count_if(F.col("_a").isNull()).alias("right_only"))
