"""Line-level fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.text import norm_key
from orderlens.operators.common import drop_internal


def normalize_ids(df: DataFrame, cols) -> DataFrame:
    """Strip + upper the join keys that are present."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, norm_key(c))
    return df


def build_lines(buyers: DataFrame, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales ⋈ buyers (buyer_id) ⋈ products (sku_id), both inner.

    Sales columns that collide with buyer columns get ``_x`` / ``_y``;
    product columns that collide with the left side get ``_product``.
    No static broadcast: at scale the buyer and product tables grow with the
    data; AQE broadcasts a side only once its measured size is small and
    otherwise splits hot keys of the sort-merge join.
    """
    s = drop_internal(normalize_ids(sales, ["buyer_id", "sku_id"]))
    b = drop_internal(normalize_ids(buyers, ["buyer_id"]))
    p = drop_internal(normalize_ids(products, ["sku_id"]))
    clash = [c for c in b.columns if c in s.columns and c != "buyer_id"]
    s = s.select(*[F.col(c).alias(f"{c}_x") if c in clash else F.col(c) for c in s.columns])
    b = b.select(*[F.col(c).alias(f"{c}_y") if c in clash else F.col(c) for c in b.columns])
    sb = s.join(b, "buyer_id", "inner")
    clash_p = [c for c in p.columns if c in sb.columns and c != "sku_id"]
    p = p.select(*[F.col(c).alias(f"{c}_product") if c in clash_p else F.col(c) for c in p.columns])
    return sb.join(p, "sku_id", "inner")
