"""Hourly demand (Q1) over the event stream.

The batch and the streaming job share one transformation: purchases ->
company time (per-row zone) -> distinct orders per (year, hour).  The stream
de-duplicates (year, hour, order id) without a watermark, so that late and
repeated events count as in the batch form over any number of micro-batches;
the state therefore holds one key per distinct order.  Every micro-batch writes
the complete result table to the shared checkpoint folder (no driver-side sink).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.functions.timefn import with_company_ts
from orderlens.params import Params
from orderlens.session import ensure_checkpoint_dir
from orderlens.sources.testbed import EVENT_FILTER, EVENT_ORDER_EXPRS


def _event_orders(events: DataFrame) -> DataFrame:
    return events.where(EVENT_FILTER).selectExpr(*[f"{e} AS {n}" for n, e in EVENT_ORDER_EXPRS])


def _company_hours(orders: DataFrame, params: Params) -> DataFrame:
    o = orders.withColumn("order_datetime", F.col("order_datetime").cast("timestamp_ntz"))
    o = with_company_ts(o, "order_datetime", "timezone", params.company_timezone)
    return o.where(F.col("order_datetime_company").isNotNull()).select(
        "order_id", "order_datetime_company",
        F.year("order_datetime_company").alias("year"), F.hour("order_datetime_company").alias("hour"))


def hourly_volume_batch(events: DataFrame, params: Params = Params()) -> DataFrame:
    """Batch form: distinct purchase orders by (year, company hour)."""
    h = _company_hours(_event_orders(events), params)
    lo, hi = params.metric_years
    return (h.where(F.col("year").between(lo, hi)).groupBy("year", "hour")
             .agg(F.count_distinct("order_id").alias("order_volume")).orderBy("year", "hour"))


def run_hourly_volume_stream(spark: SparkSession, events_path: str, params: Params = Params(),
                             files_per_batch: int | None = None) -> DataFrame:
    """Streaming form over a folder / glob of event files; runs all available
    input (``availableNow``) in batches of ``files_per_batch`` files (all of them
    by default) and returns the written result table."""
    schema = spark.read.parquet(events_path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    h = _company_hours(_event_orders(reader.parquet(events_path)), params)
    lo, hi = params.metric_years
    agg = (h.where(F.col("year").between(lo, hi)).dropDuplicates(["year", "hour", "order_id"])
            .groupBy("year", "hour").agg(F.count(F.lit(1)).alias("order_volume")))
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex[:12]
    out = f"{base}/orderlens-stream/hourly-{run}/result"

    def write_batch(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(out)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write_batch)
            .option("checkpointLocation", f"{base}/orderlens-stream/hourly-{run}/state")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).orderBy("year", "hour")
