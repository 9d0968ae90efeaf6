"""Catalog entries: hourly demand over the event table, batch and streaming."""

from __future__ import annotations

from orderlens.params import Params
from orderlens.plans import oracle as O
from orderlens.plans.catalog import register
from orderlens.streaming import hourly_volume_batch, run_hourly_volume_stream

# Events span January 2024: the reference's own 2024..2025 window applies.
EP = Params()
_SQL = O.with_base(f"""
, e AS (SELECT order_id, {O.company_ts('order_datetime', 'timezone', EP.company_timezone)} AS c FROM event_orders)
SELECT CAST(year(c) AS INTEGER) AS year, CAST(hour(c) AS INTEGER) AS hour, count(DISTINCT order_id) AS order_volume
FROM e WHERE c IS NOT NULL AND year(c) BETWEEN {EP.metric_years[0]} AND {EP.metric_years[1]} GROUP BY 1, 2 ORDER BY 1, 2""")


@register("q1_event_hourly_volume", _SQL)
def q1_events(spark, sf):
    return hourly_volume_batch(spark.read.parquet(f"{sf}/events.parquet"), EP)


@register("q1s_event_hourly_volume_stream", _SQL)
def q1_events_stream(spark, sf):
    return run_hourly_volume_stream(spark, f"{sf}/events*.parquet", EP)
