"""Structured Streaming forms of the batch operators."""

from orderlens.streaming.hourly import hourly_volume_batch, run_hourly_volume_stream

__all__ = ["hourly_volume_batch", "run_hourly_volume_stream"]
