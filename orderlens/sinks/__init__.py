"""Sinks (SNK1-SNK4)."""

from orderlens.sinks.snapshots import SnapshotStore
from orderlens.sinks.writers import write_table, write_metrics, write_report, run_audit

__all__ = ["SnapshotStore", "write_table", "write_metrics", "write_report", "run_audit"]
