"""Sinks: table writes, metric fan-out, JSON reports and the run audit."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, base: str, partition_by=(), formats=("parquet", "csv")) -> None:
    """SNK1: write one table as Parquet and/or header CSV under ``base.<format>``.

    Parquet keeps types; CSV needs no string normalisation pass because Spark
    renders every type itself.  Errors propagate to the caller.
    """
    for fmt in formats:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "csv":
            # quotes are doubled and blanks kept, as the CSV readers expect
            w.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False).csv(f"{base}.csv")
        else:
            w.format(fmt).save(f"{base}.{fmt}")


def write_metrics(tables: dict[str, DataFrame], folder: str, formats=("parquet", "csv")) -> None:
    """SNK2: each named metric table into one folder."""
    for name, df in tables.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", formats=formats)


def write_report(df: DataFrame, path: str) -> None:
    """SNK3: a (small) report table as JSON lines, one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def run_audit(spark: SparkSession, stages: dict[str, int], rules: DataFrame, severities: dict[str, tuple[str, ...]],
              settings: dict) -> DataFrame:
    """SNK4: one row per stage ``(stage, rows, passed, failed_rules, settings)``.

    ``stages``: rows of each stage, counted while it was written.  ``rules``: rule rows whose ``dataset``
    is a stage; a stage passes when none of its rules of the ``severities`` named for it fails.
    """
    rows = spark.createDataFrame(
        [(s, n, list(severities.get(s, ()))) for s, n in stages.items()], "stage string, rows bigint, severities array<string>")
    counted = rules.select(F.col("dataset").alias("stage"), "severity", "passed")
    failed = F.array_contains("severities", F.col("severity")) & ~F.col("passed")
    return rows.join(counted, "stage", "left").groupBy("stage", "rows").agg(
        F.count(F.when(failed, 1)).alias("failed_rules")).select(
        "stage", "rows", (F.col("failed_rules") == 0).alias("passed"), "failed_rules",
        F.lit(json.dumps(settings, sort_keys=True)).alias("settings"))
