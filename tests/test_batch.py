"""End-to-end batch run (entry point A) on the smallest driver data, twice (drift)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderlens.params import TESTBED
from orderlens.plans.batch import run_batch
from orderlens.plans.pipeline import Pipeline


def test_batch_run_and_drift(spark, tmp_path):
    out = str(tmp_path / "run")
    p = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    w = run_batch(p, out, formats=("parquet",))
    orders = spark.read.parquet(f"{out}/processed/order_level.parquet")
    assert orders.count() == w["order_level"].count() > 0
    m = spark.read.parquet(f"{out}/processed/metrics/q1_hourly_order_volume.parquet")
    assert m.agg(F.sum("order_volume")).first()[0] > 0
    assert spark.read.json(f"{out}/reports/data_quality_rules").where("NOT passed AND severity IN ('HIGH','MEDIUM')").count() == 0
    assert spark.read.json(f"{out}/processed/eda/drift_report").count() == 0          # first run: no previous
    p2 = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    run_batch(p2, out, formats=("parquet",))
    drift = spark.read.json(f"{out}/processed/eda/drift_report")
    assert drift.count() > 0 and drift.where("delta != 0").count() == 0              # same data: no drift
    log = {r.stage: r.rows for r in spark.read.json(f"{out}/reports/processing_log").collect()}
    # the second run overwrote the order table: count the files written now
    assert log["order_level"] == spark.read.parquet(f"{out}/processed/order_level.parquet").count()
