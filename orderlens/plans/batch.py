"""Entry point A: the whole batch run as Spark jobs.

raw -> raw rules -> clean layer -> line fact -> order table -> write tables ->
quality rules -> profile (+ drift against the previous run's snapshot) ->
six metric tables -> lineage registry check -> run audit.

Inputs are either the CSV exports (``--sales --buyers --products``) or the
driver star schema (``--sf``).  Every output is written under ``--out``; the
newest committed profile there is the drift baseline; every run commits a profile
of its own (``sinks.snapshots``), so a run that dies leaves the baseline as it was.

    python -m orderlens.plans.batch --sf /root/testdata/sf0.01 --out /shared/run
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.operators import metrics as M, profile as PF, quality as Q
from orderlens.params import TESTBED, Params
from orderlens.plans.pipeline import Pipeline
from orderlens.session import materialize_table
from orderlens.sinks import SnapshotStore, run_audit, write_metrics, write_report, write_table
from orderlens.sources.files import read_buyers, read_products, read_registry, read_sales

REGISTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "metadata", "derived_fields.json")


def raw_rules(p: Pipeline) -> DataFrame:
    return Q.union_rules([Q.validate_buyers_raw(p.buyers_raw), Q.validate_sales_raw(p.sales_raw),
                          Q.validate_products_raw(p.products_raw),
                          Q.validate_cross_dataset(p.sales_raw, p.buyers_raw, p.products_raw, p.params)])


def run_batch(p: Pipeline, out: str, formats=("parquet", "csv")) -> dict[str, DataFrame]:
    """Run every stage of ``p`` and write all outputs under ``out``; returns the written tables."""
    spark = p.sales_raw.sparkSession
    out = out.rstrip("/")
    written: dict[str, DataFrame] = {}

    raw = materialize_table(raw_rules(p), "raw-rules")                   # steps 2-3 (warn only)
    write_report(raw, f"{out}/reports/raw_rules")
    written["raw_rules"] = raw

    tables = {"sales_clean": p.sales, "buyers_clean": p.buyers, "products_clean": p.products,
              "final_line_level": p.prepared_lines, "order_level": p.orders}
    for name, df in tables.items():                                      # steps 4-6 + write
        write_table(df, f"{out}/processed/{name}", partition_by=("year",) if name == "order_level" else (),
                    formats=formats)
    written.update(tables)

    rules = materialize_table(Q.run_quality(p.buyers, p.sales, p.products, p.lines, p.orders, p.params), "rules")   # step 7
    write_report(rules, f"{out}/reports/data_quality_rules")
    write_report(Q.quality_summary(p.buyers, p.sales, p.products, p.lines, p.orders), f"{out}/reports/data_quality_summary")
    written["quality"] = rules

    # step 8, stateful: the profile is compared with the newest version before, then becomes the newest itself
    store = SnapshotStore(spark, f"{out}/processed/eda/profile")
    previous = store.read()
    writer = store.stage(PF.eda_summary(p.buyers, p.sales, p.sales_audit, p.products, p.lines, p.orders))
    profile = spark.read.parquet(f"{store.folder}/data/{writer}")
    drift = PF.drift(profile, previous)
    write_report(drift, f"{out}/processed/eda/drift_report")
    store.commit(writer)
    written["profile"] = profile

    metrics = M.build_metrics(p.orders, p.params)                        # step 9
    write_metrics(metrics, f"{out}/processed/metrics", formats=formats)
    written.update(metrics)

    lineage = Q.check_registry(read_registry(spark, REGISTRY), p.buyers, p.lines, p.orders)   # step 10
    write_report(lineage, f"{out}/reports/metadata_validation")
    written["lineage"] = lineage

    audit = stage_audit(p, raw.unionByName(rules))                       # step 11
    write_report(audit, f"{out}/reports/processing_log")
    written["audit"] = audit
    return written


# The stages of the run audit, the severities that decide whether each passes, and the
# rule sets that go by another name.
RAW_GATE, CLEAN_GATE = ("HIGH", "CRITICAL"), ("HIGH", "MEDIUM")
STAGE_GATES = {"sales_raw": RAW_GATE, "buyers_raw": RAW_GATE, "products_raw": RAW_GATE, "sales_clean": CLEAN_GATE,
               "buyers_clean": CLEAN_GATE, "products_clean": CLEAN_GATE, "final_line": CLEAN_GATE, "order_level": CLEAN_GATE}
RULES_OF_STAGE = {"cross_dataset": "sales_raw", "final_dataset_line": "final_line"}


def stage_audit(p: Pipeline, rules: DataFrame) -> DataFrame:
    """SNK4 of a pipeline: rows counted by the writes, pass flags of the rule rows, settings."""
    stage = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RULES_OF_STAGE.items() for x in kv]), F.col("dataset")),
                       F.col("dataset"))
    return run_audit(rules.sparkSession, p.stage_rows(), rules.withColumn("dataset", stage), STAGE_GATES, p.params.as_dict())


def pipeline_from_csv(spark: SparkSession, sales: str, buyers: str, products: str, params: Params,
                      flags: str = "robust") -> Pipeline:
    return Pipeline(read_sales(spark, sales), read_buyers(spark, buyers), read_products(spark, products),
                    params, flags=flags, materialize=True)


def main(argv=None):
    ap = argparse.ArgumentParser(description="order-economics batch run on Spark")
    ap.add_argument("--sf", help="driver star-schema folder (testbed mapping)")
    ap.add_argument("--sales"), ap.add_argument("--buyers"), ap.add_argument("--products")
    ap.add_argument("--out", required=True)
    ap.add_argument("--flags", default="robust", choices=["robust", "compat"])
    a = ap.parse_args(argv)
    from orderlens.session import build_session
    spark = build_session()
    if a.sf:
        p = Pipeline.from_testbed(spark, a.sf, TESTBED, materialize=True)
    else:
        p = pipeline_from_csv(spark, a.sales, a.buyers, a.products, Params(), a.flags)
    run_batch(p, a.out)


if __name__ == "__main__":
    main()
