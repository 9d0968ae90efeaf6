"""Versioned snapshots, and row counts observed while stages are written."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderlens.operators import clean
from orderlens.params import TESTBED
from orderlens.plans.pipeline import Pipeline
from orderlens.sinks import SnapshotStore


def test_versions_appear_with_their_commit(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.read() is None and store.versions() == []
    one = spark.range(3)
    assert store.write(one) == 1 and store.read().count() == 3
    # rows of a run that dies before its commit are no version, however complete
    writer = store.stage(spark.range(50))
    assert store.versions() == [1] and store.read().count() == 3
    # neither are rows that a dying run left half written
    half = store.stage(spark.range(60))
    (tmp_path / "store" / "data" / half / "_SUCCESS").unlink()
    with pytest.raises(ValueError):
        store.commit(half)
    assert store.versions() == [1]
    assert store.commit(writer) == 2 and store.read().count() == 50 and store.read(1).count() == 3
    assert store.read(7) is None
    assert [store.write(spark.range(n)) for n in (7, 8)] == [3, 4]
    assert store.expire(2) == [1, 2] and store.versions() == [3, 4] and store.read(3).count() == 7
    assert SnapshotStore(spark, str(tmp_path / "store")).read().count() == 8


def test_two_runs_that_commit_at_once_take_two_numbers(spark, tmp_path, monkeypatch):
    a, b = (SnapshotStore(spark, str(tmp_path / "store")) for _ in range(2))
    mine, other = a.stage(spark.range(1)), b.stage(spark.range(2))
    real, seen = SnapshotStore.versions, []

    def late(self):
        held = real(self)
        if not seen:        # the other run commits between the look and the creation
            seen.append(1)
            b.commit(other)
        return held

    monkeypatch.setattr(SnapshotStore, "versions", late)
    assert a.commit(mine) == 2
    monkeypatch.undo()
    assert a.versions() == [1, 2] and a.read().count() == 1 and a.read(1).count() == 2


def test_observed_counts_equal_counts(spark):
    p = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    want = {"sales_raw": p.sales_raw, "buyers_raw": p.buyers_raw, "products_raw": p.products_raw, "sales_clean": p.sales,
            "buyers_clean": p.buyers, "products_clean": p.products, "final_line": p.lines, "order_level": p.orders}
    assert p.stage_rows() == {k: d.count() for k, d in want.items()}
    # the counters observed by the write are those of the plain aggregates
    _, plain = clean.clean_sales(p.sales_raw, p.params)
    assert {r.metric: r.value for r in p.sales_audit.collect()} == {r.metric: r.value for r in plain.collect()}
    with pytest.raises(ValueError):
        Pipeline.from_testbed(spark, SF_SMALL, TESTBED).stage_rows()


def test_observed_counts_of_an_empty_table(spark):
    p = Pipeline.from_testbed(spark, SF_SMALL, TESTBED)
    q = Pipeline(p.sales_raw.where("false"), p.buyers_raw, p.products_raw, TESTBED, materialize=True)
    got = q.stage_rows()
    assert got["sales_raw"] == got["sales_clean"] == got["order_level"] == 0 and got["products_raw"] == p.products_raw.count()
    assert {r.value for r in q.sales_audit.where(F.col("metric").like("datetime%")).collect()} == {0.0}
