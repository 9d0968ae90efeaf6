"""Stages that are shuffled and written in parts: the same rows, and no shuffle stays beside the next part."""

import time

import pytest
from pyspark.sql import functions as F

from orderlens.operators import profile as PF
from orderlens.operators.common import parts_of
from orderlens.params import Params
from orderlens.plans import pipeline as PL, queries_audit, queries_quality, queries_reports
from orderlens.plans.pipeline import Pipeline
from orderlens.session import materialize_parts

SALES = "order_id string, buyer_id string, sku_id string, quantity string, order_datetime string, order_status string, _ord long"
BUYERS = ("buyer_id string, customer_segment string, region string, state string, timezone string, signup_date string, "
          "is_referred string, wishlist_size string, _ord long")
PRODUCTS = "sku_id string, subcategory_id string, price string, profit_margin double, _ord long"


def tables(spark):
    """Repeated, padded and null keys, bad quantities and times, buyers of one order and of many, two records of a buyer."""
    sales, buyers, products = [], [], []
    for i in range(400):
        order = None if i % 29 == 0 else f"{i // 4}  " if i % 4 == 1 else f"{i // 4}"
        buyer = None if i % 31 == 0 else "b0" if i % 3 == 0 else f" b{i // 4 % 13}" if i % 2 else f"b{i // 4 % 13}"
        sales.append((order, buyer, f" sku-{i % 5} " if i % 7 == 0 else f"SKU-{i % 5}", ["1", "2", "0", "12d", "40"][i % 5 if i % 11 == 0 else i % 2],
                      "soon" if i % 37 == 0 else f"{1 + i // 4 % 12}/{1 + i // 4 % 28}/2023 1{i % 3}:30", None if i % 41 == 0 else "Deliverred", i))
    sales += [s[:-1] + (1000 + i,) for i, s in enumerate(sales) if i % 10 == 3]
    for i in range(14):
        buyers += [(f"b{i}", "ab"[i % 2], None if i % 4 == 0 else "R", f"S{i % 3}", None if i % 5 == 0 else "America/Chicago", None, str(i % 3), "3", 2 * i)] * (1 + i % 2)
    buyers.append((None, "a", "R", "S1", None, None, "1", None, 99))
    for i in range(4):
        products.append((f"Sku-{i} ", f"c{i % 2}", f"${10 + i}.5", None if i == 3 else 0.2 + i / 10, i))
    return spark.createDataFrame(sales, SALES), spark.createDataFrame(buyers, BUYERS), spark.createDataFrame(products, PRODUCTS)


def rows(df):
    return sorted(map(str, df.collect()))


def shuffles(spark):
    held = spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {b for b in held.split(",") if b.startswith("shuffle_")}


def left_after(spark, before, seconds=10):
    """Shuffle files that were not there before; Spark deletes them shortly after it noticed."""
    until = time.time() + seconds
    while shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    return shuffles(spark) - before


@pytest.fixture(scope="module")
def one(spark):
    return Pipeline(*tables(spark), Params(), materialize=True, batches=1)


@pytest.fixture(scope="module")
def some(spark):
    return Pipeline(*tables(spark), Params(), materialize=True, batches=5)


def test_registry_check_leaves_no_shuffle_of_the_stages(spark, monkeypatch, some):
    monkeypatch.setattr(queries_audit, "pipeline", lambda *_: some)
    before = shuffles(spark)
    checks = queries_audit.dq16(spark, "")
    assert not left_after(spark, before)
    assert {"sales_dedup", "buyers_clean", "products_clean", "line_fact", "order_level"} <= set(some.rows)
    assert len(checks.collect()) == 5


def test_stages_in_parts_have_the_same_rows(one, some):
    for name in ("sales", "sales_audit", "buyers", "products", "lines", "line_amounts", "orders"):
        assert rows(getattr(one, name)) == rows(getattr(some, name)), name
    assert some.orders.count() > 20 and one.stage_rows() == some.stage_rows() and one.stage_rows()["sales_raw"] == 440
    assert "line_amounts" not in some.rows


def test_a_buyer_is_in_one_part(spark, some):
    buyers = [{r.buyer_id for r in df.select("buyer_id").distinct().collect()} for df in some._line_amounts[1]]
    assert len(buyers) == 5 and sum(map(len, buyers)) == len(set().union(*buyers)) > 5
    each = parts_of(spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "k string"), F.col("k"), 3)
    assert sorted(str(r.k) for df in each for r in df.collect()) == ["None", "a", "a", "b"]


def test_parts_grow_with_the_sales(spark, monkeypatch):
    for size, parts in ((0, 1), (PL.PART_BYTES, 1), (3 * PL.PART_BYTES, 3), (1 << 40, PL.MOST_PARTS)):
        monkeypatch.setattr(PL, "read_bytes", lambda df, size=size: size)
        assert Pipeline(*tables(spark), materialize=True).parts == parts
        assert Pipeline(*tables(spark)).parts == 1


def test_no_shuffle_of_a_part_stays(spark):
    df = spark.range(3000).withColumn("k", F.col("id") % 50)
    before = shuffles(spark)
    whole, each = materialize_parts([d.groupBy("k").agg(F.sum("id").alias("t")) for d in parts_of(df, F.col("k"), 3)], "parts", release=True)
    assert not left_after(spark, before)
    assert whole.count() == sum(d.count() for d in each) == 50 and whole.agg(F.sum("t")).first()[0] == 2999 * 1500


@pytest.mark.parametrize("passes", [1, 3, 50])
def test_profile_in_passes_is_that_of_one_pass(spark, passes):
    df = spark.createDataFrame([(i % 7, None if i % 3 else f"v{i % 5}", i / 4, i % 2 == 0, f"{i}") for i in range(60)],
                               "n int, v string, x double, b boolean, t string")
    stored = []

    def keep(one):
        stored.append(materialize_parts([one], "profile")[0])
        return stored[-1]

    got = PF.distinct_profile(df, passes=passes, keep=keep)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in PF.distinct_profile(df).collect()]
    assert len(stored) == (0 if passes == 1 else min(passes, 5)) and sorted(r.column for d in stored for r in d.collect()) == (
        [] if passes == 1 else ["b", "n", "t", "v", "x"])


def test_order_columns_are_profiled_a_few_at_a_time(spark, monkeypatch, one):
    p = Pipeline(*tables(spark), Params(), materialize=True, batches=2)
    monkeypatch.setattr(queries_audit, "pipeline", lambda *_: p)
    seen, keep = [], Pipeline.stored
    monkeypatch.setattr(Pipeline, "stored", lambda self, df, name: seen.append(keep(self, df, name)) or seen[-1])
    before = shuffles(spark)
    got = queries_audit.dq19c(spark, "")
    assert not left_after(spark, before)
    assert [df.count() for df in seen] == [11, 11] and "line_fact" not in p.rows
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in PF.distinct_profile(one.orders, queries_audit.ORDER_COLUMNS).collect()]


def test_quality_report_of_stages_in_parts(spark, monkeypatch, one, some):
    got = {}
    for p in (one, some):
        monkeypatch.setattr(queries_quality, "pipeline", lambda *_, p=p: p)
        got[p.parts] = queries_quality.dq14(spark, "")
    before = shuffles(spark)
    report = materialize_parts([got[5]], "report", release=True)[0]
    assert not left_after(spark, before)
    assert rows(report) == rows(got[1]) and report.count() == 22 and report.where("value > 0").count() == 2


def test_rules_of_a_gate_are_stored_before_the_next_gate(spark, monkeypatch):
    p = Pipeline(*tables(spark), Params(), materialize=True, batches=1)
    monkeypatch.setattr(queries_reports, "pipeline", lambda *_: p)
    gates = {r.gate: (r.passed, r.checks) for r in queries_reports.snk4b(spark, "").collect()}
    order = [*p.rows]
    assert order.index("raw_gate") < order.index("cross_gate") < order.index("sales_dedup") < order.index("order_level") < order.index("quality_gate")
    assert {g: n for g, (_, n) in gates.items()} == {"raw": p.rows["raw_gate"], "cross": 2, "quality": 22} and not gates["raw"][0]
