"""The lines that pricing reads: narrow, and the same as those of the whole line fact."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from orderlens.functions.numeric import try_num
from orderlens.operators.orders import LINE_AMOUNT_COLUMNS, PR10_COLUMNS, _num, lines_max_amount_from_prepared
from orderlens.params import TESTBED
from orderlens.plans.pipeline import Pipeline


def rows(df):
    return sorted(map(str, df.collect()))


def test_orders_do_not_write_the_whole_line_fact(spark):
    p = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    assert p.orders.count() and "line_amounts" in p.rows and "line_fact" not in p.rows
    assert p.line_amounts.columns == LINE_AMOUNT_COLUMNS
    narrow = rows(p.line_amounts)
    assert rows(p.line_values.select(*LINE_AMOUNT_COLUMNS)) == narrow
    assert p.rows["line_amounts"] == p.rows["line_fact"] == len(narrow)
    # where the whole line fact is there already, it is read
    q = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    assert q.lines.count() == len(narrow) and rows(q.line_amounts) == narrow and "line_amounts" not in q.rows


def test_pr10_of_the_narrow_lines(spark):
    p = Pipeline.from_testbed(spark, SF_SMALL, TESTBED, materialize=True)
    shown = [*PR10_COLUMNS, "order_number", "total_discount", "revenue", "cost", "profit"]
    wide = lines_max_amount_from_prepared(p.prepared_lines, TESTBED)
    assert set(p.max_amount_lines.columns) < set(wide.columns)
    assert rows(p.max_amount_lines.select(*shown)) == rows(wide.select(*shown))


def test_doubles_are_typed_as_their_text_is(spark):
    values = [1.5, -0.0, 1e300, 5e-324, float("nan"), float("inf"), float("-inf"), None, 0.1, 123456789.123456789]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    both = df.orderBy("i").select(_num(df, "v").alias("a"), try_num("v").alias("b")).collect()
    assert [str(r.a) for r in both] == [str(r.b) for r in both]
    text = df.withColumn("v", F.lit("12d"))
    assert text.select(_num(text, "v").alias("a")).first().a is None


@pytest.mark.parametrize("size, partitions", [(1, "4"), (1 << 30, "2560")])
def test_partitions_grow_with_the_tables(spark, monkeypatch, size, partitions):
    from orderlens.plans import catalog
    names = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    held = {n: spark.conf.get(n, None) for n in names}
    monkeypatch.setattr(catalog, "table_bytes", lambda df: size)
    try:
        catalog.fit_partitions(spark, catalog.Testbed(spark, SF_SMALL))
        assert spark.conf.get(names[0]) == partitions and int(spark.conf.get(names[1])) == catalog.TASK_BYTES
    finally:
        for n, v in held.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)
