"""Sales are parsed once: a layout is tried once per row, and what reads them more than once reads a stored table."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F

from orderlens.functions.timefn import SALES_TS_FORMATS, parse_ts, with_parsed_ts
from orderlens.operators import clean as C
from orderlens.params import Params

SCHEMA = "order_id string, buyer_id string, sku_id string, quantity string, order_datetime string, order_status string, _ord long"
TIMES = ["1/1/70 0:00", "12/31/68 23:59", "1/1/69 0:00", " 3/4/2024 5:06\t", "2024-03-04 05:06:07", "3/4/24 5:06:07", "3/4/99 5:06:07",
         "3/4/1899 5:06:07", "3/4/2085 5:06", "2/30/24 1:00", "soon", "", None, "1/5/24 10:00\n", "1/5/24 10:00 \u0085"]


def sales(spark):
    return spark.createDataFrame([(f" O{i % 4}", "B1", " s1", str(i), t, "Delivered", i) for i, t in enumerate(TIMES)], SCHEMA)


def tries(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp(")


def test_parsed_column_is_the_expression(spark):
    df = sales(spark)
    out, branch = parse_ts("order_datetime", with_branch=True)
    expected = df.withColumns({"order_datetime": out, "b": branch})
    got = with_parsed_ts(df, "order_datetime", branch="b")
    assert got.schema == expected.schema
    assert got.orderBy("_ord").collect() == expected.orderBy("_ord").collect()
    assert {r.b for r in got.collect()} == {0, 1, 2, 3, 4, None}
    assert got.where("_ord = 2").first().order_datetime == dt.datetime(1969, 1, 1)
    assert with_parsed_ts(df, "order_datetime").columns == df.columns


def test_a_layout_is_tried_once(spark):
    """Filters, branch and century do not parse the text again."""
    assert tries(C.typed_sales(sales(spark))) == len(SALES_TS_FORMATS)
    seen = []
    C.clean_sales(sales(spark), Params(), keep=lambda d: seen.append(d) or d)
    assert tries(seen[0]) == len(SALES_TS_FORMATS)


def test_clean_layer_stores_the_sales(spark, monkeypatch):
    """F16: the cap, the counts and the buyers' first orders read one stored table."""
    from orderlens.plans import catalog
    run = catalog.queries()["cl1_clean_layer"]            # loads the modules in their order
    from orderlens.plans import queries_reports

    stored, write = [], queries_reports.materialize_table
    monkeypatch.setattr(queries_reports, "materialize_table", lambda df, name: stored.append(name) or write(df, name))
    p = catalog.pipeline(spark, SF_SMALL)
    buyers, lines, products, _ = C.build_clean_layer(p.sales_raw, p.buyers_raw, p.products_raw, p.params)
    got = {r.table: r.rows for r in run(spark, SF_SMALL).collect()}
    assert got == {"sales": lines.count(), "products": products.count(), "buyers": buyers.count()}
    assert stored == ["clean-layer-sales"]


def test_run_drift_stores_the_typed_sales(spark, monkeypatch):
    """the profile of the incoming sales reads a stored table, all its counts in one pass."""
    from orderlens.plans import catalog
    run = catalog.queries()["eda15b_run_drift"]
    from orderlens.plans import queries_profile as Q

    stored, write = {}, Q.materialize_table
    monkeypatch.setattr(Q, "materialize_table", lambda df, name: stored.setdefault(name, write(df, name)))
    got = {(r.dataset, r.metric): r.previous for r in run(spark, SF_SMALL).collect()}
    typed = C.typed_sales(catalog.pipeline(spark, SF_SMALL).sales_raw)
    assert list(stored) == ["profile-sales"] and got["sales", "rows"] == typed.count() == stored["profile-sales"].count()
    assert got["sales", "null_profile.quantity"] == stored["profile-sales"].where(F.col("quantity").isNull()).count() > 0
    assert {"quantity.count", "quantity.min", "quantity.max", "quantity.p25", "quantity.median", "quantity.p75"} < {
        m for d, m in got if d == "sales"}
