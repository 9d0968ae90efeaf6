"""Sources, sinks, rule tables, drift, canonicalisation and streaming."""

import json
import random

import pytest
from pyspark.sql import Window, functions as F

from conftest import SF_SMALL
from orderlens.operators import profile as PF, quality as Q
from orderlens.operators.canon import brute_force_map, canonical_map
from orderlens.sinks import run_audit, write_metrics, write_table
from orderlens.sources.files import (
    read_buyers, read_clean, read_metrics, read_products, read_profile_snapshot, read_registry, read_sales, read_table,
)
from orderlens.streaming import hourly_volume_batch, run_hourly_volume_stream
from orderlens.params import Params


def test_sales_csv_null_tokens_and_ordinal(spark, tmp_path):
    p = tmp_path / "sales.csv"
    p.write_text("order_id,buyer_id,sku_id,quantity,order_datetime,order_status\n"
                 "O1,B1,S1,1,1/5/24 10:00,Delivered\nO2,NA,S2,N/A,1/5/24 10:00,null\n")
    df = read_sales(spark, str(p)).orderBy("_ord").collect()
    assert df[1].buyer_id is None and df[1].quantity is None and df[1].order_status is None
    assert df[0]._ord < df[1]._ord


def test_sinks_and_sources(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    base = str(tmp_path / "t")
    write_table(df, base)
    assert read_clean(spark, base).count() == 5
    write_metrics({"m1": df, "m2": df.select("id")}, str(tmp_path / "metrics"), formats=("parquet",))
    got = read_metrics(spark, str(tmp_path / "metrics"), {"m1": ["id", "v"], "m2": ["id"]})
    assert set(got) == {"m1", "m2"}
    try:
        read_metrics(spark, str(tmp_path / "metrics"), {"m1": ["nope"], "m3": ["id"]})
        raise AssertionError("expected contract error")
    except ValueError as e:
        assert "m3" in str(e) and "nope" in str(e)
    rules = spark.createDataFrame([("a", "HIGH", True), ("a", "LOW", False), ("b", "HIGH", False), ("c", "HIGH", False)],
                                  "dataset string, severity string, passed boolean")
    audit = {r.stage: r for r in run_audit(spark, {"a": 5, "b": 2, "d": 0}, rules, {s: ("HIGH",) for s in "abd"}, {"x": 1}).collect()}
    assert {s: (r.rows, r.passed, r.failed_rules) for s, r in audit.items()} == {"a": (5, True, 0), "b": (2, False, 1), "d": (0, True, 0)}
    assert audit["a"].settings == '{"x": 1}'
    assert read_profile_snapshot(spark, str(tmp_path / "missing")) is None


def test_rules(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    rows = {r.rule_id: r for r in Q.union_rules([
        Q.count_rules(df, "t", [Q.null_rule("N", "k", "nulls"), Q.null_rule("M", "missing", "absent")]),
        Q.dup_rule(df, ["k"], "D", "t", "dups")]).collect()}
    assert rows["N"].value == 1 and not rows["N"].passed
    assert rows["M"].value == -1 and not rows["M"].passed
    assert rows["D"].value == 1
    other = spark.createDataFrame([("a",)], "k string")
    cov = Q.coverage_value(df, other, "k").first()[0]
    assert cov == 100.0


def test_registry(spark, tmp_path):
    reg = tmp_path / "r.json"
    reg.write_text(json.dumps({"fields": [
        {"name": "x", "grain": "order", "definition": "d", "formula": "f", "inputs": ["a"]},
        {"name": "x", "grain": "order", "definition": "d", "formula": "f", "inputs": ["zz"]},
        {"name": "y", "grain": "planet", "definition": "d", "formula": "f", "inputs": []}]}))
    t = spark.createDataFrame([(1, 2)], "x int, a int")
    r = {x.rule_id: x.value for x in Q.check_registry(read_registry(spark, str(reg)), t, t, t).collect()}
    assert r == {"MD001": 0, "MD002": 1, "MD003": 1, "MD004": 0, "MD005": 1}


def test_drift(spark):
    cur = spark.createDataFrame([("s", "rows", 110.0), ("s", "zero", 5.0)], "dataset string, metric string, value double")
    prev = spark.createDataFrame([("s", "rows", 100.0), ("s", "zero", 0.0), ("s", "gone", 1.0)],
                                 "dataset string, metric string, value double")
    d = {r.metric: r for r in PF.drift(cur, prev).collect()}
    assert set(d) == {"rows", "zero"} and d["rows"].pct_change == 10.0 and d["zero"].pct_change is None
    assert PF.drift(cur, None).count() == 0


def test_canonicalisation_matches_brute_force(spark):
    vals = ["Acme Corp"] * 3 + ["ACME  corp"] + ["Acme Crop"] + ["Northwind Traders Intl"] * 2 + ["Northwind Trader Intl", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.token: r.canonical for r in canonical_map(df, "v", 0.9).collect()}
    assert got == brute_force_map(vals, 0.9)


def test_stream_equals_batch(spark):
    p = Params()
    batch = sorted(tuple(r) for r in hourly_volume_batch(spark.read.parquet(f"{SF_SMALL}/events.parquet"), p).collect())
    stream = sorted(tuple(r) for r in run_hourly_volume_stream(spark, f"{SF_SMALL}/events*.parquet", p).collect())
    assert batch == stream and len(batch) > 0


def test_stream_is_exact_over_several_batches(spark, tmp_path):
    """Late events and repeats more than a day apart, one file per micro-batch."""
    import datetime as dt
    rows = [(i, i % 7, dt.datetime(2024, 1, 2 + (i * 5) % 28, i % 24), "purchase", 1.0) for i in range(60)]
    rows += rows[::3]
    for k in range(4):
        spark.createDataFrame(rows[k::4][::-1], "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double") \
            .coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    p = Params()
    batch = sorted(tuple(r) for r in hourly_volume_batch(spark.read.parquet(str(tmp_path / "events")), p).collect())
    stream = run_hourly_volume_stream(spark, str(tmp_path / "events"), p, files_per_batch=1)
    assert sorted(tuple(r) for r in stream.collect()) == batch and sum(r[2] for r in batch) == 60


def test_canonical_map_decides_long_chains_and_long_texts(spark):
    rng = random.Random(3)
    chain = ["A" * 30]
    for i in range(25):                       # each similar to its neighbours only
        chain.append(chain[-1][:i] + "B" + chain[-1][i + 1:])
    words = ["".join(rng.choice("ABCDE") for _ in range(rng.randint(8, 30))) for _ in range(60)]
    near = []
    for w in words:
        x = list(w)
        x[rng.randrange(len(x))] = rng.choice(["", "Z", "QQ"])
        near.append("".join(x))
    long = "".join(rng.choice("ABCDEFGH") for _ in range(300))
    vals = chain + words + near + [long, long[:150] + "zz" + long[155:], "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for threshold in (0.85, 0.92):
        got = {r.token: r.canonical for r in canonical_map(df, "v", threshold).collect()}
        assert got == brute_force_map(vals, threshold) and None not in got.values()


def test_headers_are_read_without_the_file(spark, tmp_path, monkeypatch):
    """A long file costs a few reads of its beginning; a quoted line break in a header belongs to the name."""
    import gzip

    from orderlens.sources import files
    (tmp_path / "a.csv").write_text('"order_id","two\nlines",q\n' + "".join(f"{i},x,1\n" for i in range(200_000)))
    (tmp_path / "b.csv").write_text("\ufefforder_id,q\r\n1,2\r\n")
    (tmp_path / "empty.csv").write_text("")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("order_id,other\n7,8\n")
    reads = []
    whole = files._first_record
    monkeypatch.setattr(files, "_first_record", lambda t: reads.append(len(t)) or whole(t))
    got = {k: [p.rsplit("/", 1)[1] for p in v] for k, v in files._layouts(spark, [str(tmp_path)]).items()}
    assert got == {("order_id", "two\nlines", "q"): ["a.csv"], ("order_id", "q"): ["b.csv"], ("order_id", "other"): ["c.csv.gz"]}
    assert max(reads) <= files.HEADER_BYTES
    df = read_sales(spark, str(tmp_path))
    assert df.count() == 200_002 and df.where("other = '8' and order_id = '7'").count() == 1
    # a name longer than one read, and a file that ends within its header
    (tmp_path / "d.csv").write_text('"' + "n" * 200_000 + '",b\n1,2\n')
    (tmp_path / "e.csv").write_text("only,names")
    assert [len(files._header(spark, str(tmp_path / f"{x}.csv"))) for x in "de"] == [200_004, 10]


def test_files_are_split_unless_a_value_holds_a_line_break(spark, tmp_path):
    from orderlens.sources import files
    row = 'a,"b, c",1\n'
    (tmp_path / "plain.csv").write_text("order_id,buyer_id,quantity\n" + row * 300_000)
    (tmp_path / "broken.csv").write_text("order_id,buyer_id,quantity\n" + row * 10 + 'a,"b\nc",2\n' + row)
    assert {p.rsplit("/", 1)[1] for p in files._with_quoted_breaks(spark, [str(tmp_path)])} == {"broken.csv"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert read_sales(spark, str(tmp_path / "plain.csv")).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    both = read_sales(spark, str(tmp_path))
    assert both.count() == 300_012 and [r["buyer_id"] for r in both.where("quantity = '2'").collect()] == ["b\nc"]


def test_blocks_grow_with_the_tables(spark, tmp_path):
    from orderlens.operators.running import blocks_of
    for n in (1, 10):
        spark.range(n * 200_000).select(F.rand(n).alias("v"), F.uuid().alias("u")).write.parquet(str(tmp_path / f"t{n}"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    one, ten = (spark.read.parquet(str(tmp_path / f"t{n}")) for n in (1, 10))
    assert blocks_of(one) == least
    a, b = blocks_of(one, 1 << 18), blocks_of(ten, 1 << 18)
    assert a > least and 9 <= b / a <= 11
    # a join's estimate is a product; the blocks follow the tables that are read
    assert blocks_of(one.join(ten, "u"), 1 << 18) <= a + b


def test_tokens_with_one_prefix_are_not_all_compared(spark, monkeypatch):
    from orderlens.operators import canon
    rng = random.Random(4)
    vals = ["SHAREDPREFIXOFALL" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(8)) for _ in range(1500)]
    vals += [v[:20] + "Q" + v[21:] for v in vals[:1500]]
    tokens = spark.createDataFrame([(v,) for v in sorted(set(vals))], "token string").cache()
    met, dealt = canon.candidates(tokens, 0.92)
    compared = met.join(dealt, ["longer", "g", "block"]).agg(F.sum(F.size("others"))).first()[0]
    assert compared < len(vals) ** 2 / 20
    # the same pairs whatever the size of a block
    ranked = tokens.withColumn("rank", F.row_number().over(Window.orderBy("token")))
    want = {(r.token, r.earlier) for r in canon.similar_pairs(ranked, 0.92).collect()}
    assert len(want) >= 1400
    monkeypatch.setattr(canon, "BLOCK", 3)
    assert {(r.token, r.earlier) for r in canon.similar_pairs(ranked, 0.92).collect()} == want


def test_quoted_header_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "s.csv").write_text('"order_id","a,b",quantity\n1,"x\ny",2\n3,"say ""hi""",4\n')
    rows = read_sales(spark, str(tmp_path / "s.csv")).orderBy("_ord").collect()
    assert [(r["order_id"], r["a,b"], r["quantity"]) for r in rows] == [("1", "x\ny", "2"), ("3", 'say "hi"', "4")]
    buyers = read_buyers(spark, str(tmp_path / "s.csv"), multi_line=True)
    assert buyers.columns == ["order_id", "a,b", "quantity", "_ord"] and buyers.count() == 2


def test_catalogues_of_several_layouts_keep_file_order(spark, tmp_path):
    (tmp_path / "b.csv").write_text("sku_id,price\ns1,1\n")
    (tmp_path / "a.csv").write_text("price,sku_id,vendor\n2,s1,v\n" + "".join(f"{i},s{i},w\n" for i in range(3, 200)))
    (tmp_path / "c.csv").write_text("sku_id,price\ns1,9\ns2,8\n")
    df = read_products(spark, str(tmp_path))
    rows = df.orderBy("_ord").collect()
    assert [r["_file"] for r in rows][:1] + [r["_file"] for r in rows][-3:] == ["a.csv", "b.csv", "c.csv", "c.csv"]
    assert (rows[0]["price"], rows[0]["vendor"]) == ("2", "v") and rows[-1]["vendor"] is None
    from orderlens.operators.common import dedup_first
    assert dedup_first(df, ["sku_id"], ["_ord"]).where("sku_id = 's1'").first()["price"] == "2"
    assert read_clean(spark, str(tmp_path / "b")).count() == 1      # no Parquet: the CSV branch
    df.select("sku_id", "price").write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), ["sku_id"]).count() == df.count()
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "t"), ["nope"])
