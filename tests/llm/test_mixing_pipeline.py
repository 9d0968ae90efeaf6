import itertools
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm_fixtures import edge, empty, labels, small  # noqa: F401  (fixtures)
import corpus_pipeline
from orderlens.llm import catalog, mixing


def test_targets_share_the_excess():
    assert mixing.capped_targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    t = mixing.capped_targets([1, 50, 49], [3, 1, 1])
    assert t == [3, Fraction(97, 2), Fraction(97, 2)]
    assert mixing.capped_targets([0, 0], [1, 2]) == [0, 0]
    assert sum(mixing.whole_quotas([Fraction(1, 3)] * 3)) == 1


def test_flow_is_of_least_cost():
    words, members, quotas = [3, 2, 2], [[0], [0, 1], [1]], [5, 4]
    flow = mixing.route(words, members, quotas, 2)
    used = [sum(f.values()) for f in flow]
    assert [sum(f.get(s, 0) for f in flow) for s in (0, 1)] == quotas
    cost = lambda use: sum(max(0, u - w) for u, w in zip(use, words))
    best = min(cost((a, b + c, d)) for a, b, c, d in itertools.product(range(7), range(5), range(5), range(5))
               if a + b == 5 and c + d == 4 and b + c <= 4 and d <= 4 and a <= 6)
    assert cost(used) == best


def check_mix(rows, taken):
    """rows: (id, source, size); taken: id -> words."""
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, s, n in rows if s == m) for m in names]
    targets = mixing.capped_targets(sizes, [1 + i % 3 for i in range(len(names))])
    for m, t in zip(names, targets):
        got = sum(taken[d] for d, s, _ in rows if s == m)
        assert abs(got - t) <= max([n for _, s, n in rows if s == m], default=0) + 1
    assert all(taken[d] % n == 0 and taken[d] <= 3 * n if n else taken[d] == 0 for d, _, n in rows)


def test_mix_on_the_given_table(spark, small):
    rows = catalog.op10_mixing(spark, small).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    check_mix([(r["doc_id"], docs[r["doc_id"]]["source"], r["size"]) for r in rows], {r["doc_id"]: r["taken"] for r in rows})
    again = {r["doc_id"]: r["taken"] for r in catalog.op10_mixing(spark, small).repartition(3).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_edge_cases(spark, edge, empty):
    one = edge.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = mixing.mix(one, F.array("source"), mixing.word_count(F.col("text")), mixing.seeded_key(F.col("doc_id")), ["doc_id", "source"])
    rows = out.collect()
    check_mix([(r["doc_id"], r["source"], r["size"]) for r in rows], {r["doc_id"]: r["taken"] for r in rows})
    assert mixing.mix(edge, F.array("source"), mixing.word_count(F.col("text")),
                      mixing.seeded_key(F.col("doc_id")), edge.columns).count() == edge.count()
    assert mixing.mix(empty, F.array("source"), mixing.word_count(F.col("text")),
                      mixing.seeded_key(F.col("doc_id")), ["doc_id"]).count() == 0


def test_mix_overlapping_sources(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(10).alias("n"),
        F.expr("CASE id % 3 WHEN 0 THEN array('a') WHEN 1 THEN array('b','a') ELSE array('b','c') END").alias("m"))
    rows = mixing.mix(df, F.col("m"), F.col("n"), mixing.seeded_key(F.col("doc_id")), ["doc_id", "m"]).collect()
    by = {}
    for r in rows:
        assert set(r["copies"]) <= set(r["m"]) and r["taken"] == 10 * len(r["copies"])
        for s in r["copies"]:
            by[s] = by.get(s, 0) + 10
    # shares of 30000 words by weights 1, 2, 3
    assert all(abs(by[s] - t) <= 20 for s, t in (("a", 5000), ("b", 10000), ("c", 15000)))


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small).cache()
        out.append((name, before, docs))
    return out


def test_pipeline_stages(spark, stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "exact_dedup", "ngram_join", "mix_sources", "piece_encoding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.select("doc_id", "text").distinct().exceptAll(before.select("doc_id", "text").distinct()).count() == 0
    _, _, unique = stages[1]
    assert unique.count() == unique.select("text").distinct().count() == stages[1][1].select("text").distinct().count()
    _, before, mixed = stages[3]
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    _, before, last = stages[4]
    assert last.count() == before.count() and last.where("not round_trip").count() == 0


def test_pipeline_on_an_empty_table(spark, small, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0
