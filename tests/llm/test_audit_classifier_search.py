"""Divergence audit, quality classifier and lexical search against plain versions."""

import math
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, edge, edge_rows, empty, labels, small  # noqa: F401  (fixtures)
from orderlens.llm import catalog, divergence, lexical_search, quality_classifier

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- divergence audit -----------------------------------------------------------

def brute_audit(rows, least=10, top=10):
    """``rows``: (text, lang, source)."""
    find = re.compile(divergence.TERM)
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        found = Counter(find.findall((text or "").translate(LOWER)))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        held[lang].update(found.keys())
        counts[lang, source].update(found)
    out = []
    for lang, source in groups:
        terms = [t for t, n in held[lang].items() if n >= least]
        of_lang = Counter()
        for g in groups:
            if g[0] == lang:
                of_lang.update({t: counts[g][t] for t in terms})

        def p(c, t):
            total = sum(c[x] for x in terms)
            return 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(terms))

        f = lambda a, b: (a - b) * (a - b) // (a + b)
        own = counts[lang, source]
        pairs = [(sum(f(p(own, t), p(counts[lang, s], t)) for t in terms), s)
                 for g, s in groups if g == lang and s != source]
        marked = [(f(p(own, t), p(of_lang, t)), t) for t in terms if own[t] and p(own, t) > p(of_lang, t)]
        for part, found, limit in (("pair", pairs, None), ("term", marked, top)):
            best = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(best)]
    return sorted(out)


def audit_rows():
    rng = np.random.default_rng(2)
    shapes = ["w{}", "W{},", "(w{})", "w{}-w{}", "é{}", "\x00w{}\x7f"]
    rows = []
    for d in range(160):
        words = [shapes[rng.integers(len(shapes))].replace("{}", "abcdefghij"[int(rng.integers(10) ** 2 / 10)])
                 for _ in range(rng.integers(0, 25))]
        rows.append((" \n\t"[d % 3].join(words), ["en", "de", None][d % 3], ["s1", "s2", "s3", None][int(d ** 1.5) % 4]))
    return rows + [(None, "en", "none"), ("alone", "xx", "a"), (None, "xx", "b"), ("", None, None)]


@pytest.mark.parametrize("block,piece,pair_rows", [(24 << 20, 4 << 20, 200_000), (300, 40, 3)])
def test_audit_equals_brute_force(spark, monkeypatch, block, piece, pair_rows):
    rows = audit_rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    # Python workers import the module anew: the block's own limits are tested here
    monkeypatch.setattr(divergence, "BLOCK_BYTES", block)
    monkeypatch.setattr(divergence.pieces, "__defaults__", (piece,))
    batch = pa.RecordBatch.from_arrays([pa.array([7] * len(rows), pa.int64())] + [
        pa.array([r[j] or "" for r in rows]) for j in (1, 2, 0)], ["part", "lang", "source", "text"])
    counts, groups, blocks = defaultdict(Counter), {}, set()
    for out in divergence.count_chunks([batch]):
        for r in out.to_pylist():
            blocks.add(r["block"])
            if r["groups"] is not None:
                groups[r["block"]] = r["groups"]
            else:
                for d in np.frombuffer(r["docs"], "<u2"):
                    g = next(g for g in groups[r["block"]] if d < g["until"])
                    counts[g["lang"], g["source"]][r["chunk"]] += 1
    want = defaultdict(Counter)
    for text, lang, source in rows:
        want[lang or "", source or ""].update(x.decode() for x in (text or "").encode().split())
    assert {k: v for k, v in counts.items() if v} == {k: v for k, v in want.items() if v}
    assert len(blocks) == 1 if block > 1000 else len(blocks) > 10
    got = sorted(tuple(r) for r in divergence.audit(df, pair_rows=pair_rows).collect())
    assert got == brute_audit(rows)
    assert {r[2] for r in got} == {"pair", "term"}


def test_audit_edge_cases(spark, edge, empty):
    got = sorted(tuple(r) for r in divergence.audit(edge, min_documents=2).collect())
    assert got == brute_audit([(r[1], r[2], r[3]) for r in edge_rows()], least=2)
    assert divergence.audit(empty).count() == 0


def test_audit_needs_its_join_back(spark, monkeypatch):
    """Without the terms of the distinct chunks nothing is kept: the counts come from the factors."""
    rows = audit_rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "TERM", "nothing")
    assert {r["value"] for r in divergence.audit(df).collect()} == {0}


# --- quality classifier ---------------------------------------------------------

def plain_features(text, buckets=quality_classifier.BUCKETS):
    """Bucket counts of one text, one n-gram at a time."""
    q, full = quality_classifier, 2**64 - 1
    shift = 64 - (buckets.bit_length() - 1)

    def h(s):
        return sum(ord(c) * pow(q._FACTOR, i, 1 << 64) for i, c in enumerate(s)) & full

    out = Counter()
    found = re.findall("[^\x20\x09-\x0D]+", text)
    hashes = [h(w) * int(q._WORD) & full for w in found]
    for k, w in enumerate(found):
        out[hashes[k] >> shift] += 1
        if k:
            a, b = hashes[k - 1], hashes[k]
            out[(int(q._LEFT) if a == b else (a * int(q._LEFT) + b * int(q._RIGHT)) & full) >> shift] += 1
        wide = f" {w} "
        for n in q.NGRAMS:
            for i in range(len(wide) - n + 1):
                out[(h(wide[i:i + n]) * int(q._NGRAM[n]) & full) >> shift] += 1
    return out


TEXTS = ["", "a", "one two two", " lead and  trail \n", "né́ ▁ x\r\n日本語 \U0001f600\x00", "ab", "x" * 40,
         "one two two " * 30 + "end", "\t \n", "a b a b a b"]


def test_features_equal_plain_version():
    f = quality_classifier.Features()
    points, place = quality_classifier.joined([quality_classifier.code_points(t.encode()) for t in TEXTS])
    got = [Counter() for _ in TEXTS]
    for bucket, counted, first in f.of(points, place):
        for i in range(len(TEXTS)):
            own = slice(first[i], first[i + 1])
            got[i].update(bucket[own][counted[own]].tolist() if counted is not None else bucket[own].tolist())
    assert got == [plain_features(t) for t in TEXTS]


def test_scores_equal_the_network_on_mean_vectors(monkeypatch):
    rng = np.random.default_rng(1)
    net = quality_classifier.Network([0, 1, 2])
    net.vectors = rng.normal(0, 1, net.vectors.shape).astype(np.float32)
    net.bias = rng.normal(0, 1, 3).astype(np.float32)
    want = []
    for t in TEXTS + [None]:
        found = plain_features(t or "")
        mean = sum((net.vectors[b].astype(np.float64) * n for b, n in found.items()),
                   np.zeros(quality_classifier.DIMENSIONS)) / max(1, sum(found.values()))
        want.append(quality_classifier.softmax(mean @ net.layer.astype(np.float64) + net.bias))
    for part in (quality_classifier.PART_CHARS, 50, 64):     # a long text in parts is the same text
        if part < 1000:
            monkeypatch.setattr(quality_classifier, "GROUP_BYTES", 1)
            monkeypatch.setattr(quality_classifier.parts, "__defaults__", (part,))
        got = net.probabilities(quality_classifier.logits(quality_classifier.Features(), net.table(), pa.array(TEXTS + [None])))
        assert np.allclose(got, want, atol=1e-9)


def test_classifier_held_out(spark, small):
    got = catalog.op12_quality_classifier(spark, small.replace("0.001", "0.01")).join(
        spark.read.parquet(f"{small.replace('0.001', '0.01')}/labels.parquet"), "doc_id").where("held_out").collect()
    clean = [r["predicted"] for r in got if r["quality"] == 1]
    junk = [r["predicted"] for r in got if r["quality"] == 0]
    assert np.mean(clean) >= 0.97 and np.mean(junk) <= 0.1


def test_classifier_learns_no_held_out_label(spark, small):
    """Turned labels of held-out documents change no score."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    given = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = given.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_classifier.fit(docs, x, ~held) for x in (given, turned))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.layer, b.layer)


def test_classifier_edge_cases(spark, edge, empty, labels, monkeypatch):
    monkeypatch.setattr(quality_classifier, "STEPS", 300)
    every = F.lit(True)
    one = quality_classifier.fit(edge, labels, every)           # ids 1 and 9, 14: labels 1 and 0
    got = quality_classifier.predict(edge, one)
    assert got.count() == edge.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert got.where("doc_id = 2").select("score").distinct().count() == 1
    assert got.where("doc_id in (4, 5, 6, 8)").where("doc_id <> 8").select("score").distinct().count() == 1
    assert quality_classifier.predict(empty, one).count() == 0
    none = quality_classifier.fit(empty, labels, every)
    assert {r["score"] for r in quality_classifier.predict(edge, none).collect()} == {0.5}
    good = quality_classifier.fit(edge, labels.where("quality = 1"), every)
    assert {r["score"] for r in quality_classifier.predict(edge, good).collect()} == {1.0}


# --- lexical search -------------------------------------------------------------

def brute_search(docs, items, top=20):
    find = re.compile(lexical_search.TERM)
    split = lambda t: find.findall((t or "").translate(LOWER))
    held = [(d, Counter(split(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(split(t))
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in terms.items() if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def search_cases():
    docs = [(r[0], r[1]) for r in edge_rows()] + [(100 + k, "tie one word") for k in range(30)]
    docs += [(None, "tie one word"), (200, "A-a,a é日 ０word"), (201, "aa a_a"), (202, "x")]
    items = [(1, "one word one"), (2, "tie"), (3, None), (4, "???"), (5, "missing"), (6, "É é日 a A"), (2, "word"),
             (7, " ".join(edge_rows()[0][1].split()[:40])), (None, "word x")]
    return docs, items


@pytest.mark.parametrize("block_terms,cells,scan", [(200_000, 1 << 21, 1 << 20), (7, 60, 16)])
def test_search_equals_brute_force(spark, monkeypatch, block_terms, cells, scan):
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    docs, items = search_cases()
    if scan < 100:       # the same matches however the text is cut
        names = ["a", "one", "word", "é日", "tie"]
        auto = lexical_search.TermAutomaton(names)
        data = lexical_search._TABLE[np.frombuffer((" " + " tie ".join(t or "" for _, t in docs if len(t or "") < 9000) + " ").encode(), np.uint8)]
        whole = auto.scan(data)
        monkeypatch.setattr(lexical_search, "SCAN_BYTES", scan)
        assert np.array_equal(np.unique(whole, axis=0), np.unique(auto.scan(data), axis=0)) and len(auto.scan(data)) == len(whole)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in lexical_search.search(d, i, block_terms=block_terms).collect()), key=repr)
    assert got == brute_search(docs, items)


def test_search_edge_cases(spark, edge, empty):
    items = spark.createDataFrame([(1, "word one")], "item_id bigint, text string")
    got = lexical_search.search(edge.withColumn("item_id", F.lit(0)).withColumn("rank", F.lit(0)), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() >= 2
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(edge, items.limit(0)).count() == 0


def test_search_uses_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x"), ("j", "q")], "item_id string, text string")
    more = docs.unionByName(spark.createDataFrame([("z", "other words")], docs.schema))
    assert [r["doc_id"] for r in lexical_search.search(more, items).orderBy("rank").collect()] == ["a", "b", None]


def test_search_large_lengths():
    n = np.array([1, 10**9])
    assert lexical_search.lengths(n, 10**11, 10**20).tolist() == [75 + 25 * int(x) * 10**11 // 10**20 for x in n]
