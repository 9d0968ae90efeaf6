import hashlib
import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import edge, empty, labels, small  # noqa: F401  (fixtures)
from orderlens.llm import exact_dedup, hashing, ngram_join, substring_dedup
from orderlens.llm.common import Scratch

WORD = re.compile("[^\x20\x09-\x0D]+")


def indexed(spark, docs, batches=3):
    scratch = Scratch(spark, "test")
    index = exact_dedup.DigestIndex(spark, scratch.path("index"), 4)
    counts, held = exact_dedup.load_falling(docs, index, scratch, batches=batches)
    held = scratch.write(held, "held")
    index.close()
    assert not spark.catalog.tableExists(index.name)
    return counts, held


def test_exact_groups_and_index(spark, edge):
    counts, held = indexed(spark, edge)
    assert held.select("batch").distinct().count() > 1
    rows = exact_dedup.membership(counts, held).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r["digest"], []).append(r)
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert {r["id"] for r in empty} == {4, 5, 6} and {r["keep_id"] for r in empty} == {6} and empty[0]["rows"] == 3
    assert all(sum(r["kept"] for r in g) == 1 for g in by.values())
    kept = exact_dedup.drop_duplicates(edge, held)
    assert kept.columns == edge.columns and kept.count() == len(by)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["id"] or -1 for r in rows if r["kept"])


def test_exact_result_comes_from_the_anti_join(spark, empty, monkeypatch):
    """Copies stand in different batches; without the anti-join each batch would add its own."""
    docs = spark.createDataFrame([(i, f"text {i % 5}") for i in range(40)] + [(None, "text 1")], "doc_id bigint, text string")
    _, held = indexed(spark, docs, 4)
    assert sorted((r["keep_id"], r["batch"]) for r in held.collect()) == [(i, "load-0") for i in range(35, 40)]
    monkeypatch.setattr(exact_dedup.DigestIndex, "unseen", lambda self, groups: groups)
    _, broken = indexed(spark, docs, 4)
    assert broken.count() > 5
    monkeypatch.undo()
    counts, held = indexed(spark, empty.select("doc_id", "text"))
    assert counts.count() == held.count() == 0
    _, held = indexed(spark, docs.where("doc_id is null"))
    assert [r["keep_id"] for r in held.collect()] == [None]


def test_exact_index_over_batches(spark):
    path = Scratch(spark, "test").path("index")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    second = spark.createDataFrame([(3, "b"), (4, "c"), (5, "c")], "doc_id bigint, text string")
    exact_dedup.index_batch(first, exact_dedup.DigestIndex(spark, path, 4), "one")
    again = exact_dedup.DigestIndex(spark, path, 4)
    new = exact_dedup.index_batch(second, again, "two")
    assert [r["doc_id"] for r in exact_dedup.drop_duplicates(second, new).collect()] == [5]
    assert again.read().count() == 3
    # the anti-join reads the index by bucket, without an exchange of it
    plan = again.unseen(exact_dedup.digest_groups(second))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    exact_dedup.index_batch(first.limit(0), again, "none")
    assert again.read().count() == 3


def brute_join(rows, n=5, similarity=0.8):
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n
                    else frozenset([tuple(w)] if w else []))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= similarity * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        smallest[r] = min(smallest.get(r, (True, 0)), (d is None, d or 0))
    return sorted((d if d is not None else -1, links[i], None if smallest[root(i)][0] else smallest[root(i)][1])
                  for i, (d, _) in enumerate(rows))


def test_ngram_join_equals_brute_force(spark, edge, small):
    near = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    for i in range(300):                       # one large loose group, over two blocks
        w = list(base)
        for p in rng.integers(0, 120, rng.integers(1, 8)):
            w[p] = f"x{rng.integers(0, 50)}"
        near.append((1000 + i, " ".join(w)))
    near += [(5000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = spark.createDataFrame(near, "doc_id bigint, text string")
    got = sorted((r["id"] if r["id"] is not None else -1, r["links"], r["class_id"]) for r in ngram_join.join(df).collect())
    assert got == brute_join(near)


def test_near_copies_keep_one_each(spark, edge, empty):
    kept = ngram_join.drop_near_copies(edge)
    assert kept.columns == edge.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    assert ids == [-1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16]
    assert ngram_join.join(empty).count() == 0
    bands, rows = ngram_join.banding()
    assert 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.RECALL


def brute_repeats(rows):
    seen, out = {}, []
    split = sorted(((d is None, d or 0), WORD.findall(t or "")) for d, t in rows)
    for d, w in split:
        for p in range(len(w) - 19):
            k = tuple(w[p:p + 20])
            seen[k] = min(seen.get(k, (d, p)), (d, p))
    for d, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if seen[tuple(w[p:p + 20])] < (d, p):
                gone[p:p + 20] = [True] * 20
        out.append((-1 if d[0] else d[1], len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def test_substring_dedup_equals_brute_force(spark, edge, empty, small, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    rows += [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rng = np.random.default_rng(5)
    for i in range(60):                        # periodic and few-word texts
        rows.append((10_000 + i, " ".join(rng.choice(["a", "b", "c"][: 1 + i % 3], 40 + i))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_repeats(rows)
    for common in (substring_dedup.COMMON, 3):  # also with almost all anchors cut into single windows
        monkeypatch.setattr(substring_dedup, "COMMON", common)
        got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
                     for r in substring_dedup.remove_repeats(df).collect())
        assert got == want
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_fm_index_ranks_and_intervals():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(1, 6, 400), [0]])
    index = substring_dedup.FMIndex(text, 6)
    suffixes = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert index.suffixes.tolist() == suffixes
    starts = np.arange(390)
    alive, low, high, reached = index.intervals(text, starts, 4)
    grams = [tuple(text[i:i + 4]) for i in range(len(text) - 3)]
    for s, a, b in zip(starts[alive], low, high):
        assert b - a == grams.count(grams[s]) and {tuple(text[i:i + 4]) for i in index.suffixes[a:b]} == {grams[s]}
    assert set(alive) == {i for i in range(390) if grams.count(grams[i]) > 1}
    assert (reached[alive] == 4).all() and (np.delete(reached, alive) < 4).all()


def test_word_spans_and_grams():
    import pyarrow as pa
    column = pa.array(["a b  c", None, "", " x", "tail \t", "a b c d e f"])
    (lo, data, offsets), = hashing.text_groups(column)
    starts, ends, first = hashing.word_spans(data, offsets, hashing.separator_table())
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(starts, ends)] == [b"a", b"b", b"c", b"x", b"tail"] + [bytes([c]) for c in b"abcdef"]
    assert np.diff(first).tolist() == [3, 0, 0, 1, 1, 6]
    grams, at = hashing.row_grams(hashing.word_hashes(data, starts, ends), first, 5)
    assert np.diff(at).tolist() == [1, 0, 0, 1, 1, 2] and len(set(grams.tolist())) == 5
