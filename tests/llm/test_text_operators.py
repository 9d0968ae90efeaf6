import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import edge, empty, labels, small  # noqa: F401  (fixtures)
from orderlens.llm import catalog, chat_format, language_id, license_scan, piece_encoding, quality, toxicity

WORD = re.compile("[^\x20\x09-\x0D]+")


# --- quality rules --------------------------------------------------------------

def brute_quality(texts, trusted, left_out, buckets=quality.BUCKETS):
    """``trusted``: texts that count for the target; ``left_out``: trusted texts that set the threshold."""
    def grams(w):
        h = lambda s, seed=42: xxhash.xxh64_intdigest(s.encode(), seed)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        one = [signed(h(x)) % buckets for x in w]
        return one + [signed(h(b, h(a))) % buckets for a, b in zip(w, w[1:])]

    counts = np.zeros((2, buckets))
    split = [WORD.findall(t or "") for t in texts]
    for w, good in zip(split, trusted):
        for g in grams(w):
            counts[0, g] += 1
            counts[1, g] += good
    share = [(c + quality.PRIOR) / (c.sum() + quality.PRIOR * buckets) for c in counts]
    ratio = np.log(share[1] / share[0]) if counts[1].sum() else np.zeros(buckets)
    out = []
    for t, w in zip(texts, split):
        t = t or ""
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        covered = set()
        for k, g in enumerate(tri):
            if tri.count(g) > 1:
                covered |= {k, k + 1, k + 2}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        g = grams(w)
        score = float(np.mean([ratio[x] for x in g])) if g else 0.0
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((len(w), sum(map(len, w)), len(re.findall(quality.SYMBOLS, t)), len(lines) - len(set(lines)),
                    len(covered), failed, score))
    of = [x[6] for x, chosen in zip(out, left_out) if chosen and not x[5]]
    least = -np.inf
    if of:
        centre, lower = np.quantile(of, 0.5), np.quantile(of, 0.16)
        least = centre - 4 * (centre - lower)
    return out, least


def test_quality_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where(F.length("text") < 2500)
    labels = spark.read.parquet(f"{small}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(-1, None), (-2, ""), (-3, "a b c " * 40), (-4, "a a a a\nb\n\nb\n \t\nb"), (-5, "* " * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    chosen = [d in good and zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in rows]
    assert sum(chosen) >= 5
    want, least = brute_quality([t for _, t in rows], [d in good and not c for (d, _), c in zip(rows, chosen)], chosen)
    got = {r["doc_id"]: r["quality"] for r in quality.score(df, labels).collect()}
    for (d, _), w in zip(rows, want):
        q = got[d]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"],
                q["base_failed"]) == w[:6], d
        assert q["score"] == pytest.approx(w[6], abs=1e-9)
        assert q["kept"] == (not w[5] and w[6] >= least) or abs(w[6] - least) < 1e-9


def test_quality_keeps_good_documents(spark, small):
    """Good documents that count for nothing are kept, most junk goes; no labelled document sets both sides."""
    folder = small.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.select("doc_id", "text"), labels, out="q", carry=["doc_id"])
    rows = scored.join(labels, "doc_id").where("not q.base_failed").select(
        "quality", "q.kept", quality.left_out().alias("out")).collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert np.mean(good) >= 0.99 and np.mean([r["kept"] for r in rows if r["quality"] == 1 and r["out"]]) >= 0.97
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) <= 0.25
    turned = labels.withColumn("quality", F.when(quality.left_out() & (F.col("quality") == 1), 0).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x).first()["ratios"] for x in (labels, turned))
    assert a == b


def test_quality_edge_cases(spark, edge, empty, labels):
    assert quality.keep(edge, labels).columns == edge.columns
    got = {r["doc_id"]: r["quality"] for r in quality.score(edge, labels).collect()}
    assert got[11]["n_repeat_words"] == 3000 and got[11]["base_failed"] and got[4]["base_failed"]
    assert not got[12]["base_failed"]
    assert quality.keep(empty, labels).count() == 0
    assert quality.score(edge, labels.limit(0)).where("quality.score != 0 or quality.kept = quality.base_failed").count() == 0


# --- pieces -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=piece_encoding.MODEL)


def random_texts(seed, count):
    rng = random.Random(seed)
    parts = ["a", "aa", "the", "ing", " ", "  ", "é", "日", "語", "\n", "x", "zz", "ß", "😀", "▁", "0", "(", "hello", "      "]
    for i in range(count):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(60, 300)))
        yield x.replace(" ", "") if i % 4 == 0 else "a" * (70 + i) if i % 9 == 0 else " " * (70 + i) if i % 11 == 0 else x


def test_pieces_equal_the_library(spark, edge, empty, library, small):
    docs = edge.unionByName(spark.read.parquet(f"{small}/documents.parquet").withColumns(
        {c: F.lit(None).cast("string") for c in edge.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")}))
    want = sorted((r["doc_id"] or -1, library.encode(r["text"] or "")) for r in docs.select("doc_id", "text").collect())
    for chunk in (piece_encoding.CHUNK, 64):
        out = piece_encoding.round_trip(docs, chunk=chunk)
        assert out.columns == [c for c in docs.columns if c != "text"] + ["ids", "n_pieces", "round_trip"]
        rows = out.select("doc_id", "ids", "round_trip").collect()
        assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in rows) == want
        assert all(r["round_trip"] for r in rows)
    assert piece_encoding.round_trip(empty).count() == 0


def test_chunks_of_awkward_texts(spark, library):
    rows = list(enumerate(random_texts(2, 60)))
    df = spark.createDataFrame(rows, "n bigint, text string")
    for chunk in (34, 50):
        got = {r["n"]: list(r["ids"]) for r in piece_encoding.encode(df, chunk=chunk).collect()}
        assert all(got[n] == library.encode(t) for n, t in rows)


def test_merges_at_once_equal_the_single_procedure():
    lattice = piece_encoding.Lattice(piece_encoding.Vocabulary.load())
    rng = random.Random(5)
    parts = ["a", "e", "th", "ing", "tion", "s", "é", "日", "😀", "▁", "0", "(", ".", "\n", "ß", "\u0301", "hello"]
    strings = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(3000)] + ["a" * 23, "x"]
    for some in (strings, strings[:1], ["0"], ["0", "aaa", "日"]):
        got = [x if isinstance(x, bytes) else lattice.spelled(x) for x in lattice.merges.encode(some)]
        assert got == [lattice.ids(lattice.merge(x)) for x in some]


def test_words_are_merged_once(monkeypatch):
    """Slices and chunks have their missing words merged together, frequent ones never again, and tasks share a lattice."""
    vocabulary = piece_encoding.Vocabulary.load()
    assert piece_encoding.lattice_of(vocabulary) is piece_encoding.lattice_of(piece_encoding.Vocabulary.load())
    monkeypatch.setattr(piece_encoding, "KEPT", {})
    monkeypatch.setattr(piece_encoding, "MEMO", 40)
    seen, single = [], []
    merges, merge = piece_encoding.Merges.encode, piece_encoding.Lattice.merge
    monkeypatch.setattr(piece_encoding.Merges, "encode", lambda self, x: seen.extend(x) or merges(self, x))
    monkeypatch.setattr(piece_encoding.Lattice, "merge", lambda self, x: single.append(x) or merge(self, x))
    lattice = piece_encoding.lattice_of(vocabulary)
    for k in range(10):
        lattice.encode_all(["often here " + " ".join(f"w{k}x{i}" for i in range(20)) + "\nhere often"])
    assert seen.count("▁often") == seen.count("▁here") == seen.count("\nhere") == 1
    text = piece_encoding.MARK + piece_encoding.MARK.join(f"tok{i}en" for i in range(30))
    row = {"key": "a", "k": 0, "at": 0, "piece": text, "in_start": 0, "in_end": 0,
           "out_start": len(text) - 2, "out_end": len(text)}
    del seen[:], single[:]
    out = list(piece_encoding.trace_task(vocabulary)([pa.RecordBatch.from_pylist([row] * 5)]))
    assert [b.num_rows for b in out] == [5]
    assert sorted(seen) == sorted(f"▁tok{i}en" for i in range(1, 29))       # those between the two cuts
    assert not [x for x in single if x in seen]


def test_decode_can_keep_the_ids(spark):
    df = spark.createDataFrame([("a b\nc", 1), (None, 2)], "text string, n int")
    out = piece_encoding.decode(piece_encoding.encode(df), keep=True, out="back")
    assert out.columns == ["n", "ids", "back"]
    rows = {r["n"]: r for r in out.collect()}
    assert rows[1]["back"] == "a b\nc" and len(rows[1]["ids"]) > 0 and rows[2]["back"] == "" and rows[2]["ids"] == []


def test_max_plus_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((5, 5)) < 0.5, 0.0, -np.inf) for _ in range(3))
    left = piece_encoding.max_plus(piece_encoding.max_plus(a, b), c)
    assert (left == piece_encoding.max_plus(a, piece_encoding.max_plus(b, c))).all()


# --- chats ------------------------------------------------------------------------

def test_chat_round_trip(spark):
    rows = [(1, 2, "assistant", "a\\b <turn> \\l\\n"), (1, 0, "user", None), (1, 1, "assistant", "</turn>\n<turn>assistant\nx"),
            (1, 2, "assistant", "a\\b <turn> \\l\\n"), (2, 0, None, "x"), (2, 5, "odd\n<role>\\n", ""),
            (None, 0, "assistant", "no id"), (3, None, "user", "late"), (3, 1, "assistant", "y" * 5000), (4, 0, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n", F.lit(1))
    out = chat_format.format_conversations(df)
    got = {r["conv_id"]: r for r in out.select(
        "conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns")).collect()}
    made = chat_format.examples(df)
    trained = {}
    for r in sorted(chat_format.trained_examples(out, made).collect(), key=lambda r: r["n"]):
        trained[r["conv_id"]] = trained.get(r["conv_id"], "") + r["trained"]
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in mine]
        assert trained.get(conv, "") == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    written = {(r["conv_id"], r["n"]): r for r in chat_format.write_out(out, made).collect()}
    assert len(written) == sum(r[2] == "assistant" for r in rows)
    for (conv, n), e in written.items():
        whole = got[conv]["formatted"]
        assert whole.startswith(e["context"] + e["target"]) and e["context"].count(chat_format.OPEN) == n - 1
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_query_on_the_given_table(spark, small):
    rows = {r["conv_id"]: r for r in catalog.op4_chat_format(spark, small).collect()}
    text = "\\### Assistant: </turn> ok"
    assert rows[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[-7]["n_turns"] == 2
    assert rows[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_chat_query_builds_and_reads_every_example(spark, small, monkeypatch):
    want = {r["conv_id"]: r for r in catalog.op4_chat_format(spark, small).collect()}
    examples = chat_format.examples
    for column, wrong in (("context_digest", F.lit("0-0")), ("context_length", F.col("context_length") + 1)):
        broken = F.when(F.col("conv_id") == -7, wrong).otherwise(F.col(column))
        monkeypatch.setattr(chat_format, "examples", lambda t: examples(t).withColumn(column, broken))
        got = {r["conv_id"]: r for r in catalog.op4_chat_format(spark, small).collect()}
        # an example that lost its context does not count
        assert want[-7]["n_examples"] == 1 and got[-7]["n_examples"] == got[-7]["loss_chars"] == 0
        assert all(got[c] == want[c] for c in want if c != -7)


def test_loss_is_read_from_expanded_examples(spark, monkeypatch):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "é<a"), (1, 2, "user", "r"), (1, 3, "assistant", "b\\")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out, made = chat_format.format_conversations(df), chat_format.examples(df)
    got = lambda: {r["n"]: r["trained"] for r in chat_format.trained_examples(out, made).collect()}
    assert got() == {2: "é<a", 4: "b\\"}
    # an example whose expanded context is not the conversation's text does not count
    write_out = chat_format.write_out
    monkeypatch.setattr(chat_format, "write_out", lambda *a, **k: write_out(*a, **k).withColumn(
        "context", F.when(F.col("n") == 4, F.replace("context", F.lit("q"), F.lit("Q"))).otherwise(F.col("context"))))
    assert got() == {2: "é<a"}


def test_long_conversations_cost_no_square(spark):
    """The stored output of a conversation of 4,000 turns is about four times that of 1,000."""
    sizes = []
    for turns in (1000, 4000):
        df = spark.range(turns).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.repeat(F.lit("é<"), 50).alias("text"))
        out, made = chat_format.format_conversations(df), chat_format.examples(df)
        assert chat_format.trained_examples(out, made).where(F.length("trained") == 100).count() == turns // 2
        sizes.append(made.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] + out.agg(F.sum(F.length("formatted"))).first()[0])
    assert 3.9 < sizes[1] / sizes[0] < 4.2


# --- licences ---------------------------------------------------------------------

def test_license_scan(spark, edge, empty):
    rows = [(1, "Released under the MIT License. under the mit-license!"), (2, "Released under teh MIT Licence"),
            (3, "This work is licensed under the GNU Generel Public License, version 3."), (4, None), (5, ""),
            (6, "CC BY-NC 4.0"), (7, "ÀB under\x00the\x7fmit license Apache License, Version 2.0"),
            (8, "under the mit licensee"), (9, "x " * 5000 + "under the MIT license"), (9, "cc by nc cc by nc")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("labels", F.lit("clash"))
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
           for r in license_scan.scan(df).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 9, 2, 1, 5, "mit", "mit"), (2, 5, 0, None, None, "", "mit"), (3, 12, 0, None, None, "", "gpl"),
        (4, 0, 0, None, None, "", ""), (5, 0, 0, None, None, "", ""), (6, 5, 1, 0, 0, "cc-by-nc", "cc-by-nc"),
        (7, 10, 2, 1, 5, "apache-2,mit", "apache-2,mit"), (8, 4, 0, None, None, "", ""),
        (9, 5004, 1, 5000, 5000, "mit", "mit"), (9, 6, 2, 0, 3, "cc-by-nc", "cc-by-nc")], key=str)
    assert license_scan.scan(edge).count() == edge.count() and license_scan.scan(empty).count() == 0


def test_seeds_find_every_match_within_the_bound():
    import regex
    rng = random.Random(8)
    scanner = license_scan.Scanner()
    for notice, label, edits, _, pattern in scanner.notices:
        for _ in range(40):
            x = list(notice)
            for _ in range(rng.randint(0, edits)):
                p = rng.randrange(len(x))
                x[p:p + 1] = rng.choice([[], ["q"], [x[p], "z"]])
            words = license_scan.normalise("aa bb " + "".join(x) + " cc")
            if regex.search(pattern, words.decode()):
                assert label in {f[2] for f in scanner.fuzzy(words)}, "".join(x)


@pytest.mark.parametrize("text, labels", [
    ("released under the bsd license", []), ("released under the gpl license", []), ("released under the submit license", []),
    ("gnu lesser general public license", ["lgpl"]), ("gnu affero general public license", []),
    ("lesser general public license", []), ("gnu general public license", ["gpl"]),
    ("licensed under cc by sa 4", []), ("licensed under cc by nd 4", []), ("licensed under cc by 4", []),
    ("licensed under the apache license version 1 1", []), ("licensed under the apache license version 12", []),
    ("licensed under the apache licence version 2 0", ["apache-2"]), ("licensed undr cc by nc 4", ["cc-by-nc"]),
    ("creative commons attribution commercial", []), ("creative commons attribution non commercial", ["cc-by-nc"]),
    ("permission is not hereby granted free of charge to any person obtaining a copy", []),
    ("the gnu generel public licence", ["gpl"]), ("released under teh mitt license", ["mit"])])
def test_notices_of_other_licences_get_no_label(text, labels):
    found = license_scan.Scanner().fuzzy(license_scan.normalise(f"aa {text} bb"))
    assert sorted({f[2] for f in found}) == labels


def test_close_notices_and_wide_characters_are_found():
    scan = lambda t: license_scan.Scanner().fuzzy(license_scan.normalise(t))
    # the worse match stands before the better one
    assert [(a, b, c) for a, b, c, _ in scan("gnu generl public license gnu general public license")] == [
        (0, 3, "gpl"), (4, 7, "gpl")]
    three = scan("x gnu general publc license gnu generl public license gnu general public license gnu general public licens")
    assert [(a, b) for a, b, *_ in three] == [(1, 4), (5, 8), (9, 12), (13, 16)]
    # six edits, most of them to characters of four bytes
    wide = "permission is hereby granted free of charge to any person obtaining a copy".replace("person", "😀erson")
    wide = wide.replace("copy", "c😀y").replace("obtaining", "😀bt😀ining😀")
    assert [(a, b, c) for a, b, c, _ in scan("aa " + wide + " bb")] == [(1, 13, "mit")]
    ends = "permissi😀n is hereby granted free of charge to any person obtaining a " + "😀" * 4 + "😀"
    assert [c for *_, c, _ in scan("aa " + ends + " bb")] == ["mit"]


def test_long_runs_of_notices_are_all_found_in_linear_time(monkeypatch):
    import time
    scanner = license_scan.Scanner()
    took = []
    for repeats in (2_000, 8_000):
        words = license_scan.normalise("licensed undr cc by nc 4 é " * repeats)
        start = time.process_time()
        found = scanner.fuzzy(words)
        places = scanner.exact(words, license_scan.places_of_blanks(words))
        took.append(time.process_time() - start)
        assert [(a, b) for a, b, c, _ in found] == [(7 * k, 7 * k + 5) for k in range(repeats)]
        assert [p for p, _ in places] == [7 * k + 2 for k in range(repeats)]
    assert took[1] < 8 * took[0]
    # stretches of any length give the places that one whole window gives
    text = "licensed under cc by nc 4 xx gnu generl public license licensed undr cc by nc 4 " * 5 + "日本 gnu general publc license"
    whole = None
    for stretch in (1000, 8, 3, 2):
        monkeypatch.setattr(license_scan, "STRETCH", stretch)
        got = scanner.fuzzy(license_scan.normalise(text))
        whole = whole or got
        assert sorted(got) == sorted(whole) and len(got) == 16


def test_license_base_columns_equal_brute_force(spark, small):
    """Whole ``documents``: words, places of base phrases and base labels, counted word by word."""
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    phrases = [(p.split(), label) for p, label in license_scan.BASE]
    for r in docs.collect():
        w = word.findall((r["text"] or "").translate(lower))
        places = [(i, label) for i in range(len(w)) for p, label in phrases if w[i:i + len(p)] == p]
        g, at = got[r["doc_id"]], [i for i, _ in places]
        base = {label for _, label in places}
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == (
            len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)))
        assert base <= set(g["labels"].split(",")) and 0 <= g["score"] <= 1 and (g["score"] == 1) >= bool(places)


# --- language and toxicity ----------------------------------------------------------

def test_language_held_out_accuracy(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language_id.fit(docs, ~held)
    test = language_id.predict(docs.where(held), model).join(docs.select("doc_id", "lang", "text"), "doc_id")
    right = test.where(F.length("text") >= 100).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    rows = language_id.predict(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert got[4] == got[5] == got[7] == got[14] == ("und", 0.0) and got[8][0] in model[0]
    assert language_id.fit(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.predict(edge, None).collect()} == {"und"}
    # a text's result is the mean over its windows, however the batch is cut
    names, net = model
    data = np.frombuffer(("the of and " * 60).encode(), np.uint8)
    one = language_id.predict_group(net, data, np.array([0, len(data)]))
    two = language_id.predict_group(net, np.concatenate([data, data]), np.array([0, len(data), 2 * len(data)]))
    assert np.allclose(one[0], two[0]) and np.allclose(two[0], two[1])


def test_language_sample_moves_windows_only(spark):
    rows = [(1, "the of and " * 50_000, "en"), (2, "le la et", "fr"), (3, "é" * 400, "fr"), (4, None, "fr"), (5, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = sorted((r["lang"], bytes(r["pieces"])) for r in language_id.sample(docs, F.lit(True)).collect())
    assert got == sorted((lang, np.concatenate(language_id.sample_windows(text.encode())).tobytes())
                         for _, text, lang in rows[:3])
    assert max(len(p) for _, p in got) == 3 * 259


def brute_segments(values):
    """All maximal-scoring segments by recursion: the best one (leftmost, shortest), then left and right of it."""
    best = None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                best = (i, j, total)
    if best is None:
        return []
    i, j, s = best
    shift = lambda part, by: [(a + by, b + by, t) for a, b, t in part]
    return brute_segments(values[:i]) + [(i, j, s)] + shift(brute_segments(values[j + 1:]), j + 1)


def test_segments_equal_the_recursive_definition():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 40)
        hits = [(i, rng.uniform(0.1, 3)) for i in range(n) if rng.random() < 0.3]
        values = [-toxicity.DRIFT * 3] * n
        for i, v in hits:
            values[i] = v
        got = toxicity.segments(hits, toxicity.DRIFT * 3)
        want = brute_segments(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxicity_held_out(spark, edge, empty, labels):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(600):
        w = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["vileword", "nastystem" + rng.choice("xyz"), "scum"])
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, marked, ~held)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = sum((got[i]["score"] >= 0.7) != bool(t) for i, _, t in marks)
    assert wrong <= 6
    hit = next(got[i] for i, _, t in marks if t and got[i]["passages"])
    words = dict(rows)[hit["doc_id"]].split()
    assert any(x in words[hit["passages"][0]["first_word"]] for x in ("vile", "nasty", "scum"))
    assert toxicity.score(edge, model).count() == edge.count()
    assert toxicity.fit(empty, labels, F.lit(True)) is None
    assert toxicity.fit(edge, labels.limit(0), F.lit(True)) is None
    assert all(r["score"] < 0.01 for r in toxicity.score(edge, None).collect())


def test_toxicity_with_more_tokens_than_are_broadcast(spark, edge, monkeypatch):
    """Every token above the thresholds counts, and the join with the weight table gives what the broadcast gives."""
    rng = random.Random(9)
    vile = ["qq" + "".join(rng.choice("mnop") for _ in range(5)) for _ in range(40)]
    rows, marks = [], []
    for i in range(900):
        w = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(rng.randint(20, 60))]
        if i % 3 == 0:
            # the later words are rarer, so a cut by z would drop them first
            k = i // 3 % len(vile)
            w[rng.randrange(len(w))] = vile[k]
            w[rng.randrange(len(w))] = vile[k // 2]
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(i % 3 == 0)))
    rows += [(0, rows[0][1]), (-1, None), (None, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")

    def results(model):
        return sorted(((r["doc_id"], round(r["evidence"], 9), round(r["score"], 9), [
            (p["first_word"], p["last_word"], round(p["score"], 9)) for p in r["passages"]])
            for r in toxicity.score(docs.unionByName(edge.select("doc_id", "text")), model).collect()), key=str)

    held = toxicity.fit(docs, marked, F.lit(True))
    want = results(held)
    assert isinstance(held.weights, dict) and len(held.weights) > 10
    monkeypatch.setattr(toxicity, "BROADCAST_TOKENS" if hasattr(toxicity, "BROADCAST_TOKENS") else "VOCABULARY", 10)
    joined = toxicity.fit(docs, marked, F.lit(True))
    assert results(joined) == want
    assert isinstance(joined.weights, toxicity.WeightTable) and joined.weights.rows.count() == len(held.weights)
    # an almost full bitmap lets every token through, which changes nothing
    monkeypatch.setattr(toxicity, "FILTER_BITS", 8)
    assert results(toxicity.fit(docs, marked, F.lit(True))) == want


def test_scan_takes_part_in_the_given_table(spark, monkeypatch):
    """Some texts of ``documents`` go through the chunks: without their matrices the query's ids are gone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    giant = docs.where(F.length("text") >= 2 * piece_encoding.CHUNK).count()
    assert giant >= 5
    monkeypatch.setattr(piece_encoding, "resolve_task", lambda frame: frame[["key", "k"]].iloc[:0].assign(
        in_start=0, in_end=0, out_start=0, out_end=0))
    assert catalog.op5_piece_encoding(spark, "/root/testdata/sf0.01").count() == docs.count() - giant


def test_memo_is_bounded_by_characters():
    memo = piece_encoding.Memo(len)
    for i in range(300):
        memo[f"{i}" + "x" * 10_000]
        assert sum(map(len, memo)) <= piece_encoding.MEMO_CHARACTERS
    assert memo["x" * (2 * piece_encoding.MEMO_CHARACTERS)] == 2 * piece_encoding.MEMO_CHARACTERS and len(memo) == 1
