"""Quality rules: repetition and length rules, then a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed to a fixed number of buckets.  Two
multinomials over the buckets are estimated, one from the trusted target texts
and one from the whole corpus, both with the same additive prior.  A document's
score is the mean over its n-grams of log(target / corpus); every document with
a score below the threshold is rejected.  All of it is built-in expressions: the
counts are one aggregation to ``BUCKETS`` rows, the ratios travel as one array of
that fixed length.

The threshold follows the corpus: a fifth of the trusted documents (by a hash of the id) is
left out of the target counts, and the threshold lies ``SPREADS`` times the distance between
the median and the lower sixth of their scores below the median.  Both are exact quantiles over all of
them.

Defined cases: null or word-less text has zero counts, score 0 and fails the length
rule; an empty corpus or no trusted text gives equal multinomials, so every
score is 0 and only the rules decide; so do they without a trusted document among
those left out.  Documents without an id are never left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, free_name, let, words
from orderlens.operators.quantiles import quantiles_row

BUCKETS = 10_000
PRIOR = 1.0
#: Of a normal distribution of scores the threshold loses 1 good document in 30,000.
SPREADS = 4.0
#: Quantiles of the median and one standard deviation below it.
CENTRE, LOWER = 0.5, 0.16

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"


def ngram_buckets(w: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of the unigrams and bigrams of the word array ``w``."""
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.pmod(
        F.xxhash64(F.get(w, i), x), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def log_ratios(texts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """One row with ``ratios``: array of log(target / corpus) by bucket.

    ``texts`` has ``text`` and boolean ``trusted``.
    """
    grams = texts.select(
        F.coalesce("trusted", F.lit(False)).alias("trusted"),
        F.explode(let(words(F.col("text")), lambda w: ngram_buckets(w, buckets))).alias("bucket"))
    counted = grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("corpus"), F.sum(F.col("trusted").cast("bigint")).alias("target"))
    # every bucket once, seen or not, so that the array has a place for each
    spark = texts.sparkSession
    every = spark.range(0, buckets, 1, 1).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("corpus"),
        F.lit(0).cast("bigint").alias("target"))
    full = counted.unionByName(every).groupBy("bucket").agg(
        F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))
    row = full.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "corpus", "target"))).alias("b"),
        F.sum("corpus").alias("all_corpus"), F.sum("target").alias("all_target"))
    share = lambda n, total: (n + F.lit(prior)) / (F.col(total) + F.lit(prior * buckets))
    return row.select(F.when(F.col("all_target") == 0, F.transform("b", lambda x: F.lit(0.0))).otherwise(
        F.transform("b", lambda x: F.log(share(x["target"], "all_target") / share(x["corpus"], "all_corpus")))
    ).alias("ratios"))


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window whose words occur as a window twice or more."""
    n = F.size(w)

    def covered(h):
        # windows in the order of (hash, start): equal windows are neighbours
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(F.filter(
            F.transform(s, lambda x, j: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"])))
        # a window adds its three words less those that the next one covers too
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.slice(w, 3, F.greatest(n - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), x))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.trim(
        x, F.lit(" \t\n\x0b\x0c\r")) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measure(docs: DataFrame, ratios: Column, text_col: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, score, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    features = let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("bigint").alias("word_chars"),
        repeated_words(w).cast("bigint").alias("n_repeat_words"),
        let(ngram_buckets(w), lambda g: F.when(F.size(g) > 0, F.aggregate(
            g, F.lit(0.0), lambda a, x: a + F.get(ratios, x)) / F.size(g)).otherwise(0.0)).alias("score")))
    f = let(F.struct(features.alias("f"), F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
                     duplicate_lines(text).cast("bigint").alias("n_dup_lines")), lambda x: F.struct(
        x["f"]["n_words"].alias("n_words"), x["f"]["word_chars"].alias("word_chars"),
        x["n_symbols"].alias("n_symbols"), x["n_dup_lines"].alias("n_dup_lines"),
        x["f"]["n_repeat_words"].alias("n_repeat_words"), x["f"]["score"].alias("score"),
        base_failed(x["f"]["n_words"], x["f"]["n_repeat_words"]).alias("base_failed")))
    return docs.withColumn(out, f)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def left_out(id_col: str = "doc_id") -> Column:
    """Trusted documents that set the threshold and do not count for the target."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def good_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted); a document labelled more than once counts once."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("quality") == 1).alias("trusted"))


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Ratios (one stored row): documents labelled quality 1, but those left out, are the trusted target,
    all documents the raw corpus."""
    trusted = good_ids(labels).select("doc_id", (F.col("trusted") & ~left_out()).alias("trusted"))
    # the label side is the small one of each partition; the text side needs no sort
    texts = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), "doc_id", "left")
    return Scratch(docs.sparkSession, "quality").write(log_ratios(texts), "ratios")


def threshold(measured: DataFrame, labels: DataFrame, out: str = "quality") -> float | None:
    """Threshold from the scores of the trusted documents left out, or None without any.  ``measured``: stored (doc_id, out)."""
    good = good_ids(labels).where(F.col("trusted") & left_out())
    scores = measured.select("doc_id", F.col(out)["score"].alias("__score"), F.col(out)["base_failed"].alias("__failed")) \
        .join(good, "doc_id").where(~F.col("__failed"))
    q = quantiles_row(scores, "__score", [CENTRE, LOWER], ["centre", "lower"]).first()
    return None if q["centre"] is None else q["centre"] - SPREADS * (q["centre"] - q["lower"])


def score(docs: DataFrame, labels: DataFrame, out: str = "quality", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (by default all) of ``docs``, and the struct column ``out``, with ``kept``.  The
    ratios, ``BUCKETS`` numbers whatever the corpus size, become one constant of the plan; the scores are stored,
    since the threshold needs those of the documents left out first."""
    ratios = fit(docs, labels).first()["ratios"]
    constant = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    kept = list(dict.fromkeys([*(carry or docs.columns), "doc_id"]))
    measured = Scratch(docs.sparkSession, "quality").write(measure(docs, constant, out=out).select(*kept, out), "measured")
    least = threshold(measured, labels, out)
    verdict = ~F.col(out)["base_failed"]
    if least is not None:
        verdict = verdict & (F.col(out)["score"] >= least)
    return measured.select(*(carry or docs.columns), F.col(out).withField("kept", verdict).alias(out))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns only."""
    name = free_name(docs, "quality")
    return score(docs, labels, out=name).where(F.col(name)["kept"]).select(*docs.columns)
