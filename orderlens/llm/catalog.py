"""Queries of the corpus operators: key -> function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    chat_format, divergence, exact_dedup, language_id, lexical_search, license_scan, mixing, ngram_join,
    piece_encoding, quality, quality_classifier, substring_dedup, toxicity,
)
from orderlens.llm.common import Scratch, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "passages")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: A conversation whose texts look like control strings of common chat templates.
HOSTILE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(HOSTILE, turns.schema))
    out = chat_format.format_conversations(turns)
    back = chat_format.read_turns(F.col("formatted"))
    whole = F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    of_all = out.select("conv_id", F.struct(
        F.size(back).cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars")).alias("whole"))
    of_each = chat_format.trained_examples(out, chat_format.examples(turns)).select(
        "conv_id", F.struct("n", "trained").alias("one"))
    # a conversation without an example still has its row
    both = of_all.unionByName(of_each, allowMissingColumns=True).groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list("one")).alias("each"))
    trained = F.array_join(F.col("each.trained"), "")
    return both.select("conv_id", "whole.n_turns", "whole.turns_sha256",
                       F.length(trained).cast("bigint").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
                       "whole.formatted_chars", F.size("each").alias("n_examples"))


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn>' || role || chr(10) || text || '</turn>' || chr(10))
                + length(role || text) - length(translate(role || text, '\<', ''))
                + length(role) - length(translate(role, chr(10), ''))) AS BIGINT) AS formatted_chars,
       CAST(count(*) FILTER (role = 'assistant') AS INTEGER) AS n_examples
FROM t GROUP BY conv_id
"""


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_encoding.round_trip(docs)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.join(docs).select(F.col("id").alias("doc_id"), "class_id", "links")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return scored.select(
        "doc_id", *(f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "op9")
    index = exact_dedup.DigestIndex(spark, scratch.path("index"))
    counts, held = exact_dedup.load_falling(docs, index, scratch)
    held = scratch.write(held, "held")
    index.close()
    return exact_dedup.membership(counts, held).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("rows").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"))


OP9_SQL = """
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id
         AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept,
       text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(
        docs, F.array("source"), mixing.word_count(F.col("text")), mixing.seeded_key(F.col("doc_id"), text=F.col("text")), ["doc_id"],
    ).select("doc_id", "size", "source_size", "target", "taken", F.size("copies").alias("copies"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10
), v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY ALL
), n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT d.lang, d.source, coalesce(any_value(s.total), 0) AS total FROM d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) s USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (g.total + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (v.lang_total + 2 * v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(x.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  GROUP BY ALL
), part AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
WHERE part = 'pair' OR rank <= 10
"""


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    net = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_classifier.predict(docs, net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents
), t AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), corpus AS (SELECT count(DISTINCT r) AS n_docs, count(*) AS n_terms FROM t
), len AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r
), f AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM f, corpus GROUP BY term, n_docs
), s AS (
  SELECT i.item_id, f.r, len.doc_id, sum(i.times * w.w *
           ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * len.n * n_docs) // n_terms)))) AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN len USING (r), corpus GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""


QUERIES: dict[str, tuple[QueryFn, str | None]] = {
    "op1_language_id": (op1_language_id, None),
    "op2_toxicity": (op2_toxicity, None),
    "op3_substring_dedup": (op3_substring_dedup, None),
    "op4_chat_format": (op4_chat_format, OP4_SQL),
    "op5_piece_encoding": (op5_piece_encoding, None),
    "op6_ngram_join": (op6_ngram_join, None),
    "op7_license_scan": (op7_license_scan, None),
    "op8_quality_rules": (op8_quality_rules, None),
    "op9_exact_dedup": (op9_exact_dedup, OP9_SQL),
    "op10_mixing": (op10_mixing, None),
    "op11_divergence_audit": (op11_divergence_audit, OP11_SQL),
    "op12_quality_classifier": (op12_quality_classifier, None),
    "op13_lexical_search": (op13_lexical_search, OP13_SQL),
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, QueryFn]:
    return {k: f for k, (f, _) in QUERIES.items()} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in QUERIES.items() if s}
