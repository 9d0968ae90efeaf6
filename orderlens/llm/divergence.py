"""Source divergence audit: which sources of a language use its terms alike, and which terms set one apart.

Chunk factorization.  The task that reads a block of documents counts the blank-separated
chunks of each and writes one row for each (block, chunk): the document of every
occurrence, two bytes each.  Each globally distinct chunk is then cut into terms once, its
terms are joined back to the rows of the chunk, and a block's rows meet again, where a
document that reaches one term through several chunks counts once.  So no row per
word or per (document, chunk) is ever shuffled.

Every group (lang, source) is compared with the other groups of its language over all
kept terms (part ``pair``) and with the whole language term by term (part ``term``).
All numbers are exact integers.

Defined cases: null text, lang and source are ''; every row is a document of its own,
repeated rows and null ids too; a group without terms has its rows with count 0
everywhere; a language without a kept term has pairs of value 0 and no terms; an empty
table gives no rows; equal values rank by item in code point order.  A text without
blanks is one chunk.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A term is kept in a language if so many of its documents hold it.
MIN_DOCUMENTS = 10
TOP_TERMS = 10
#: Text bytes and documents of a block, whose chunks are counted together (a longer text is a block of its own).
BLOCK_BYTES = 24 << 20
BLOCK_DOCUMENTS = 1 << 16
#: Bytes of a text that are split into chunks at a time.
PIECE_BYTES = 4 << 20
#: Rows (term, source) of a language whose pairs are summed in one task.
PAIR_ROWS = 200_000
#: Cells of the (source, term) matrix that are compared at once.
PAIR_CELLS = 1 << 20
CHUNKS_PER_BATCH = 20_000

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text: bytes, size: int = PIECE_BYTES):
    """``text`` in parts of about ``size`` bytes, cut at blanks only."""
    at = 0
    while len(text) - at > size:
        blank = _BLANK.search(text, at + size)
        if not blank:
            break
        yield text[at:blank.start()]
        at = blank.start()
    yield text[at:] if at else text


class Block:
    """Documents of one block, by group."""

    def __init__(self):
        self.documents: list[tuple[str, str, bytes]] = []
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        self.documents.append((lang, source, text))
        self.size += len(text)

    def full(self, text: bytes) -> bool:
        return bool(self.documents) and (
            self.size + len(text) > BLOCK_BYTES or len(self.documents) >= BLOCK_DOCUMENTS)

    def groups(self) -> list[tuple[str, str, int]]:
        """(lang, source, end): the sorted documents up to ``end`` are those of this group and the ones before."""
        self.documents.sort(key=lambda d: d[:2])
        out: list[tuple[str, str, int]] = []
        for i, (lang, source, _) in enumerate(self.documents):
            if out and out[-1][:2] == (lang, source):
                out.pop()
            out.append((lang, source, i + 1))
        return out

    def chunks(self):
        """(chunks, first, documents): documents[first[i]:first[i + 1]] are those of the occurrences of chunk i."""
        codes: dict[bytes, int] = defaultdict()
        codes.default_factory = codes.__len__
        runs, size = [np.zeros(0, np.int64)], len(self.documents)
        for i, (_, _, text) in enumerate(self.documents):
            for piece in pieces(text):
                found = piece.split()
                runs.append(np.fromiter(map(codes.__getitem__, found), np.int64, len(found)) * size + i)
        held = np.sort(np.concatenate(runs))
        first = np.searchsorted(held, np.arange(len(codes) + 1) * size)
        return list(codes), first, (held % max(1, size)).astype("<u2")


BLOCK_SCHEMA = "block bigint, chunk string, docs binary, groups array<struct<lang:string,source:string,until:int>>"
_GROUPS = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string()), ("until", pa.int32())]))


def count_chunks(batches):
    """(part, lang, source, text) -> rows (block, chunk, docs), and one row (block, groups) for each block."""
    schema = pa.schema([("block", pa.int64()), ("chunk", pa.string()), ("docs", pa.binary()), ("groups", _GROUPS)])

    def rows(block, number):
        groups = [dict(zip(("lang", "source", "until"), g)) for g in block.groups()]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([None], pa.string()),
                                          pa.array([None], pa.binary()), pa.array([groups], _GROUPS)], schema=schema)
        chunks, first, docs = block.chunks()
        for lo in range(0, len(chunks), CHUNKS_PER_BATCH):
            hi = min(lo + CHUNKS_PER_BATCH, len(chunks))
            own = docs[first[lo]:first[hi]].tobytes()
            ends = pa.py_buffer((2 * (first[lo:hi + 1] - first[lo])).astype(np.int32).tobytes())
            lists = pa.Array.from_buffers(pa.binary(), hi - lo, [None, ends, pa.py_buffer(own)])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(hi - lo, number), pa.int64()), pa.array(chunks[lo:hi], pa.binary()).cast(pa.string()),
                lists, pa.nulls(hi - lo, _GROUPS)], schema=schema)

    block, number = Block(), None
    for batch in batches:
        text = batch.column(3).cast(pa.large_binary())
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for i in range(batch.num_rows):
            if number is None:
                number = batch.column(0)[i].as_py() << 32
            raw = text[i].as_py()
            if block.full(raw):
                yield from rows(block, number)
                block, number = Block(), number + 1
            block.add(langs[i], sources[i], raw)
    if block.documents:
        yield from rows(block, number)


def block_terms(held: pa.Table, groups: pa.Table) -> pa.Table:
    """Rows (block, term, times, docs) of a block and its groups -> (lang, source, term, documents, n)."""
    bounds = groups.column("groups")[0].as_py()
    until = np.array([g["until"] for g in bounds], np.int64)
    size = int(until[-1])
    column = held.column("term").combine_chunks().dictionary_encode()
    if isinstance(column, pa.ChunkedArray):
        column = column.unify_dictionaries().combine_chunks()
    names, code = column.dictionary, column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lists = held.column("docs").to_pylist()
    occurrences = np.fromiter(map(len, lists), np.int64, len(lists)) // 2
    doc = np.frombuffer(b"".join(lists), "<u2").astype(np.int64)
    del lists
    group_of = np.searchsorted(until, np.arange(size), "right")
    key = np.repeat(code, occurrences) * size + doc
    times = np.repeat(held.column("times").to_numpy(), occurrences)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    cell = key[new] // size * len(until) + group_of[key[new] % size]     # ascending, as documents are by group
    n = np.add.reduceat(times, new) if len(new) else times
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else new
    total = np.add.reduceat(n, start) if len(start) else n
    group = cell[start] % len(until)
    of = lambda field: pa.array([g[field] for g in bounds], pa.string()).take(pa.array(group))
    return pa.table({
        "lang": of("lang"), "source": of("source"), "term": names.take(pa.array(cell[start] // len(until))).cast(pa.string()),
        "documents": pa.array(np.diff(np.append(start, len(cell))), pa.int64()), "n": pa.array(total, pa.int64())})


def chunk_terms(held: DataFrame, least: int) -> DataFrame:
    """(chunk, term, times) of every distinct chunk, but for the terms that fewer than ``least`` documents can hold:
    a term's documents are at most the occurrences of its chunks.  Most distinct chunks are rare words, and what no
    language keeps need not be joined back."""
    sums = held.groupBy("chunk").agg(F.sum(F.octet_length("docs")).alias("bytes"))
    terms = sums.select("chunk", "bytes", F.explode(
        F.regexp_extract_all(lower_ascii(F.col("chunk")), F.lit(TERM), F.lit(0))).alias("term"))
    terms = terms.groupBy("chunk", "bytes", "term").agg(F.count(F.lit(1)).alias("times"))
    frequent = terms.groupBy("term").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") >= 2 * least).select("term")
    return terms.join(frequent, "term").select("chunk", "term", "times")


def term_counts(docs: DataFrame, scratch: Scratch, least: int, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, documents, n): stored counts in every group, of all terms that ``least`` documents may hold."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    read = docs.select(F.spark_partition_id().cast("bigint").alias("part"), text(lang_col).alias("lang"),
                       text(source_col).alias("source"), text(text_col).alias("text"))
    blocks = scratch.write(read.mapInArrow(count_chunks, BLOCK_SCHEMA), "chunks")
    held = blocks.where(F.col("chunk").isNotNull()).select("block", "chunk", "docs")
    terms = scratch.write(chunk_terms(held, least), "chunk-terms")
    # each step's shuffles go before those of the next one begin
    scratch.release()
    back = scratch.write(held.join(terms, "chunk").select("block", "term", "times", "docs"), "back")
    groups = scratch.write(blocks.where(F.col("chunk").isNull()).select(F.col("block").alias("of"), "groups"), "blocks")
    scratch.drop("chunks", "chunk-terms")
    scratch.release()
    # a block's rows are bounded like its text
    counted = back.groupBy("block").cogroup(groups.groupBy("of")).applyInArrow(
        block_terms, "lang string, source string, term string, documents bigint, n bigint")
    out = scratch.write(counted.groupBy("lang", "source", "term").agg(
        F.sum("documents").alias("documents"), F.sum("n").alias("n")), "terms")
    scratch.drop("back", "blocks")
    scratch.release()
    return out


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(1000000000 * (n + 2) / (total + 2 * kept)); decimals, since a product may pass 64 bits."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({n} + 2 AS DECIMAL(20, 0)))"
                  f" div nullif(CAST({total} + 2 * {kept} AS DECIMAL(20, 0)), 0)")


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def pair_sums(held: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a block for all pairs of sources of its language.

    ``held``: (term, source, p) where a source has the term; ``groups``: (source, p0), all sources."""
    sources = groups["source"].tolist()
    at = {s: i for i, s in enumerate(sources)}
    zero = groups["p0"].to_numpy(np.int64, na_value=0)
    sums = np.zeros((len(sources), len(sources)), np.int64)
    term, distinct = pd.factorize(held["term"])
    source = held["source"].map(at).to_numpy(np.int64)
    p = held["p"].to_numpy(np.int64)
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    step = max(1, PAIR_CELLS // max(1, len(sources)))
    for lo in range(0, len(distinct), step):
        hi = min(lo + step, len(distinct))
        some = slice(*np.searchsorted(term, [lo, hi]))
        cells = np.repeat(zero[:, None], hi - lo, axis=1)
        cells[source[some], term[some] - lo] = p[some]
        for a in range(len(sources) - 1):
            sums[a, a + 1:] += difference(cells[a], cells[a + 1:]).sum(axis=1)
    sums += sums.T
    a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
    return pd.DataFrame({"lang": groups["lang"].iloc[0], "source": [sources[i] for i in a],
                         "item": [sources[i] for i in b], "value": sums[a, b]})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = term_counts(docs, scratch, min_documents, text_col, lang_col, source_col)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    every = docs.groupBy(text(lang_col).alias("lang"), text(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("lang_n"))
    kept = scratch.write(of_lang.where(F.col("documents") >= min_documents).select("lang", "term", "lang_n"), "kept")
    lang_total = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    rows = scratch.write(counts.join(kept, ["lang", "term"]), "rows")
    total = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = scratch.write(
        every.join(total, ["lang", "source"], "left").join(lang_total, "lang", "left").select(
            "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_total")), "groups")
    scored = rows.join(groups, ["lang", "source"]).withColumns(
        {"p": share("n", "total", "kept"), "q": share("lang_n", "lang_total", "kept")})

    # a language's terms are dealt to as many blocks as its rows need; each block sees all its sources
    blocks = rows.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(pair_rows)).alias("blocks"))
    sides = groups.join(blocks, "lang", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    of_block = sides.select("lang", "source", share("0", "total", "kept").alias("p0"),
                            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    held = scored.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "term", "source", "p")
    sums = held.groupBy("lang", "block").cogroup(of_block.groupBy("lang", "block")).applyInPandas(
        pair_sums, "lang string, source string, item string, value bigint")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    terms = scored.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.withColumn("rank", F.row_number().over(best)).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top_terms))
