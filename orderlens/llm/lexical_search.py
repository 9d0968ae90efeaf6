"""Ranked lexical search: the best documents for each item, by an exact integer BM25.

Aho-Corasick document scan.  One automaton holds all item terms, each between two
guards; the text of a document, with every character outside terms made a guard, is
read once and the automaton's outputs are the occurrences of item terms.  So term
frequencies come directly from the text and no index of the documents is built.
A document leaves the scan as one short row: its length in terms and the item terms it
holds.  Corpus counts are aggregated from these rows; a second pass maps each document's
terms to the items that ask for them, and every task keeps its best rows per item only.

Item terms travel with the tasks: they are cut into blocks of items with at most
``BLOCK_TERMS`` rows (item, term) on average, and each block is a scan of its own, so
a larger query set takes more scans instead of more memory.

Defined cases: null or term-less text matches nothing and does not count as a
document; rows with one item id are one item; an item without terms has no rows;
a row whose id is null or repeated is a document of its own, null ids come last in ties;
empty tables give no rows.
"""

from __future__ import annotations

from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch
from orderlens.llm.divergence import lower_ascii
from orderlens.llm.hashing import text_groups

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
BLOCK_TERMS = 200_000
#: Bytes that the automaton reads at once.
SCAN_BYTES = 1 << 20
#: Cells (document, item) and products (document, term, item) that are held at once.
CELLS = 1 << 21
GUARD = 0x20


def byte_table() -> np.ndarray:
    """What a byte becomes: guard outside terms, A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    for lo, hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[lo:hi + 1] = GUARD
    table[0x41:0x5B] += 32
    return table


_TABLE = byte_table()


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


class TermAutomaton:
    """Automaton over UTF-8 bytes; term ``i`` of ``names`` yields ``i`` where it stands between guards."""

    def __init__(self, names: list[str]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, name in enumerate(names):
            self.automaton.add_word(f" {name.encode().decode('latin-1')} ", i)
        if names:
            self.automaton.make_automaton()
        self.empty = not names

    def scan(self, data: np.ndarray) -> np.ndarray:
        """(k, 2): byte of the guard behind each occurrence, term.  ``data`` begins and ends with a guard."""
        if self.empty:
            return np.zeros((0, 2), np.int64)
        found, at = [], 0
        while at < len(data) - 1:
            end = min(at + SCAN_BYTES, len(data))
            if end < len(data):
                # cut at a guard, which the next part shares
                back = np.flatnonzero(data[at + 1:end] == GUARD)
                if len(back):
                    end = at + 1 + int(back[-1]) + 1
                else:
                    ahead = np.flatnonzero(data[end:] == GUARD)
                    end += int(ahead[0]) + 1
            text = data[at:end].tobytes().decode("latin-1")
            hits = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
            hits[:, 0] += at
            found.append(hits)
            at = end - 1
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def scan_group(automaton: TermAutomaton, size: int, data: np.ndarray, offsets: np.ndarray):
    """(lengths in terms, first, terms, frequencies) of a run of texts; document i holds terms[first[i]:first[i + 1]]."""
    rows = len(offsets) - 1
    guarded = np.full(len(data) + rows + 1, GUARD, np.uint8)
    if rows == 1:       # a long text is a run of its own
        guarded[1:-1] = _TABLE[data]
    else:
        guarded[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets)) + 1] = _TABLE[data]
    place = offsets + np.arange(rows + 1)      # the guard before each row, and the last one
    inside = guarded != GUARD
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    length = np.diff(np.searchsorted(starts, place))
    hits = automaton.scan(guarded)
    owner = np.searchsorted(place, hits[:, 0], "left") - 1
    key, tf = np.unique(owner * max(1, size) + hits[:, 1], return_counts=True)
    first = np.searchsorted(key, np.arange(rows + 1) * max(1, size))
    return length, first, key % max(1, size), tf


#: The automaton of the scan that a Python worker last took part in.
_BUILT: dict[str, TermAutomaton] = {}


def scan_task(names_of, key: str):
    """(id, text) -> (id, n, terms, tfs) for texts with a term; ``key`` names the term list."""
    def run(batches):
        names = names_of.value
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = TermAutomaton(names)
        automaton = _BUILT[key]
        for batch in batches:
            for lo, data, offsets in text_groups(batch.column(1)):
                length, first, term, tf = scan_group(automaton, len(names), data, offsets)
                keep = pa.array(length > 0)
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v, t))
                         for v, t in ((term, pa.int32()), (tf, pa.int64()))]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(length)), pa.array(length, pa.int64()), *lists],
                    ["id", "n", "terms", "tfs"])
                yield out.filter(keep)
    return run


class Items:
    """A block of items: its terms, and for each term the items that ask for it and how often."""

    def __init__(self, rows: list[tuple]):
        """``rows``: (item, term, times)."""
        self.items = sorted({r[0] for r in rows}, key=lambda x: (x is None, x))
        self.names = sorted({r[1] for r in rows})
        at, of = {x: i for i, x in enumerate(self.items)}, {x: i for i, x in enumerate(self.names)}
        asked = sorted((of[t], at[i], k) for i, t, k in rows)
        column = lambda j: np.array([a[j] for a in asked], np.int64)
        self.first = np.searchsorted(column(0), np.arange(len(self.names) + 1))
        self.item, self.times = column(1), column(2)


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + (25 * n * documents) div total, also where the product passes 64 bits."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        return np.array([75 + 25 * int(x) * documents // total for x in n], np.int64)
    return 75 + 25 * n * documents // max(1, total)


def best_rows(found: pa.Table, top: int) -> pa.Table:
    """The first ``top`` rows of each item by falling score, then rising id (null last)."""
    order = pc.sort_indices(found, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    found = found.take(order)
    item = found.column("item").to_numpy()
    return found.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < top))


def rank_task(items: Items, weights: np.ndarray, documents: int, total: int, top: int):
    """(id, n, terms, tfs) -> (item, id, score): the best rows of a task for each item."""
    fan = np.diff(items.first)

    def run(batches):
        best, least = None, np.ones(len(items.items), np.int64)
        for batch in batches:
            lists = batch.column(2)
            first = np.asarray(lists.offsets, np.int64)
            first, term = first - first[0], np.asarray(lists.flatten(), np.int64)
            tf = np.asarray(batch.column(3).flatten(), np.int64)
            m = lengths(batch.column(1).to_numpy(), documents, total)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
            work = np.concatenate([[0], np.cumsum(fan[term])])[first] + np.arange(batch.num_rows + 1) * len(items.items)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(work, work[lo] + CELLS, "right")) - 1)
                span = slice(first[lo], first[hi])
                width = fan[term[span]]
                asked = np.arange(width.sum()) + np.repeat(items.first[term[span]] - np.cumsum(width) + width, width)
                cells = np.zeros((hi - lo) * len(items.items), np.int64)
                np.add.at(cells, np.repeat(row[span] - lo, width) * len(items.items) + items.item[asked],
                          np.repeat(part[span], width) * items.times[asked])
                cells = cells.reshape(hi - lo, -1)
                doc, item = np.nonzero(cells >= least)
                if len(doc):
                    new = pa.table({"item": pa.array(item, pa.int64()), "id": batch.column(0).take(pa.array(doc + lo)),
                                    "score": pa.array(cells[doc, item], pa.int64())})
                    best = best_rows(pa.concat_tables([best, new]) if best is not None else new, top)
                    held = best.column("item").to_numpy()
                    full = np.flatnonzero(np.bincount(held, minlength=len(least)) >= top)
                    last = np.searchsorted(held, full, "right") - 1
                    least[full] = best.column("score").to_numpy()[last]
                lo = hi
        if best is not None:
            yield from best.combine_chunks().to_batches()
    return run


def search_block(docs: DataFrame, items: Items, scratch: Scratch, name: str, top: int) -> DataFrame:
    """(item, id, score) of the best rows of each task."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    names = spark.sparkContext.broadcast(items.names)
    scanned = scratch.write(
        docs.mapInArrow(scan_task(names, scratch.path(name)), f"id {kind}, n bigint, terms array<int>, tfs array<bigint>"), name)
    corpus = scanned.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    held = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    documents = corpus["documents"]
    weighted = held.select("term", F.floor(1000 * F.log(
        F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double"))).alias("w"))
    weights = np.zeros(len(items.names), np.int64)
    for r in weighted.toLocalIterator():    # at most one row for each term of the block
        weights[r["term"]] = r["w"]
    return scanned.mapInArrow(rank_task(items, weights, documents, corpus["total"] or 0, top),
                              f"item bigint, id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           item_text: str = "text", item_col: str = "item_id", top: int = TOP,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item id, rank, document id, score) of the ``top`` best documents with a score above 0."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lexical-search")
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    asked = scratch.write(
        items.select(F.col(item_col).alias("item"), F.explode(terms(F.col(item_text))).alias("term"))
        .groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")), "items")
    blocks = max(1, -(-asked.count() // block_terms))
    item_kind, id_kind = asked.schema["item"].dataType.simpleString(), read.schema["id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {item_kind}, id {id_kind}, score bigint")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if not rows:
            continue
        block = Items([tuple(r) for r in rows])
        names = spark.createDataFrame(list(enumerate(block.items)), f"item bigint, item_id {item_kind}")
        best = search_block(read, block, scratch, f"scan-{b}", top)
        # the block's items are bounded like its terms
        found = found.unionByName(best.join(F.broadcast(names), "item").select("item_id", "id", "score"))
    first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top).select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
