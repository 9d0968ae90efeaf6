"""Removal of repeated passages with compressed FM-indexes.

A window is 20 consecutive words of a document; a word goes when a window that
covers it also starts earlier (smaller id, or same id and smaller start).

1. Every window has an anchor, the smallest hash of its 6-word runs, so equal
   windows have equal anchors.  Neighbouring windows whose anchor is the same run
   of words form a segment.  Only anchors that occur more than once go on, without any text.
2. The segments of repeated anchors are cut from the texts and equal segments
   merged; all but the first occurrence of a segment are repeated as a whole.
   Anchors with very many segments are cut into single windows, which merge
   completely when equal, so that no shard can grow with a common passage.
3. Distinct segments are dealt to shards by anchor.  A shard builds an FM-index
   (suffix array, Burrows-Wheeler transform, wavelet matrix over packed bits with
   rank counts) and streams its segments through it: backward search gives the
   matching statistics of all windows at once; those that reach the threshold
   yield intervals, and the smallest place in an interval tells the first one.
4. The intervals are joined back to the texts they came from.

Defined cases: null text has no words; texts of fewer than 20 words lose nothing;
null ids rank last; rows that repeat an id are not earlier than each other at the
same start; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, row_blocks, words
from orderlens.llm.hashing import gram_hashes, mix64, separator_table, text_groups, word_hashes, word_spans

WINDOW = 20
#: Words of the runs among which a window's anchor is chosen.
GRAM = 6
#: Occurrences from which an anchor's segments are cut into single windows.
COMMON = 500
#: Words that a shard's index holds, about.
SHARD_WORDS = 300_000
LAST = 2**63 - 1
SPLIT = re.compile("[^\x20\x09-\x0D]+")


# --- anchors -----------------------------------------------------------------

def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchor_runs(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray):
    """(row, first window, windows, anchor) of the runs of windows with one anchor."""
    starts, ends, first = word_spans(data, offsets, lut)
    if len(starts) < WINDOW:
        return [np.zeros(0, np.int64)] * 4
    grams, width = gram_hashes(word_hashes(data, starts, ends), GRAM), WINDOW - GRAM + 1
    anchors = sliding_min(grams, width)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    valid = np.flatnonzero(row[:len(anchors)] == row[WINDOW - 1:WINDOW - 1 + len(anchors)])
    if not len(valid):
        return [np.zeros(0, np.int64)] * 4
    # a run shares the leftmost place of its anchor, so no two of its windows are equal
    offset = np.zeros(len(anchors), np.int8)
    for k in range(width - 1, 0, -1):
        offset[grams[k:k + len(anchors)] == anchors] = k
    offset[grams[:len(anchors)] == anchors] = 0
    place = (valid + offset[valid])
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)])
    head = np.flatnonzero(new)
    begin = valid[head]
    rows = row[begin]
    return rows, begin - first[rows], np.diff(np.append(head, len(valid))), anchors[begin].view(np.int64)


def anchor_task(with_place: bool):
    lut = separator_table()

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, data, offsets in text_groups(batch.column(1)):
                rows, begin, length, anchor = anchor_runs(data, offsets, lut)
                if not len(rows):
                    continue
                if not with_place:
                    yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), ids.take(pa.array(rows + lo)), pa.array(begin * 256 + length)],
                        ["anchor", "id", "place"])
    return run


# --- segments ----------------------------------------------------------------

SEGMENT = "sig bigint, sig2 bigint, shard bigint, id bigint, text_key bigint, start bigint, windows int"
#: Odd bases of the two hashes that name a sequence of words, and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def sequence_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``words[b:e]`` for all pairs, from prefix sums of a polynomial modulo 2^64."""
    n = len(words) + 1
    power = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    power[0] = down[0] = 1
    power, down = np.multiply.accumulate(power), np.multiply.accumulate(down)
    prefix = np.zeros(n, np.uint64)
    np.cumsum(words * power[:-1], out=prefix[1:])
    return mix64((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64)).view(np.int64)


def segment_task(with_text: bool):
    """(id, text_key, text, runs) -> segments; a run is (place, anchor, common).

    The text of a segment is the stretch of its document; what separates its words
    does not matter, equal segments are those with equal words.
    """
    lut = separator_table()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(LAST).to_numpy()
            keys, lists = batch.column(1).to_numpy(), batch.column(3)
            at = lists.offsets.to_numpy()
            place, anchor, common = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for lo, data, offsets in text_groups(batch.column(2)):
                starts, ends, first = word_spans(data, offsets, lut)
                hashes = word_hashes(data, starts, ends)
                count = np.diff(first)
                mine = slice(at[lo], at[lo + len(count)])
                row = np.repeat(np.arange(len(count)), np.diff(at[lo:lo + len(count) + 1]))
                start, size, name, many = place[mine] // 256, place[mine] % 256, anchor[mine], common[mine]
                # leave out places of another row with the same id
                real = start + size + WINDOW - 1 <= count[row]
                row, start, size, name, many = row[real], start[real], size[real], name[real], many[real]
                pieces = np.where(many, size, 1)
                step = np.where(many, 1, size)
                k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                row, step, name, many = (np.repeat(x, pieces) for x in (row, step, name, many))
                start = np.repeat(start, pieces) + k * many
                begin = first[row] + start
                end = begin + step + WINDOW - 1
                sig, sig2 = (sequence_hashes(hashes, begin, end, base) for base in BASES)
                cols = [sig, sig2, np.where(many, sig, name), ids[lo:][row], keys[lo:][row], start, step.astype(np.int32)]
                raw = data.tobytes()
                for p in range(0, len(row), 20_000):
                    q = min(p + 20_000, len(row))
                    out = [pa.array(c[p:q]) for c in cols]
                    if with_text:
                        out.append(pa.array([raw[x:y] for x, y in zip(
                            starts[begin[p:q]].tolist(), ends[end[p:q] - 1].tolist())], pa.binary()).cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(out, [f.split()[0] for f in SEGMENT.split(", ")] + ["segment"] * with_text)
    return run


# --- FM-index ------------------------------------------------------------------

class Bits:
    """Packed bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """FM-index of a sequence of symbols 0 .. sigma - 1 in which no suffix is a prefix of another."""

    def __init__(self, text: np.ndarray, sigma: int):
        self.suffixes = suffix_array(text)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        sequence = text[self.suffixes - 1]
        self.levels = []
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (sequence >> shift) & 1
            self.levels.append((shift, Bits(bits.astype(np.uint8))))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        # where each symbol's run begins on the lowest level
        self.begin = np.zeros(sigma, np.int64)
        present, at = np.unique(sequence, return_index=True)
        self.begin[present] = at

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """LF step: start of ``symbol`` plus its occurrences among the first ``i`` of the transform."""
        at = i
        for shift, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1 == 1, bits.zeros + ones, at - ones)
        return self.less[symbol] + at - self.begin[symbol]

    def intervals(self, text: np.ndarray, starts: np.ndarray, length: int):
        """Backward search of all ``text[s:s + length]`` at once.

        Returns (indexes into ``starts``, low, high) of those that occur twice or
        more, and the matching statistic of every window end: how many words back
        from it a second occurrence reaches, up to ``length``.
        """
        alive = np.arange(len(starts))
        reached = np.zeros(len(starts), np.int64)
        symbol = text[starts + length - 1]
        low, high = self.less[symbol], self.less[symbol + 1]
        for back in range(length - 1, -1, -1):
            if back < length - 1:
                symbol = text[starts[alive] + back]
                low, high = self.step(symbol, low), self.step(symbol, high)
            twice = high - low > 1
            alive, low, high = alive[twice], low[twice], high[twice]
            reached[alive] = length - back
            if not len(alive):
                break
        return alive, low, high, reached


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        following = np.zeros(n, np.int64)
        following[:n - span] = rank[span:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or span >= n:
            return order
        span *= 2


def repeated_runs(segments: list[str], ids: np.ndarray, starts: np.ndarray):
    """(segment, first window, windows) of the runs of windows that also start earlier,
    where ``ids`` and ``starts`` give the first occurrence of each segment."""
    split = [SPLIT.findall(s) for s in segments]
    size = np.array([len(s) for s in split])
    m = len(split)
    # one end mark per segment, all different and smaller than any word
    number: dict[str, int] = {}
    flat = np.empty(int(size.sum()) + m, np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    for k, s in enumerate(split):
        flat[begin[k]:begin[k] + size[k]] = [number.setdefault(w, m + len(number)) for w in s]
        flat[begin[k] + size[k]] = k
    index = FMIndex(flat, m + len(number))

    windows = size - WINDOW + 1
    owner = np.repeat(np.arange(m), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begin[owner] + offset
    alive, low, high, _ = index.intervals(flat, at, WINDOW)
    if not len(alive):
        return np.zeros((0, 3), np.int64)

    # order of all places, then the smallest within each interval of suffixes
    where = np.repeat(np.arange(m), size + 1)
    place = starts[where] + np.arange(len(flat)) - begin[where]
    order = np.lexsort((place, ids[where]))
    rank = np.empty(len(flat), np.int64)
    same = (ids[where][order][1:] == ids[where][order][:-1]) & (place[order][1:] == place[order][:-1])
    rank[order] = np.concatenate([[0], np.cumsum(~same)])
    lows, back = np.unique(low, return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[back] = high
    by_suffix = np.append(rank[index.suffixes], 0)
    least = np.minimum.reduceat(by_suffix, np.stack([lows, highs], 1).reshape(-1))[::2]
    gone = alive[least[back] < rank[at[alive]]]

    owners, offsets = owner[gone], offset[gone]
    cut = np.concatenate([[True], (owners[1:] != owners[:-1]) | (offsets[1:] != offsets[:-1] + 1)])
    head = np.flatnonzero(cut)
    return np.stack([owners[head], offsets[head], np.diff(np.append(head, len(gone)))], 1)


def shard_task(frame):
    import pandas as pd

    ids, starts = frame["id"].to_numpy(np.int64), frame["start"].to_numpy(np.int64)
    runs = repeated_runs(frame["segment"].tolist(), ids, starts)
    s = runs[:, 0]
    return pd.DataFrame({"id": ids[s], "text_key": frame["text_key"].to_numpy(np.int64)[s],
                         "start": starts[s] + runs[:, 1], "windows": runs[:, 2].astype(np.int32)})


# --- the operator ----------------------------------------------------------------

def finish_task(batches):
    """(id, text, runs) -> (id, n_words, n_removed, kept): the words no repeated window covers."""
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = SPLIT.findall(text)
            gone = np.zeros(len(own) + 1, np.int64)
            for r in runs:
                gone[r["start"]] += 1
                gone[min(r["start"] + r["windows"] + WINDOW - 1, len(own))] -= 1
            stay = np.cumsum(gone)[:-1] == 0
            n_words.append(len(own))
            n_removed.append(len(own) - int(stay.sum()))
            kept.append(" ".join(w for w, s in zip(own, stay) if s))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) for every row: ``kept`` are the words that stay, joined by one blank."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring")
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    repeated = scratch.write(
        plain.mapInArrow(anchor_task(False), "anchor bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("anchor", (F.col("n") > COMMON).alias("common")), "repeated")
    scratch.release()
    places = plain.mapInArrow(anchor_task(True), "anchor bigint, id bigint, place bigint").join(repeated, "anchor")
    runs = places.groupBy(F.coalesce("id", F.lit(LAST)).alias("key")).agg(
        F.collect_list(F.struct("place", "anchor", "common")).alias("runs"))

    # texts with a repeated anchor are kept for the later steps, the others are done
    hit = plain.withColumn("key", F.coalesce("id", F.lit(LAST))).join(runs, "key", "left")
    free = F.col("runs").isNull()
    kept = F.array_join(words(F.col("text")), " ")
    joined = scratch.write(hit.select(
        "id", F.xxhash64("text").alias("text_key"), "runs", F.when(~free, F.col("text")).alias("text"),
        F.when(free, kept).alias("kept")), "joined")
    scratch.drop("repeated")
    scratch.release()
    open_rows = joined.where("runs is not null")

    segments = open_rows.select("id", "text_key", "text", "runs")
    distinct = scratch.write(
        segments.mapInArrow(segment_task(True), f"{SEGMENT}, segment string").groupBy("sig", "sig2").agg(
            F.min(F.struct("id", "start", "text_key")).alias("first"), F.first("shard").alias("shard"),
            F.first("segment").alias("segment"), F.count(F.lit(1)).alias("n")), "distinct")

    scratch.release()

    # a shard gets whole anchors; its size follows from the words of all distinct segments
    total = distinct.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    shards = row_blocks(total // 6, SHARD_WORDS, 12)
    inside = distinct.select(
        F.pmod(F.xxhash64("shard"), F.lit(shards)).alias("shard"), "first.id", "first.start", "first.text_key", "segment") \
        .groupBy("shard").applyInPandas(shard_task, "id bigint, text_key bigint, start bigint, windows int")
    first = distinct.where("n > 1").select("sig", "sig2", F.col("first.id").alias("first_id"), F.col("first.start").alias("first_start"))
    later = segments.mapInArrow(segment_task(False), SEGMENT).join(first, ["sig", "sig2"]) \
        .where("id != first_id or start != first_start").select("id", "text_key", "start", "windows")
    gone = inside.unionByName(later).groupBy("id", "text_key").agg(
        F.collect_list(F.struct("start", "windows")).alias("gone"))
    gone = scratch.write(gone.select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone"), "gone")

    scratch.drop("distinct")
    scratch.release()

    left = open_rows.select("id", F.coalesce("id", F.lit(LAST)).alias("key"), "text_key", "text").join(
        gone, (F.col("key") == F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    cut = left.select("id", "text", F.coalesce("gone", F.array().cast("array<struct<start:bigint,windows:int>>")).alias("gone")) \
        .mapInArrow(finish_task, "id bigint, n_words bigint, n_removed bigint, kept string")
    whole = joined.where("runs is null").select(
        "id", F.when(F.col("kept") == "", F.lit(0)).otherwise(F.size(F.split("kept", " ", -1))).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_removed"), "kept")
    return whole.unionByName(cut).withColumnRenamed("id", id_col)
