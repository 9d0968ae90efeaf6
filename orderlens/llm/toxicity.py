"""Toxicity by maximum-scoring segments over token log-odds.

Tokens are words and their beginnings of four and five letters (stems with
varying endings).  A token's weight is its log-odds between toxic and clean
training texts with a Dirichlet prior, over the documents that contain it; equal
texts count once.  Clearly toxic
tokens (z-score and weight above thresholds) have that weight, all other words a
small negative one, and a linear scan finds all maximal-scoring segments of a
text (Ruzzo and Tompa).  Segment scores are put on the scale of extreme-value
statistics (Karlin and Altschul: lambda from the score distribution of clean
text, p-value of the sum of the r best segments), and the smallest p-value is
calibrated to a probability on training texts.

Every token above the thresholds counts.  Up to ``BROADCAST_TOKENS`` of them travel
with the tasks; more stay a table, and the places of the texts' tokens are joined
with it.  Of those places only the ones that pass a bitmap of fixed size are moved;
it may let a token through that has no weight, never the other way round.

Defined cases: null text counts as empty and has no segment; a label that is
null is no label; a text with both labels counts for both; without training rows
of both classes every text scores 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch

WORD = re.compile(r"[^\W_]+")
STEMS = (4, 5)
#: Dirichlet prior: documents of each class that a token counts for beforehand, with it and without it.
PRIOR = 1.0
MIN_Z, MIN_WEIGHT = 4.0, 3.0
#: Tokens that travel with the tasks; the weights of more are joined from a table.
BROADCAST_TOKENS = 20_000
#: Bits of the bitmap that names the tokens worth a join.
FILTER_BITS = 1 << 24
#: Negative weight of a word that is no toxic token.
DRIFT = 0.2
#: Training texts, chosen by a hash, on which the final scale is fitted: about so many.
CALIBRATION_ROWS = 20_000
#: Segments with an expected number of chance hits below this are reported as passages.
SIGNIFICANT = 0.05
#: Tokens that a task counts before it hands them on.
FLUSH = 400_000


def tokens(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in STEMS if len(word) >= k)]


def count_task(batches):
    """(text, toxic) -> (token, toxic documents, clean documents), summed within the task."""
    toxic, clean = Counter(), Counter()

    def handed():
        every = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([toxic[t] for t in every], pa.int64()),
             pa.array([clean[t] for t in every], pa.int64())], ["token", "toxic", "clean"])
        toxic.clear()
        clean.clear()

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {t for w in set(WORD.findall(text.lower())) for t in tokens(w)}
            (toxic if label else clean).update(seen)
            if len(toxic) + len(clean) > FLUSH:
                yield from handed()
    yield from handed()


def training_texts(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """(text, toxic): distinct labelled training texts."""
    marks = labels.where(F.col("toxic").isNotNull()).select("doc_id", "toxic").where(trainable).distinct()
    texts = docs.where(trainable).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the labels are the small side of each partition; the text side needs no sort
    hit = texts.join(marks.hint("shuffle_hash"), "doc_id")
    return hit.withColumn("h", F.sha2("text", 256)).dropDuplicates(["h", "toxic"]).select("text", "toxic", "h")


class WeightTable:
    """Weights of more tokens than a task should hold: (token, weight), and a bitmap of the tokens."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        at = F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(FILTER_BITS))
        found = rows.select(F.shiftright(at, 3).cast("int").alias("byte"), F.lit(1).alias("one"),
                            at.bitwiseAND(7).cast("int").alias("bit")) \
            .groupBy("byte").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")).toArrow()
        self.bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
        self.bitmap[found.column("byte").to_numpy()] = found.column("bits").to_numpy()

    def hits(self, texts: DataFrame) -> DataFrame:
        """(h, hits) of the texts (h, text) with a hit; equal ``h`` must have equal texts."""
        places = texts.select("h", "text").mapInArrow(
            candidate_task(self.bitmap), "h string, place bigint, token string").distinct()
        return places.join(self.rows, "token").groupBy("h", "place").agg(F.max("weight").alias("weight")) \
            .groupBy("h").agg(F.sort_array(F.collect_list(F.struct("place", "weight"))).alias("hits"))


class Candidates(dict):
    """Tokens of a word that the bitmap lets through; bounded memo."""

    def __init__(self, bitmap: np.ndarray):
        super().__init__()
        self.bitmap = bitmap

    def __missing__(self, word: str) -> list[str]:
        if len(self) > 300_000:
            self.clear()
        at = ((t, zlib.crc32(t.encode()) % (8 * len(self.bitmap))) for t in tokens(word))
        found = self[word] = [t for t, x in at if self.bitmap[x >> 3] >> (x & 7) & 1]
        return found


def candidate_task(bitmap: np.ndarray):
    """(h, text) -> (h, place, token) of the tokens that may have a weight."""
    def run(batches):
        memo, out = Candidates(bitmap), []

        def handed():
            h, place, token = zip(*out) if out else ((), (), ())
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(h, pa.string()), pa.array(place, pa.int64()), pa.array(token, pa.string())],
                ["h", "place", "token"])

        for batch in batches:
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.extend((h, i, t) for i, w in enumerate(WORD.findall(text.lower())) for t in memo[w])
                if len(out) > FLUSH:
                    yield handed()
        yield handed()
    return run


def length_task(columns: list[str]):
    """The columns without the text, and the number of its words."""
    def run(batches):
        for batch in batches:
            n = [len(WORD.findall(t.lower())) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(n, pa.int64())], columns + ["n_words"])
    return run


class Model:
    def __init__(self, weights: dict[str, float] | WeightTable, scale: float, k: float, slope: float, shift: float):
        self.weights, self.scale, self.k, self.slope, self.shift = weights, scale, k, slope, shift


class Weights(dict):
    """Weight of a word: that of its strongest token, 0 for a word without one; bounded memo."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = max((self.weights.get(t, 0.0) for t in tokens(word)), default=0.0)
        return found


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """(first, last, score) of all maximal-scoring segments, in order.

    ``hits``: positions and weights of the toxic words; every other word scores ``-drift``.
    """
    found: list[list] = []       # first, last, sum before it, sum up to its end
    total, at = 0.0, 0
    for place, weight in hits:
        total -= drift * (place - at)
        segment = [place, place, total, total + weight]
        total, at = total + weight, place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= segment[2]:
                j -= 1
            if j < 0 or found[j][3] >= segment[3]:
                found.append(segment)
                break
            segment = [found[j][0], segment[1], found[j][2], segment[3]]
            del found[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in found]


def log_p(scores: list[float], n: int, scale: float, k: float) -> float:
    """-ln of the smallest p-value of the sum of the r best segments in a text of n words."""
    best, total = 0.0, 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        total += scale * s - math.log(max(k * n, 1e-9))
        t = total - math.lgamma(r + 1) if r > 1 else total
        if t > 0:
            # tail of the sum statistic: e^-t t^(r-1) / (r! (r-1)!)
            best = max(best, t - (r - 1) * math.log(max(t, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def extreme_value_scale(share: float, mean: float) -> float:
    """lambda > 0 with share * e^(lambda * mean) + (1 - share) * e^(-lambda * DRIFT) = 1."""
    value = lambda x: share * math.exp(x * mean) + (1 - share) * math.exp(-x * DRIFT)
    lo, hi = 1e-9, 1.0
    while value(hi) < 1:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if value(mid) < 1 else (lo, mid)
    return lo


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of the calibration curve, by damped Newton steps; a weak prior keeps them finite."""
    a, b = 1.0, -1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((y - p) * x).sum() - 0.01 * a, (y - p).sum() - 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
    return max(float(a), 0.0), float(b)


def fit(docs: DataFrame, labels: DataFrame, trainable: Column) -> Model | None:
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    texts = scratch.write(training_texts(docs, labels, trainable), "texts")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_t, n_c = sizes.get(1, 0), sizes.get(0, 0)
    if not n_t or not n_c:
        return None
    counts = texts.select("text", (F.col("toxic") == 1).alias("toxic")).mapInArrow(
        count_task, "token string, toxic bigint, clean bigint") \
        .groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    a, b = F.col("t") + PRIOR, F.col("c") + PRIOR
    weight = F.log(a / (n_t + 2 * PRIOR - a)) - F.log(b / (n_c + 2 * PRIOR - b))
    strong = scratch.write(
        counts.select("token", weight.alias("weight"), (weight / F.sqrt(1 / a + 1 / b)).alias("z"))
        .where((F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_WEIGHT)).select("token", "weight"), "strong")
    held, average = strong.agg(F.count(F.lit(1)), F.avg("weight")).first()
    if not held:
        return None
    weights = {r["token"]: r["weight"] for r in strong.collect()} if held <= BROADCAST_TOKENS else WeightTable(strong)

    # score distribution of clean text: words, toxic tokens among them and their mean weight
    words, hits, total = background(texts.where("toxic = 0").select("h", "text"), weights)
    mean = (total + average) / (hits + 1)
    scale = extreme_value_scale(min((hits + 1) / (words + 2), 0.5 * DRIFT / mean), mean)
    model = Model(weights, scale, 0.1, 1.0, 0.0)
    share = min(1.0, CALIBRATION_ROWS / (n_t + n_c))
    sample = texts.where(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") <= int(share * (1 << 32)))
    pairs = scored(sample.select(F.col("toxic").alias("id"), "text"), model).select("id", "evidence").collect()
    x, y = np.array([r["evidence"] for r in pairs]), np.array([float(r["id"]) for r in pairs])
    model.slope, model.shift = logistic(x, y)
    return model


def background(clean: DataFrame, weights: dict[str, float] | WeightTable) -> tuple[int, int, float]:
    """Words of the texts (h, text), words with a weight among them, and the sum of these weights."""
    if isinstance(weights, WeightTable):
        words = clean.select("text").mapInArrow(length_task([]), "n_words bigint").agg(F.sum("n_words")).first()[0]
        weighed = weights.hits(clean).select(F.explode("hits.weight").alias("weight"))
        hits, total = weighed.agg(F.count(F.lit(1)), F.sum("weight")).first()
    else:
        words, hits, total = clean.select("text").mapInArrow(
            background_task(weights), "words bigint, hits bigint, total double") \
            .agg(F.sum("words"), F.sum("hits"), F.sum("total")).first()
    return words or 0, hits or 0, total or 0.0


def background_task(weights: dict[str, float]):
    def run(batches):
        memo = Weights(weights)
        for batch in batches:
            words = hits = 0
            total = 0.0
            for text in batch.column(0).to_pylist():
                found = WORD.findall(text.lower())
                values = [v for v in map(memo.__getitem__, found) if v]
                words, hits, total = words + len(found), hits + len(values), total + sum(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([words], pa.int64()), pa.array([hits], pa.int64()), pa.array([total])],
                ["words", "hits", "total"])
    return run


_PASSAGE = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()),
                               ("expected", pa.float64())]))
SCORED = ("evidence double, score double, passages array<struct<first_word:bigint,last_word:bigint,"
          "score:double,expected:double>>")


def rated(model: Model, n_words: int, hits: list[tuple[int, float]]):
    """(evidence, score, passages) of a text."""
    if not hits:
        return 0.0, 1 / (1 + math.exp(-model.shift)), []
    found = segments(hits)
    x = log_p([s for _, _, s in found], n_words, model.scale, model.k)
    expected = [model.k * n_words * math.exp(-model.scale * s) for _, _, s in found]
    return x, 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * x + model.shift)))), [
        dict(first_word=a, last_word=b, score=s, expected=e) for (a, b, s), e in zip(found, expected) if e <= SIGNIFICANT]


def rated_batch(ids, rows: list[tuple]) -> pa.RecordBatch:
    evidence, score, passages = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(evidence, pa.float64()), pa.array(score, pa.float64()), pa.array(passages, _PASSAGE)],
        ["id", "evidence", "score", "passages"])


def score_task(model: Model):
    """(id, text) -> SCORED, with the weights at hand."""
    def run(batches):
        memo = Weights(model.weights)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = WORD.findall(text.lower())
                rows.append(rated(model, len(words), [(i, v) for i, v in enumerate(map(memo.__getitem__, words)) if v]))
            yield rated_batch(batch.column(0), rows)
    return run


def hits_task(model: Model):
    """(id, n_words, hits) -> SCORED."""
    def run(batches):
        for batch in batches:
            yield rated_batch(batch.column(0), [
                rated(model, n, [(x["place"], x["weight"]) for x in hits or ()])
                for n, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())])
    return run


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """(id, evidence, score, passages) for every row (id, text)."""
    kind = rows.schema["id"].dataType.simpleString()
    if not isinstance(model.weights, WeightTable):
        return rows.mapInArrow(score_task(model), f"id {kind}, {SCORED}")
    keyed = rows.select("id", F.sha2("text", 256).alias("h"), "text")
    sized = keyed.mapInArrow(length_task(["id", "h"]), f"id {kind}, h string, n_words bigint")
    # the tasks need the scales of the model, not its table
    scales = Model({}, model.scale, model.k, model.slope, model.shift)
    return sized.join(model.weights.hits(keyed), "h", "left").select("id", "n_words", "hits") \
        .mapInArrow(hits_task(scales), f"id {kind}, {SCORED}")


def score(docs: DataFrame, model: Model | None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, evidence, score, passages) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return scored(rows, model or Model({}, 1.0, 0.1, 1.0, -40.0)).withColumnRenamed("id", id_col)
