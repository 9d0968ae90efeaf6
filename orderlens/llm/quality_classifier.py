"""Quality classifier: supervised subword embeddings, averaged per document.

Every word, every pair of neighbouring words and every character n-gram within a word
(the blank on either side counts as a character) is hashed to one of ``BUCKETS`` vectors.
A document is the mean of its vectors; a softmax layer gives class probabilities.  The
vectors and the layer are learned together with NumPy stochastic gradient descent,
one document a step, classes drawn alike.  A word that follows itself has one bucket for
its pair whatever the word, so repetition is seen too.

Since the layer is linear and a document a mean, the product of vectors and layer is
one number a bucket and class: applying the network to a text is a table look-up for
each n-gram, over the whole text.  A very long text is read in parts and gives the sums
of its parts.

Training texts are a bounded sample: at most ``SAMPLE_PER_CLASS`` texts a label, drawn by
a hash, of each ``SAMPLE_WINDOWS`` windows of ``WINDOW_BYTES``; the windows are cut
where the texts are read.

Defined cases: null or word-less text has the probability that the layer gives a zero
vector; a label that is null is no label, a document labelled more than once
has its largest label; labels for ids that are null or not in the table are not used; with fewer than two
labels in the sample every score is 0.5 (no label) or 1 or 0 (the one label is or is not
the wanted one); an empty table gives no rows; repeated rows get equal results; in texts a
word of more than ``PART_CHARS`` characters is cut into words of that length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import free_name
from orderlens.llm.hashing import text_groups

BUCKETS = 1 << 16
DIMENSIONS = 16
NGRAMS = (3, 4, 5)
#: Bounds of the training sample.
SAMPLE_PER_CLASS = 4_000
SAMPLE_WINDOWS = 4
WINDOW_BYTES = 2_000
#: Steps of the descent (documents shown), whatever the size of the sample.
STEPS = 20_000
RATE = 2.0
#: Bytes of texts, and characters of a long text, whose n-grams are computed at once.
GROUP_BYTES = 1 << 16
PART_CHARS = 1 << 16

U64 = np.uint64
#: Odd factors of the hashes: of character positions, of words, of pairs and of n-grams by length.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_WORD, _LEFT, _RIGHT = U64(0xFF51AFD7ED558CCD), U64(0xC2B2AE3D27D4EB4F), U64(0x9FB21C651E98DF25)
_NGRAM = {n: U64((0xC4CEB9FE1A85EC53 * (2 * n + 1)) & (2**64 - 1)) for n in NGRAMS}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


class Features:
    """Buckets of the n-grams of texts given as one run of code points."""

    def __init__(self, buckets: int = BUCKETS):
        self.shift = U64(64 - (buckets.bit_length() - 1))
        self.up = self.down = np.zeros(0, U64)

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return (h >> self.shift).view(np.int64)

    def of(self, points: np.ndarray, rows: np.ndarray):
        """Yields (bucket, counted, first): row i has the entries first[i]:first[i + 1] for which ``counted`` holds
        (None: all).  ``points`` has a blank before and behind every row and no other separator than
        blanks; ``rows`` are the places of the blanks before each row, and of the last blank."""
        size = len(points)
        if len(self.up) < size:
            self.up, self.down = _powers(_FACTOR, size), _powers(_INVERSE, size)
        total = np.zeros(size + 1, U64)
        np.cumsum(points * self.up[:size], out=total[1:])
        inside = points != 32
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        if not len(starts):
            return
        first = np.searchsorted(starts, rows)
        # equal substrings have equal hashes: the factor of the start is divided out
        word = (total[ends] - total[starts]) * self.down[starts] * _WORD
        yield self.bucket(word), None, first
        pair = word[:-1] * _LEFT + word[1:] * _RIGHT
        pair[word[:-1] == word[1:]] = _LEFT
        within = np.ones(len(pair), bool)
        within[first[(first > 0) & (first < len(word))] - 1] = False
        yield self.bucket(pair), within, np.minimum(first, len(pair))
        for n in NGRAMS:
            places = size - n + 1
            if places <= 0:
                break
            # all characters but the outer ones belong to one word
            counted = inside[1:places + 1].copy()
            for j in range(2, n - 1):
                counted &= inside[j:places + j]
            h = (total[n:] - total[:places]) * self.down[:places] * _NGRAM[n]
            yield self.bucket(h), counted, np.minimum(rows, places)


def code_points(raw: bytes) -> np.ndarray:
    """Code points with one blank for each run of separators."""
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    keep = ~blank
    keep[:1] = True
    keep[1:] |= ~blank[:-1]
    return np.where(blank, np.uint32(32), points)[keep]


def joined(texts: list[np.ndarray]):
    """Code points of texts with blanks between, and the places of the blanks."""
    out = np.full(sum(map(len, texts)) + len(texts) + 1, 32, np.uint32)
    place, at = [0], 1
    for t in texts:
        out[at:at + len(t)] = t
        at += len(t) + 1
        place.append(at - 1)
    return out, np.array(place)


def parts(points: np.ndarray, size: int = PART_CHARS):
    """Yields (part, again): a long text cut at blanks; a part begins with ``again``, the last word of the
    one before, so that no pair of neighbours is lost."""
    at = again = 0
    while len(points) - at > size:
        blanks = np.flatnonzero(points[at + 1:at + size] == 32)
        end = at + 1 + int(blanks[-1]) if len(blanks) else at + size
        yield points[again:end], points[again:at]
        back = np.flatnonzero(points[max(at, end - size):end] != 32)
        last = max(at, end - size) + int(back[-1]) + 1 if len(back) else end
        before = np.flatnonzero(points[at:last] == 32)
        again = (at + int(before[-1]) if len(before) else at) if len(blanks) and len(back) else end
        at = end
    yield points[again:], points[again:at]


class Network:
    """Vectors of the buckets and the softmax layer."""

    def __init__(self, classes: list, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.vectors = np.zeros((buckets, dimensions), np.float32)
        self.layer = rng.normal(0, 1, (dimensions, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), np.float32)

    @staticmethod
    def layer_only(net: "Network") -> "Network":
        """What tasks need beside ``table``."""
        out = Network(net.classes, 0)
        out.layer, out.bias = net.layer, net.bias
        return out

    def table(self) -> np.ndarray:
        """(classes - 1, buckets): what a bucket adds to each class more than to the first."""
        layer = self.layer.astype(np.float64)
        return np.ascontiguousarray((self.vectors.astype(np.float64) @ (layer[:, 1:] - layer[:, :1])).T)

    def probabilities(self, rest: np.ndarray) -> np.ndarray:
        """Class probabilities from the sums of ``table``."""
        bias = self.bias.astype(np.float64)
        return softmax(np.concatenate([np.zeros((len(rest), 1)), rest + bias[1:] - bias[0]], axis=1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: list, steps: int = STEPS,
          rate: float = RATE, seed: int = 17) -> Network:
    """``documents``: (distinct buckets, their shares).  One document a step; the class is drawn first."""
    net, rng = Network(classes), np.random.default_rng(seed)
    of_class = [np.flatnonzero(labels == k) for k in range(len(classes))]
    drawn = rng.integers(0, len(classes), steps)
    for step in range(steps):
        k = drawn[step]
        bucket, share = documents[of_class[k][rng.integers(0, len(of_class[k]))]]
        own = net.vectors[bucket]
        hidden = share @ own
        error = softmax(hidden @ net.layer + net.bias)
        error[k] -= 1
        now = np.float32(rate * (1 - step / steps))
        down = net.layer @ error
        net.layer -= now * np.outer(hidden, error).astype(np.float32)
        net.bias -= now * 0.1 * error.astype(np.float32)
        # a bucket's share is small, so its vector moves by the share's root: else rare n-grams never learn
        net.vectors[bucket] = own - np.outer(np.sqrt(share) * now, down).astype(np.float32)
    return net


def windows(raw: bytes) -> bytes:
    """At most ``SAMPLE_WINDOWS`` windows, spread evenly, cut at blanks where there are any."""
    if len(raw) <= SAMPLE_WINDOWS * WINDOW_BYTES:
        return raw
    out = []
    for k in range(SAMPLE_WINDOWS):
        at = (len(raw) - WINDOW_BYTES) * k // (SAMPLE_WINDOWS - 1)
        piece = raw[at:at + WINDOW_BYTES]
        lo = piece.find(b" ") if at else 0
        hi = piece.rfind(b" ") if at + WINDOW_BYTES < len(raw) else len(piece)
        out.append(piece[max(lo, 0):hi] if max(lo, 0) < hi else piece)
    return b" ".join(out)


def sample_task(batches):
    for batch in batches:
        pieces = [windows(raw) for raw in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array(pieces, pa.binary())],
                                         ["label", "h", "digest", "pieces"])


def sample(docs: DataFrame, labels: DataFrame, trainable: Column, label_col: str, text_col: str,
           id_col: str) -> DataFrame:
    """(label, pieces) of the training texts."""
    of_id = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    own = docs.where(trainable).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a hash threshold leaves the ids of about twice the sample: a bounded number, sent to where the
    # texts are read, so that no other text is moved
    count = of_id.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
    h = F.xxhash64("id", F.lit(9))
    drawn = of_id.join(F.broadcast(count), "label").where(
        F.pmod(h, F.lit(1 << 30)) < 2 * SAMPLE_PER_CLASS / F.col("of_label") * (1 << 30)).select("id", "label")
    some = own.join(F.broadcast(drawn), "id").select("label", h.alias("h"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
                                        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw"))
    kind = labels.schema[label_col].dataType.simpleString()
    cut = some.mapInArrow(sample_task, f"label {kind}, h bigint, digest string, pieces binary")
    first = Window.partitionBy("label").orderBy("h", "digest")
    return cut.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE_PER_CLASS) \
        .orderBy("label", "k").select("label", "pieces")


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, label_col: str = "quality", text_col: str = "text",
        id_col: str = "doc_id") -> Network:
    """Network learned from the labelled documents for which ``trainable`` holds."""
    rows = sample(docs, labels, trainable, label_col, text_col, id_col).collect()
    classes = sorted({r["label"] for r in rows})
    features, documents, of_row = Features(), [], []
    for r in rows:
        points, place = joined([code_points(bytes(r["pieces"]))])
        found = [b if counted is None else b[counted] for b, counted, _ in features.of(points, place)]
        if not found:
            continue
        bucket, count = np.unique(np.concatenate(found), return_counts=True)
        documents.append((bucket, (count / count.sum()).astype(np.float32)))
        of_row.append(classes.index(r["label"]))
    if len(set(of_row)) < 2:
        return Network(sorted({classes[k] for k in of_row}))
    return train(documents, np.array(of_row), classes)


def add_group(features: Features, table: np.ndarray, texts: list[np.ndarray], sums: np.ndarray, counts: np.ndarray,
              sign: int = 1) -> None:
    points, place = joined(texts)
    for bucket, counted, first in features.of(points, place):
        rows = np.flatnonzero(first[1:] > first[:-1])
        if not len(rows):
            continue
        counts[rows] += sign * (np.diff(first)[rows] if counted is None else
                                np.add.reduceat(counted, first[rows], dtype=np.int64))
        for k in range(len(table)):
            value = table[k].take(bucket)
            if counted is not None:
                value *= counted
            sums[k, rows] += sign * np.add.reduceat(value, first[rows])


def logits(features: Features, table: np.ndarray, column: pa.Array) -> np.ndarray:
    """(rows, classes): mean contribution of the n-grams of each text."""
    out = np.zeros((len(column), len(table)))
    for lo, data, offsets in text_groups(column, GROUP_BYTES):
        texts = [code_points(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        total, count = np.zeros((len(table), len(texts))), np.zeros(len(texts), np.int64)
        if len(texts) == 1:
            for part, again in parts(texts[0]):
                add_group(features, table, [part], total, count)
                add_group(features, table, [again], total, count, -1)
        else:
            add_group(features, table, texts, total, count)
        out[lo:lo + len(texts)] = (total / np.maximum(count, 1)).T
    return out


def predict_task(net: Network, wanted: int):
    table = net.table()
    net = Network.layer_only(net)

    def run(batches):
        features = Features()
        for batch in batches:
            p = net.probabilities(logits(features, table, batch.column(1)))[:, wanted]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])
    return run


def predict(docs: DataFrame, net: Network, label=1, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score): probability of ``label`` for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if len(net.classes) < 2 or label not in net.classes:
        alone = 0.5 if not net.classes else float(net.classes == [label])
        return rows.select(F.col("id").alias(id_col), F.lit(alone).alias("score"))
    task = predict_task(net, net.classes.index(label))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(task, f"id {kind}, score double").withColumnRenamed("id", id_col)
