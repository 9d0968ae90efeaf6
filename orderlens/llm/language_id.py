"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes.  Filters of several
widths run over the bytes (a filter is one weight per byte value and offset, so
a convolution is a sum of table rows), the maximum over a window is pooled, and
a softmax layer gives class probabilities.  A text's probabilities are the mean
over all its windows.  The network is trained with NumPy on a bounded sample of
labelled texts, chosen per language by a hash; it is applied in batches to every
window of every text.

Defined cases: null text or text without a letter is ``und`` with score 0; without
any labelled text everything is ``und``; ties go to the first language in code
point order; repeated rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import free_name
from orderlens.llm.hashing import text_groups

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
#: Labelled texts that the network is trained on: at most so many per language, and in all.
SAMPLE_PER_LANGUAGE = 800
SAMPLE_TOTAL = 20_000
#: Windows of each training text, spread evenly over it.
SAMPLE_WINDOWS = 3
EPOCHS = 8
UNDETERMINED = "und"
PAD = max(WIDTHS) - 1


class Network:
    """Weights; ``tables[w]`` has shape (width, 256, filters)."""

    def __init__(self, classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.top = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)).astype(np.float32)
        self.top_bias = np.zeros(classes, np.float32)

    def parameters(self):
        return [*self.tables, *self.bias, self.top, self.top_bias]

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.top + self.top_bias

    def pooled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Maxima over the places ``start <= i < end`` of each window; PAD bytes and more follow the last end."""
        bounds = np.stack([starts, ends], axis=1).reshape(-1)
        out = np.empty((len(starts), FILTERS * len(WIDTHS)), np.float32)
        n = len(data) - PAD
        for k, (w, table) in enumerate(zip(WIDTHS, self.tables)):
            total = table[0].take(data[:n], axis=0)
            for j in range(1, w):
                total += table[j].take(data[j:n + j], axis=0)
            out[:, k * FILTERS:(k + 1) * FILTERS] = np.maximum.reduceat(total, bounds, axis=0)[::2] + self.bias[k]
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, classes: int, epochs: int = EPOCHS, batch: int = 256,
          rate: float = 0.01, seed: int = 11) -> Network:
    """``windows``: (n, WINDOW + PAD) bytes.  Adam on the cross entropy; classes weigh alike."""
    net, rng = Network(classes), np.random.default_rng(seed)
    weight = 1 / np.maximum(np.bincount(labels, minlength=classes), 1)
    weight = (weight / weight[labels].mean()).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            x, y = windows[pick], labels[pick]
            rows = np.arange(len(pick))
            pooled, where = [], []
            for table, bias, w in zip(net.tables, net.bias, WIDTHS):
                total = table[0][x[:, :WINDOW]]
                for j in range(1, w):
                    total += table[j][x[:, j:WINDOW + j]]
                best = total.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(total, best[:, None, :], axis=1)[:, 0] + bias)
            p = np.concatenate(pooled, axis=1)
            hidden = np.maximum(p, 0)
            error = softmax(hidden @ net.top + net.top_bias)
            error[rows, y] -= 1
            error *= (weight[y] / len(pick))[:, None]
            down = (error @ net.top.T) * (p > 0)
            grads_t, grads_b = [], []
            for k, (w, best) in enumerate(zip(WIDTHS, where)):
                g = down[:, k * FILTERS:(k + 1) * FILTERS]
                grad = np.zeros_like(net.tables[k])
                filters = np.broadcast_to(np.arange(FILTERS), best.shape)
                for j in range(w):
                    np.add.at(grad[j], (x[rows[:, None], best + j], filters), g)
                grads_t.append(grad)
                grads_b.append(g.sum(axis=0))
            step += 1
            for value, grad, (m, v) in zip(net.parameters(), [*grads_t, *grads_b, hidden.T @ error, error.sum(axis=0)],
                                           moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def sample_windows(raw: bytes) -> list[np.ndarray]:
    data = np.frombuffer(raw, np.uint8)
    count = max(1, min(SAMPLE_WINDOWS, len(data) // WINDOW))
    out = []
    for k in range(count):
        at = (len(data) - WINDOW) * k // max(1, count - 1) if len(data) > WINDOW else 0
        piece = np.zeros(WINDOW + PAD, np.uint8)
        own = data[at:at + WINDOW + PAD]
        piece[:len(own)] = own
        out.append(piece)
    return out


def sample_task(batches):
    """(lang, h, digest, raw) -> (lang, h, digest, pieces): the sample windows of each text, one after the other."""
    for batch in batches:
        pieces = [np.concatenate(sample_windows(raw)).tobytes() for raw in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            batch.columns[:3] + [pa.array(pieces, pa.binary())], ["lang", "h", "digest", "pieces"])


def sample(docs: DataFrame, trainable: Column, text_col: str = "text", lang_col: str = "lang",
           id_col: str = "doc_id") -> DataFrame | None:
    """(lang, pieces) of the training texts, or None without a labelled row.  The windows are cut where
    the texts are read, so a text of any length is moved as its windows only."""
    h = free_name(docs, "h")
    labelled = docs.where(trainable & F.col(lang_col).isNotNull()).withColumn(h, F.xxhash64(F.col(id_col), F.lit(5)))
    counts = labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    # a hash threshold per language leaves about twice the sample, so that only these texts are moved
    share = F.coalesce(*[F.when(F.col(lang_col) == r["lang"], F.lit(2 * SAMPLE_PER_LANGUAGE / r["n"])) for r in counts])
    drawn = labelled.where(F.pmod(h, F.lit(1 << 30)) < share * (1 << 30)).where(has_letter(F.col(text_col))).select(
        F.col(lang_col).alias("lang"), F.col(h).alias("h"), F.sha2(text_col, 256).alias("digest"),
        F.encode(text_col, "UTF-8").alias("raw"))
    cut = drawn.mapInArrow(sample_task, "lang string, h bigint, digest string, pieces binary")
    first = Window.partitionBy("lang").orderBy("h", "digest")
    return cut.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE_PER_LANGUAGE) \
        .orderBy("k", "lang").limit(SAMPLE_TOTAL).select("lang", "pieces")


def fit(docs: DataFrame, trainable: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id"):
    """(languages, network) from the labelled rows for which ``trainable`` holds, or None without any."""
    drawn = sample(docs, trainable, text_col, lang_col, id_col)
    rows = drawn.collect() if drawn is not None else []
    if not rows:
        return None
    names = sorted({r["lang"] for r in rows})
    windows, labels = [], []
    for r in rows:
        for piece in np.frombuffer(bytes(r["pieces"]), np.uint8).reshape(-1, WINDOW + PAD):
            windows.append(piece)
            labels.append(names.index(r["lang"]))
    return names, train(np.stack(windows), np.array(labels), len(names))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict_group(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean class probabilities over the windows of each row (zero for empty rows)."""
    length = np.diff(offsets)
    # PAD zero bytes after each row, so that the filters at a row's places see nothing of the next
    padded = np.zeros(len(data) + PAD * len(length) + 1, np.uint8)
    place = offsets[:-1] + PAD * np.arange(len(length))
    padded[np.arange(len(data)) + PAD * np.repeat(np.arange(len(length)), length)] = data
    count = -(-length // WINDOW)
    row = np.repeat(np.arange(len(length)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = place[row] + WINDOW * k
    ends = np.minimum(starts + WINDOW, (place + length)[row])
    out = np.zeros((len(length), len(net.top_bias)))
    if not len(starts):
        return out
    step = 64
    for lo in range(0, len(starts), step):
        hi = min(lo + step, len(starts))
        begin = starts[lo]
        piece = padded[begin:ends[hi - 1] + PAD + 1]
        p = softmax(net.logits(net.pooled(piece, starts[lo:hi] - begin, ends[lo:hi] - begin)))
        np.add.at(out, row[lo:hi], p)
    full = count > 0
    out[full] /= count[full, None]
    return out


def predict_task(names: list[str], net: Network, columns: list[str]):
    def run(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            pred, score = [], []
            for _, data, offsets in text_groups(text, 1 << 19):
                p = predict_group(net, data, offsets)
                best = p.argmax(axis=1)
                pred += [names[i] for i in best]
                score += p[np.arange(len(best)), best].tolist()
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                columns + ["lang_pred", "score"])
    return run


def predict(docs: DataFrame, model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), has_letter(F.col(text_col)).alias("letters"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    scored = rows.mapInArrow(
        predict_task(*model, ["id", "letters"]),
        f"id {rows.schema['id'].dataType.simpleString()}, letters boolean, lang_pred string, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("letters"), F.least("score", F.lit(1.0))).otherwise(0.0).alias("score"))
