"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

Every byte has a learned vector for each place in a filter, so a filter's value at a
position is a sum of table entries. The rectified values are max-pooled over chunks
of CHUNK bytes that overlap by half and together cover the whole text; one more
layer turns each chunk's pooled values into features, and the mean and the maximum
of those over the chunks give one probability.

The network is trained on the driver on a bounded sample of labelled texts and
applied to every text by the executors, one text after another.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import give_back

WIDTH, FILTERS, HIDDEN = 4, 16, 8
HALF = 256  # a chunk is two halves
CHUNK = 2 * HALF
THRESHOLD = 0.7
# rows and bytes of text that training sees, at most
TRAIN_ROWS, TRAIN_BYTES = 2400, 6_000_000
EPOCHS, BATCH, RATE = 6, 32, 0.02
# few texts are gone through more often, until there were so many steps
LEAST_STEPS = 400
# share of training steps on an excerpt, and its range of lengths
EXCERPTS, EXCERPT = 0.3, (5, 200)
SEED = 5


@dataclass
class Network:
    table: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    dense: np.ndarray  # (FILTERS, HIDDEN)
    dense_bias: np.ndarray  # (HIDDEN,)
    out: np.ndarray  # (2 * HIDDEN,)
    out_bias: np.ndarray  # (1,)

    @staticmethod
    def fresh(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        # as if each byte had a random vector that a random filter is applied to
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            draw(WIDTH, 256, FILTERS, scale=0.3),
            np.zeros(FILTERS, np.float32),
            draw(FILTERS, HIDDEN, scale=0.3),
            np.zeros(HIDDEN, np.float32),
            draw(2 * HIDDEN, scale=0.3),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]


def _positions(data: np.ndarray) -> int:
    return max(1, len(data) - WIDTH + 1)


def _filtered(net: Network, data: np.ndarray) -> np.ndarray:
    """Rectified filter values at each position of a text of at least WIDTH bytes."""
    n = _positions(data)
    value = net.table[0].take(data[:n], axis=0)
    for k in range(1, WIDTH):
        value += net.table[k].take(data[k : k + n], axis=0)
    value += net.bias
    return np.maximum(value, 0, out=value)


def as_bytes(text: str | None) -> np.ndarray:
    """The bytes of a text, closed by zeros to a filter's width."""
    raw = (text or "").encode()
    return np.frombuffer(raw.ljust(WIDTH, b"\0"), np.uint8)


def _pool(value: np.ndarray) -> np.ndarray:
    """Maximum over each half; the last one may be shorter."""
    return np.maximum.reduceat(value, np.arange(0, len(value), HALF), axis=0)


def _chunks(halves: np.ndarray) -> np.ndarray:
    """Maximum over each chunk, two neighbouring halves, or the only half."""
    return np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves


def score(net: Network, text: str | None, block: int = 1 << 18) -> float:
    """Probability that a text is good. Long texts are filtered block by block, whole."""
    data = as_bytes(text)
    pieces = [
        _pool(_filtered(net, data[at : at + block + WIDTH - 1])) for at in range(0, _positions(data), block)
    ]
    pooled = _chunks(np.concatenate(pieces))
    hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
    z = float(np.concatenate([hidden.mean(axis=0), hidden.max(axis=0)]) @ net.out + net.out_bias[0])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _backward(net: Network, text: str | None, label: float, weight: float, grads: list[np.ndarray]) -> None:
    """Add the gradient of one text's weighted log loss to ``grads``."""
    g_table, g_bias, g_dense, g_dense_bias, g_out, g_out_bias = grads
    data = as_bytes(text)
    value = _filtered(net, data)
    n = len(value)
    starts = np.arange(0, n, HALF)
    halves = np.maximum.reduceat(value, starts, axis=0)
    pooled = _chunks(halves)
    hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
    top = hidden.argmax(axis=0)
    features = np.concatenate([hidden.mean(axis=0), hidden.max(axis=0)])
    z = float(features @ net.out + net.out_bias[0])
    error = np.float32(weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label))
    g_out += error * features
    g_out_bias += error
    d_features = error * net.out
    d_hidden = np.repeat(d_features[None, :HIDDEN] / len(hidden), len(hidden), axis=0)
    d_hidden[top, np.arange(HIDDEN)] += d_features[HIDDEN:]
    d_hidden[hidden <= 0] = 0
    g_dense += pooled.T @ d_hidden
    g_dense_bias += d_hidden.sum(axis=0)
    d_pooled = d_hidden @ net.dense.T
    # a pooled value came from one position: the first with the maximum in its chunk
    d_halves = np.zeros_like(halves)
    if len(halves) > 1:
        left = halves[:-1] >= halves[1:]
        d_halves[:-1] += d_pooled * left
        d_halves[1:] += d_pooled * ~left
    else:
        d_halves += d_pooled
    for half, at in enumerate(starts):
        part = value[at : at + HALF]
        where = part.argmax(axis=0)
        d = d_halves[half] * (part[where, np.arange(FILTERS)] > 0)
        g_bias += d
        for k in range(WIDTH):
            g_table[k, data[at + where + k], np.arange(FILTERS)] += d  # one entry a filter


def train(
    texts: list[str | None],
    labels: list[int],
    good: float | None = None,
    epochs: int = EPOCHS,
    seed: int = SEED,
    least_steps: int = LEAST_STEPS,
) -> Network:
    """A network fitted by Adam to labelled texts, weighted so that ``good`` is the share
    of label 1 (None: as they are), in ``epochs`` passes over them or more.

    Without texts the fresh network is returned, with an output of one half.
    """
    net = Network.fresh(seed)
    if not texts:
        net.out[:] = 0
        return net
    rng = np.random.default_rng(seed)
    share = np.bincount(np.asarray(labels), minlength=2) / len(labels)
    prior = [1 - good, good] if good is not None else share
    weights = [float(p / s) if s else 0.0 for p, s in zip(prior, share)]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    steps = -(-len(texts) // BATCH)
    epochs = max(epochs, -(-least_steps // steps))
    step, total = 0, epochs * steps
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            grads = [np.zeros_like(p) for p in net.parameters()]
            batch = order[at : at + BATCH]
            for i in batch:
                text = texts[i] or ""
                if rng.random() < EXCERPTS:  # few labelled texts are short, though many texts are
                    at = int(rng.integers(0, len(text) + 1))
                    text = text[at : at + int(rng.integers(*EXCERPT))]
                _backward(net, text, labels[i], weights[labels[i]], grads)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for p, g, m, v in zip(net.parameters(), grads, first, second):
                g /= len(batch)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row may not be learned from; a null id is never held out and never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAIN_ROWS,
    size: int = TRAIN_BYTES,
    longest: int | None = None,
) -> tuple[list[str | None], list[int], float | None]:
    """Labelled texts, their labels and the share of label 1 among all rows that may be learned from.

    The texts are those that aren't held out, drawn by a hash of the id: at most about
    ``rows``, and ``size`` bytes, half of either for each label. Texts of more than
    ``longest`` bytes, by default a fiftieth of ``size``, are never learned from, so that no
    few of them use up the bytes; they are scored by a network that saw only shorter ones.

    An id with several labels counts by its lowest one. Whole texts only.
    """
    marked = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
    marked = marked.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    there = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().toLocalIterator()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20))
    keep = F.lit(False)
    for label, count in there.items():
        keep = keep | ((F.col("quality") == label) & (draw < min(1.0, rows / 2 / count) * (1 << 20)))
    drawn = marked.where(keep)  # about ``rows`` rows
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).join(
        F.broadcast(drawn), "doc_id"
    )
    sizes = sizes.groupBy("doc_id", "quality").agg(F.max("n").alias("longest"), F.sum("n").alias("n"))
    sizes = sizes.where(F.col("longest") <= (size // 50 if longest is None else longest))
    # of each label the first by their draw while their sizes fit: only these texts come to the driver
    left = {0: size // 2, 1: size // 2}
    chosen = []
    for r in sizes.select("doc_id", "quality", "n", draw.alias("draw")).orderBy("draw", "doc_id").toLocalIterator():
        if left[r["quality"]] >= r["n"]:
            left[r["quality"]] -= r["n"]
            chosen.append((r["doc_id"], r["quality"], r["draw"]))
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, quality int, draw long")
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("text", "quality", "draw")
    chosen = sorted(texts.toLocalIterator(), key=lambda r: (r["draw"], r["text"] or ""))
    good = there.get(1, 0) / sum(there.values()) if there else None
    return [r["text"] for r in chosen], [r["quality"] for r in chosen], good


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs`` (text and others) as ``row``, with the ``score`` of each row.

    A null text counts as empty, and an empty one gets the score that the network
    gives to no bytes. Repeated rows get the same score each.
    """
    net = train(*training_sample(docs, labels))
    give_back()  # what the driver took for the texts

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([score(net, text) for text in texts], dtype="float64")

    return docs.select(F.struct(*docs.columns).alias("row"), F.pandas_udf(of, "double")("text").alias("score"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs`` (doc_id, text)."""
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    rows = scored(docs.select("doc_id", "text"), labels)
    return rows.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", predicted)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't rejected."""
    return scored(docs, labels).where(F.col("score") >= threshold).select("row.*")
