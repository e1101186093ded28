"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all of its bytes. Each chunk goes through byte
embeddings, learned filters and a max-pool to one logit; the logits of all chunks are combined into one
probability by a logistic layer over their mean, maximum, minimum and spread.

Null and empty texts are scored like a document with one chunk of padding; long texts in full, and they are
learned from in full, too. Rows are scored one by one, so repeated rows and ties have equal scores; an empty
table gives an empty result; columns beyond the two named ones are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, in_one_task, slices, text_bytes

CHUNK, HOP = 256, 240  # bytes; neighbours share 16
BLOCK, DIM, FILTERS = 4, 8, 24  # a filter sees two blocks of four bytes
#: Bound of the labelled sample that the network is fitted on, in whole documents; and the weight in chunks of a long one.
MAX_TRAIN_DOCS, MOST_WEIGHT = 4000, 12
THRESHOLD = 0.3
DECIMALS = 9  # of a score


def chunk_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every chunk and the number of chunks of each document, one at least."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-(size - (CHUNK - HOP)) // HOP))
    first = np.cumsum(count) - count
    return (np.arange(count.sum()) - np.repeat(first, count)) * HOP + np.repeat(offsets[:-1], count), count


def chunk_matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK) bytes, zero behind the end of the document."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


class ByteNet:
    """Embedding, filters and output weights, with a forward pass over chunks and a training step."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        wide = BLOCK * DIM
        self.p = {
            "emb": r.normal(0, 0.5, (256, DIM)).astype(np.float32),
            "conv": r.normal(0, (2 * wide) ** -0.5, (wide, 2 * FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, FILTERS**-0.5, FILTERS).astype(np.float32),
            "c": np.zeros(1, np.float32),
        }
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def filtered(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.p["emb"][chunks].reshape(len(chunks), CHUNK // BLOCK, BLOCK * DIM)
        y = x @ self.p["conv"]
        return x, y[:, :-1, :FILTERS] + y[:, 1:, FILTERS:]

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        if not len(chunks):
            return np.zeros(0)
        pooled = np.maximum(self.filtered(chunks)[1].max(axis=1) + self.p["bias"], 0)
        # summed chunk by chunk: a product with a vector would round by how many chunks there are
        return np.clip((pooled.astype(np.float64) * self.p["out"]).sum(axis=1) + self.p["c"], -12, 12)

    def step(self, chunks: np.ndarray, label: np.ndarray, weight: np.ndarray, rate: float) -> None:
        x, y = self.filtered(chunks)
        n, where = np.arange(len(chunks))[:, None], y.argmax(axis=1)
        top = np.take_along_axis(y, where[:, None, :], 1)[:, 0] + self.p["bias"]
        pooled = np.maximum(top, 0)
        z = np.clip(pooled @ self.p["out"] + self.p["c"], -30, 30)
        g = ((1 / (1 + np.exp(-z)) - label) * weight / len(chunks)).astype(np.float32)
        gp = g[:, None] * self.p["out"] * (top > 0)
        grads = {"out": pooled.T @ g, "c": g.sum(keepdims=True), "bias": gp.sum(0), "conv": np.empty_like(self.p["conv"]), "emb": np.zeros_like(self.p["emb"])}
        for half in (0, 1):
            cols = slice(half * FILTERS, (half + 1) * FILTERS)
            grads["conv"][:, cols] = np.einsum("nfk,nf->kf", x[n, where + half], gp)
            back = (gp[:, :, None] * self.p["conv"][:, cols].T).reshape(-1, DIM)
            seen = chunks.reshape(len(chunks), -1, BLOCK)[n, where + half].reshape(-1)
            np.add.at(grads["emb"], seen, back)
        self.t += 1
        for k, d in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * d
            self.v[k] = 0.999 * self.v[k] + 0.001 * d * d
            self.p[k] = (self.p[k] - rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def pooled(logits: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(documents, 4): mean, maximum, minimum and spread of the logits of each document."""
    if not len(count):
        return np.zeros((0, 4))
    first = np.cumsum(count) - count
    z = logits.astype(np.float64)
    mean = np.add.reduceat(z, first) / count
    spread = np.sqrt(np.maximum(np.add.reduceat(z * z, first) / count - mean * mean, 0))
    return np.stack([mean, np.maximum.reduceat(z, first), np.minimum.reduceat(z, first), spread], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression with intercept, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x / len(x) + penalty, x.T @ (p - y) / len(x) + penalty @ w)
    return w


def train(texts: list[str | None], label: np.ndarray, epochs: int = 3, seed: int = 7) -> dict:
    """Fit the network on chunks and the combining layer on documents; labels are 0 or 1."""
    net, r = ByteNet(seed), np.random.default_rng(seed)
    if not len(texts) or label.min() == label.max():  # nothing to tell apart: the share of ones, smoothed
        share = (label.sum() + 1) / (len(texts) + 2)
        return {"p": net.p, "w": np.array([0, 0, 0, 0, np.log(share / (1 - share))])}
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    starts, count = chunk_starts(offsets)
    doc = np.repeat(np.arange(len(texts)), count)
    chunks, y = chunk_matrix(data, starts, offsets[1:][doc]), label[doc].astype(np.float32)
    # every chunk is learned from; those of a very long document weigh no more than MOST_WEIGHT together
    own = np.minimum(1, MOST_WEIGHT / count)[doc].astype(np.float32)
    ones = float((own * y).sum() / own.sum())
    weight = own * np.where(y == 1, 0.5 / max(ones, 1e-6), 0.5 / max(1 - ones, 1e-6)).astype(np.float32)
    steps, batch = 0, 128
    epochs = max(epochs, -(-1200 * batch // len(y)))
    total = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(y), batch):
            i = order[a : a + batch]
            net.step(chunks[i], y[i], weight[i], 0.004 * (1 - steps / total) + 1e-4)
            steps += 1
    z = np.concatenate([net.logits(chunks[a : a + 1024]) for a in range(0, len(chunks), 1024)])
    return {"p": net.p, "w": logistic(pooled(z, count), label.astype(float))}


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_docs: int = MAX_TRAIN_DOCS) -> dict:
    """Fit on a repeatable sample of about ``max_docs`` labelled documents, in one task."""
    known = bounded(labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("y")), doc_id, max_docs)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known.withColumnRenamed(doc_id, "doc_id")), "doc_id")  # about max_docs rows

    def learned(table: pa.Table) -> bytes:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        return pickle.dumps(train(table.column("text").to_pylist(), table.column("y").to_numpy().astype(np.int64)))

    return pickle.loads(in_one_task(rows.select("doc_id", "text", F.col("y").cast("long").alias("y")), learned))


def probabilities(texts: pa.Array, net: ByteNet, w: np.ndarray) -> np.ndarray:
    """One probability for each text, from all of its chunks."""
    data, offsets = text_bytes(texts)
    starts, count = chunk_starts(offsets)
    ends = np.repeat(offsets[1:], count)
    z = np.concatenate([net.logits(chunk_matrix(data, starts[a : a + 1024], ends[a : a + 1024])) for a in range(0, len(starts), 1024)])
    return np.round(1 / (1 + np.exp(-np.clip((pooled(z, count) * w[:-1]).sum(axis=1) + w[-1], -30, 30))), DECIMALS)


def loaded(model: dict) -> tuple[ByteNet, np.ndarray]:
    net = ByteNet()
    net.p = model["p"]
    return net, model["w"]


def scores(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few ten KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, w = loaded(shipped.value)
        for part in slices(batches, text):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(probabilities(part.column(1), net, w))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns; no join, so repeated ids don't matter."""
    shipped, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, w = loaded(shipped.value)
        for part in slices(batches, text):
            yield part.filter(pa.array(probabilities(part.column(at), net, w) >= threshold))

    return docs.mapInArrow(run, docs.schema)
