"""Quality by nearest neighbours in a latent-semantic space.

A text is a vector of hashed byte trigrams and of a few counts about words and lines; a truncated
singular value decomposition of a bounded labelled sample gives the latent space. Every document is
compared with all labelled vectors, block by block, by exact cosine; its nearest neighbours vote,
weighted by similarity.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import crc_of_id, filtered, id_and_text, small_batches, texts_of

BINS = 4096
#: Labelled documents learned from: at most so many of each label, picked by a hash of the id.
SAMPLE = 1500
LATENT = 48
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 256

_MARKS = re.compile(rb"[^A-Za-z0-9\s\x80-\xff]")
SHAPES = 8


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) of a text: trigrams by logarithm of their count, and shares of odd words and lines."""
    raw = text.encode("utf-8", "replace")
    codes = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    hashed = (((codes[:-2] << np.uint32(16)) | (codes[1:-1] << np.uint32(8)) | codes[2:]) * np.uint32(2654435761)) >> np.uint32(20)
    counts = np.bincount(hashed, minlength=BINS)
    index = np.flatnonzero(counts)
    weight = np.log1p(counts[index]).astype(np.float32)
    weight /= np.sqrt((weight**2).sum())
    words, lines = raw.split(), raw.split(b"\n")
    n = max(len(words), 1)
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    upper = sum(w.isupper() for w in words) / n
    shape = [
        again,
        upper,
        len(_MARKS.findall(raw)) / n,
        1 - len(set(words)) / n,
        1 - len(set(lines)) / len(lines),
        sum(w.isdigit() for w in words) / n,
        min(1.0, len(raw) / n / 20),
        1 / np.sqrt(n),
    ]
    return np.concatenate([index, BINS + np.arange(SHAPES)]), np.concatenate([weight, np.sqrt(np.array(shape, np.float32)) * 0.5])


@dataclass
class Model:
    """The latent directions, the labelled vectors in that space (unit length), their labels and the share of label 1.

    A vote weighs inversely to how often its label is in the sample, so that the rarer one counts.
    """

    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def latent(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        rows = np.zeros((len(found), BINS + SHAPES), np.float32)
        for i, (index, weight) in enumerate(found):
            rows[i, index] = weight
        made = rows @ self.directions
        size = np.sqrt((made**2).sum(axis=1, keepdims=True))
        return np.divide(made, size, out=np.zeros_like(made), where=size > 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """For each text the similarity-weighted share of label 1 among its nearest neighbours."""
        out = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return out
        for start in range(0, len(texts), BLOCK):
            near = self.latent([features(t) for t in texts[start : start + BLOCK]]) @ self.vectors.T
            k = min(self.neighbours, near.shape[1])
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 8
            total = weight.sum(axis=1)
            votes = (weight * self.labels[best]).sum(axis=1)
            votes, against = votes * (1 - self.prior), (total - votes) * self.prior
            total = votes + against
            here = slice(start, start + len(near))
            out[here] = np.where(total > 0, votes / np.maximum(total, 1e-300), self.prior)
        return np.clip(out, 0.0, 1.0)


def decompose(rows: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors as columns, by subspace iteration."""
    rank = min(rank, *rows.shape)
    basis = np.random.default_rng(seed).standard_normal((rows.shape[1], rank + 8)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = LATENT, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from at most ``sample`` labelled documents of each label, 0 and 1.

    Other labels and nulls take no part; of several texts of one id the smallest does.
    """
    marked = labels.select(labels[id_col].cast("bigint").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    marked = marked.filter("label IN (0, 1) AND doc_id IS NOT NULL").distinct()
    order = F.struct(F.xxhash64("doc_id").alias("order"), F.col("doc_id"))
    picked = [r for label in (0, 1) for r in marked.filter(F.col("label") == label).orderBy(order).limit(sample).collect()]
    small = docs.sparkSession.createDataFrame(picked, "doc_id bigint, label int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [features(t) for t in texts_of(batch, "text")]
            columns = [pa.array([x[0].astype(np.int32) for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "label", "index", "weight"])

    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(small), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    table = texts.mapInArrow(run, "doc_id bigint, label int, index array<int>, weight array<float>").toArrow()
    found = [r for r in sorted(table.to_pylist(), key=lambda r: (r["doc_id"], r["label"])) if r["index"]]
    outcome = np.array([r["label"] for r in found], np.float64)
    prior = float(outcome.mean()) if len(found) else 0.5
    if not len(found):
        return Model(np.zeros((BINS + SHAPES, 1), np.float32), np.zeros((0, 1), np.float32), outcome, prior)
    rows = np.zeros((len(found), BINS + SHAPES), np.float32)
    for i, r in enumerate(found):
        rows[i, r["index"]] = r["weight"]
    model = Model(decompose(rows, rank), np.zeros((0, 1), np.float32), outcome, prior)
    model.vectors = model.latent([(np.array(r["index"]), np.array(r["weight"], np.float32)) for r in found])
    return model


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row, whatever its id; other columns are left out.

    ``score`` says how likely label 1 is, from 0 to 1. Null and empty texts and those of fewer than
    three bytes have no vector and get the model's share of label 1, as do all texts if nothing was
    learned (then 0.5). ``predicted`` is 1 from ``threshold`` on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            scores = shared.value.scores(texts_of(batch, "text"))
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), predicted], ["doc_id", "score", "predicted"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts 1 for, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, text_col, lambda texts: shared.value.scores(texts) >= threshold)


def in_fold(doc_id, folds: int = 5, held: int = 0):
    """Whether a document is held out: crc32 of its id as text, modulo ``folds``."""
    return crc_of_id(doc_id) % folds == held
