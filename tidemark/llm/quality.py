"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

Features are one- and two-word runs of the words themselves and of their shapes
(letter case, marks at the end, whether a word repeats the one before), hashed
into ``2**BITS`` buckets, as counts scaled to unit length. Shapes carry what
invented or unseen words cannot. Only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import blocks, id_text, map_texts
from .hashing import mix, run_hashes, span_hashes, word_spans

BITS = 18
# Labelled rows the model is fitted on at most: those of the smallest hashes of their ids.
SAMPLE_ROWS = 8192
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.002, 0.01

_U = np.uint64
_CLASS = np.zeros(256, np.uint8)  # 0 other ASCII
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[128:] = 4


def _shapes(data: bytes, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number for each word: classes of its first two bytes, its last two bytes unless letters, length, repetition."""
    octets = np.frombuffer(data, np.uint8)
    kinds = _CLASS[octets]
    second = np.minimum(starts + 1, ends - 1)
    before = np.maximum(ends - 2, starts)

    def mark(at):
        return np.where((kinds[at] == 0) | (kinds[at] == 3), octets[at], kinds[at]).astype(_U)

    same = np.concatenate([[False], words[1:] == words[:-1]])
    length = np.digitize(ends - starts, (2, 4, 9, 17)).astype(_U)
    shape = kinds[starts].astype(_U) | kinds[second].astype(_U) << _U(3) | mark(ends - 1) << _U(8) | mark(before) << _U(16)
    return mix((shape | length << _U(24) | same.astype(_U) << _U(28)) + _U(1))


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, ascending, and their values; none for a text without words."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    words = span_hashes(data, starts, ends)
    shapes = _shapes(data, starts, ends, words)
    runs = [run_hashes(v, n) + _U(k) for k, (v, n) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2)))]
    buckets, counts = np.unique((mix(np.concatenate(runs)) >> _U(64 - BITS)).astype(np.int32), return_counts=True)
    return buckets, (counts / np.sqrt((counts.astype(np.float64) ** 2).sum())).astype(np.float32)


class Ftrl:
    """Per-coordinate FTRL-proximal updates; the last coordinate is the intercept."""

    def __init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(buckets, 1 << BITS), np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights from labelled documents (``doc_id``, ``label`` 0 or 1), intercept last.

    At most ``sample_rows`` labelled documents are used, in the order of a hash
    of their ids; so the model is fitted in one task of bounded size. Rows with a
    null id or label are left out, and of several labels of an id the smallest
    counts. Without labelled documents all weights are zero.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # bounded by sample_rows
    rows = id_text(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def vectors(batches):
        for block in blocks(batches):
            found = [features(t) for t in block.column(1).cast(pa.binary()).to_pylist()]
            arrays = [block.column(0), block.column(2).cast(pa.int32())]
            arrays += [pa.array([f[n].tobytes() for f in found], pa.binary()) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "label", "buckets", "values"])

    def fit(batches):
        seen = [r for b in batches for r in zip(*(b.column(n).to_pylist() for n in (1, 2, 3)), strict=True)]
        model = Ftrl()
        for _ in range(EPOCHS):
            for label, buckets, values in seen:
                model.learn(np.frombuffer(buckets, np.int32), np.frombuffer(values, np.float32), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], ["weights"])

    sparse = rows.select("doc_id", "text", "label").mapInArrow(
        vectors, "doc_id long, label int, buckets binary, values binary"
    )
    one = sparse.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    fitted = materialize(one.mapInArrow(fit, "weights binary"), "weights").first()
    return np.frombuffer(fitted[0], np.float32) if fitted else np.zeros((1 << BITS) + 1, np.float32)


def score_of(data: bytes, weights: np.ndarray) -> float:
    buckets, values = features(data)
    return float(1 / (1 + np.exp(-np.clip(weights[buckets] @ values + weights[-1], -35, 35))))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, score`` of every whole text; null and empty texts have the intercept's score."""

    def run(ids, texts):
        return {"doc_id": ids, "score": [score_of(t, weights) for t in texts]}

    return map_texts(id_text(docs, id_col), run, "doc_id long, score double")


def keep(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns as they are."""
    text = docs.columns.index("text")

    def run(batches):
        for block in blocks(batches):
            texts = block.column(text).cast(pa.binary()).to_pylist()
            yield block.filter(pa.array([score_of(t or b"", weights) >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
