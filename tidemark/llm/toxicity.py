"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is the bag of its own hash and of its character n-grams between boundary
marks; its vector is the mean of their embeddings, so a misspelling that was never
seen shares most of its vector with the word it stands for. Embeddings and softmax
are learned together, first from whole texts, each the mean of its words, then from
the passage of each text (``PASSAGE`` words) that looks most toxic at the start of an
epoch. A text scores as its most toxic passage: a few words in a long text are not
averaged away. Every fifth sampled text is kept from the learning and sets scale and
intercept of the scores.

Text is read as bytes, ``A-Z`` lower-cased; words are runs of letters, digits and
bytes above 127. Marks alone make no word. A run of more than ``PIECE`` bytes is read
as several words, so memory is bounded however long a text is. Null and empty texts
have the score of no evidence. Rows are independent: repeated ids or texts get equal
rows, and other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_text, map_texts, raw
from .hashing import mix, span_hashes

BITS = 18
NGRAMS = (3, 4, 5)
DIM = 8
PASSAGE = 1
PIECE = 1 << 20
# Labelled rows the model is fitted on at most, those of the smallest hashes of their ids, and their bytes of text.
SAMPLE_ROWS = 8192
SAMPLE_BYTES = 64 << 20
# Epochs on whole texts and on passages, texts or passages a step, and the step of each kind with its start of AdaGrad sums.
WHOLE_EPOCHS, PASSAGE_EPOCHS, BATCH = 4, 10, 128
WHOLE_RATE, PASSAGE_RATE = (1.0, 1e-6), (0.3, 1e-2)

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_FOLD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256)
)


def pieces(data: bytes):
    """The folded text in parts of at most ``PIECE`` bytes, cut between words where there is a gap."""
    data, start = data.translate(_FOLD), 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        if end < len(data):
            gap = data.rfind(b" ", start, end)
            end = gap if gap > start else end
        yield b" " + data[start:end] + b" "
        start = end


def _words(padded: bytes) -> tuple[np.ndarray, np.ndarray]:
    inside = np.frombuffer(padded, np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(inside.astype(np.int8)))
    return edges[0::2] + 1, edges[1::2] + 1


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + _U(kind)) >> _U(64 - BITS)).astype(np.int64)


def _gram_buckets(padded: bytes):
    """For each n, the buckets of the n-grams at every place of a padded text."""
    values = mix(np.frombuffer(padded, np.uint8).astype(_U) + _U(1))
    grams = values
    for n in range(2, NGRAMS[-1] + 1):
        grams = grams[:-1] * _STEP + values[n - 1 :]
        if n in NGRAMS:
            yield n, _bucket(grams, n)


def word_means(padded: bytes, evidence: np.ndarray) -> np.ndarray:
    """For each word of a padded text the mean of ``evidence`` over its bag."""
    starts, ends = _words(padded)
    if not len(starts):
        return np.zeros(0)
    total = evidence[_bucket(span_hashes(padded, starts, ends), 0)].astype(np.float64)
    size = np.ones(len(starts))
    for n, buckets in _gram_buckets(padded):
        sums = np.concatenate([[0.0], np.cumsum(evidence[buckets], dtype=np.float64)])
        first = np.minimum(starts - 1, len(buckets))
        last = np.maximum(ends + 2 - n, first)
        total += sums[last] - sums[first]
        size += last - first
    return total / size


def word_bags(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words in a row, and where each word's begin; the last entry is the end."""
    padded = b" " + b" ".join(words) + b" "
    starts, ends = _words(padded)
    where, found = [np.arange(len(starts))], [_bucket(span_hashes(padded, starts, ends), 0)]
    for n, buckets in _gram_buckets(padded):
        size = np.maximum(ends - starts + 3 - n, 0)
        owner = np.repeat(np.arange(len(starts)), size)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        where.append(owner)
        found.append(buckets[starts[owner] - 1 + within])
    where, found = np.concatenate(where), np.concatenate(found)
    order = np.argsort(where, kind="stable")
    return found[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(starts)))])


class Model:
    """Embeddings of buckets and a softmax over clean and toxic, learned together by AdaGrad steps."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.vectors = (rng.random((1 << BITS, DIM), np.float32) - 0.5) / 100
        self.classes = rng.random((2, DIM), np.float32) - 0.5
        self.bias = np.zeros(2)
        self.pace(*WHOLE_RATE)

    def pace(self, rate: float, start: float) -> None:
        self.rate, self.seen = rate, np.full(1 << BITS, start, np.float32)

    def evidence(self) -> np.ndarray:
        """What each bucket adds to the toxic class against the clean one."""
        return self.vectors @ (self.classes[1] - self.classes[0])

    def learn(self, buckets: np.ndarray, shares: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> None:
        """One step on some bags, one after the other: buckets, their weights in each mean, the bags' sizes and labels."""
        hidden = np.add.reduceat(self.vectors[buckets] * shares[:, None], _starts(sizes))
        z = hidden @ self.classes.T + self.bias
        error = np.exp(z - z.max(axis=1, keepdims=True))
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(len(labels)), labels] -= 1
        back = np.repeat((error @ self.classes).astype(np.float32), sizes, axis=0) * shares[:, None]
        order = np.argsort(buckets, kind="stable")
        first = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        at, slope = buckets[order][first], np.add.reduceat(back[order], first)
        self.seen[at] += (slope * slope).sum(axis=1)
        self.vectors[at] -= self.rate * slope / np.sqrt(self.seen[at])[:, None]
        self.classes -= (0.02 / len(labels) * (error.T @ hidden)).astype(np.float32)
        self.bias -= 0.1 / len(labels) * error.sum(axis=0)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``."""
    return np.repeat(starts - _starts(sizes), sizes) + np.arange(sizes.sum())


def passages(means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the passages of a text begin, and their means."""
    cuts = np.arange(0, len(means), PASSAGE)
    return cuts, np.add.reduceat(means, cuts) / np.diff(np.append(cuts, len(means)))


def fit(texts: list[bytes], labels: list[int]) -> np.ndarray:
    """Evidence of every bucket, intercept last, learned from folded texts (words between single spaces)."""
    table: dict[bytes, int] = {}
    docs = [np.array([table.setdefault(w, len(table)) for w in t.split()], np.int32) for t in texts]
    marks = np.array(labels, np.int64)
    known = [n for n, d in enumerate(docs) if len(d)]
    if len(set(marks[known].tolist())) < 2:
        share = (marks.sum() + 0.5) / (len(marks) + 1)
        return np.append(np.zeros(1 << BITS), np.log(share / (1 - share))).astype(np.float32)
    bags, at = word_bags(list(table))
    size = np.diff(at)
    apart = known[::5] if len(set(marks[known[::5]].tolist())) == 2 else known
    taught = sorted(set(known) - set(apart)) or known
    rng, model = np.random.default_rng(2), Model()

    def whole(n):
        words, counts = np.unique(docs[n], return_counts=True)
        found, place = np.unique(bags[_runs(at[words], size[words])], return_inverse=True)
        shares = np.bincount(place, np.repeat(counts / (len(docs[n]) * size[words]), size[words]))
        return found, shares.astype(np.float32)

    bagged = [whole(n) for n in taught]
    for _ in range(WHOLE_EPOCHS):
        for step in np.array_split(rng.permutation(len(taught)), -(-len(taught) // BATCH)):
            found, shares = zip(*(bagged[i] for i in step), strict=True)
            sizes = np.array([len(f) for f in found])
            model.learn(np.concatenate(found), np.concatenate(shares), sizes, marks[[taught[i] for i in step]])

    def worst(among):
        means = np.add.reduceat(model.evidence()[bags], at[:-1]) / size
        read = [(n, *passages(means[docs[n]])) for n in among]
        return [docs[n][(c := cuts[m.argmax()]) : c + PASSAGE] for n, cuts, m in read], np.array([m.max() for _, _, m in read])

    model.pace(*PASSAGE_RATE)
    for epoch in range(PASSAGE_EPOCHS):
        chosen, best = worst(taught)
        if not epoch:  # the intercept of passages: between the classes
            toxic = marks[taught] == 1
            model.bias = np.array([0.0, -np.median(np.concatenate([np.sort(best[~toxic])[-toxic.sum() :], best[toxic]]))])
        for step in np.array_split(rng.permutation(len(taught)), -(-len(taught) // BATCH)):
            words = [chosen[i] for i in step]
            flat = np.concatenate(words)
            weight = 1 / (np.repeat([len(w) for w in words], [len(w) for w in words]) * size[flat])
            sizes = np.array([size[w].sum() for w in words])
            buckets = bags[_runs(at[flat], size[flat])]
            model.learn(buckets, np.repeat(weight, size[flat]).astype(np.float32), sizes, marks[[taught[i] for i in step]])
    slope, intercept = _scale(worst(apart)[1], marks[apart])
    return np.append(model.evidence() * slope, intercept).astype(np.float32)


def _scale(best: np.ndarray, marks: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through the scores of texts that took no part in learning."""
    centre, width = best.mean(), best.std() + 1e-9
    x = np.column_stack([(best - centre) / width, np.ones(len(best))])
    w, pull = np.zeros(2), np.diag([0.1, 0.1])
    for _ in range(50):  # Newton steps, slightly regularised
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + pull, x.T @ (p - marks) + pull @ w)
    slope = max(w[0], 1e-6) / width
    return slope, w[1] - slope * centre


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> np.ndarray:
    """Evidence learned from labelled documents (``doc_id``, ``label`` 0 or 1), intercept last.

    At most ``sample_rows`` labelled documents are used, in the order of a hash of
    their ids, and of these as many as fit into ``sample_bytes`` of text; so the model
    is fitted in one task of bounded size. Rows with a null id or label are left out;
    of several labels of an id the smallest counts, of several texts of an id the
    smallest in byte order. Without labelled documents all evidence is zero.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # bounded by sample_rows
    rows = id_text(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def folded(batches):
        for batch in batches:
            texts = [b" ".join(b" ".join(p.split()) for p in pieces(t)) for t in raw(batch.column(1))]
            arrays = [batch.column(0), pa.array(texts, pa.binary()), batch.column(2).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "words", "label"])

    def learn(batches):
        texts, marks = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            marks += batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([fit(texts, marks).tobytes()], pa.binary())], ["evidence"])

    read = rows.mapInArrow(folded, "doc_id long, words binary, label int")
    so_far = W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    # one task: at most sample_rows rows
    sample = read.withColumn("bytes", F.sum(F.length("words")).over(so_far)).where(F.col("bytes") <= sample_bytes)
    fitted = materialize(sample.select("doc_id", "words", "label").mapInArrow(learn, "evidence binary"), "toxicity").first()
    return np.frombuffer(fitted[0], np.float32) if fitted else np.zeros((1 << BITS) + 1, np.float32)


def score_of(data: bytes, evidence: np.ndarray) -> float:
    """Chance that the most toxic passage of a text is toxic."""
    found = [word_means(p, evidence) for p in pieces(data)]
    words = np.concatenate(found) if found else np.zeros(0)
    best = passages(words)[1].max() if len(words) else min(0.0, float(-evidence[-1]))
    return float(1 / (1 + np.exp(-np.clip(best + evidence[-1], -35, 35))))


def score(docs: DataFrame, evidence: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every whole text."""

    def run(ids, texts):
        return {"doc_id": ids, "score": [score_of(t, evidence) for t in texts]}

    return map_texts(id_text(docs), run, "doc_id long, score double")
