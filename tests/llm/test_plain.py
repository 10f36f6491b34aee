"""Fingerprints and the quality model against plain versions of their methods."""

from __future__ import annotations

import math
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import quality, spotsigs

from .conftest import documents, prose


def short(text: str) -> int:
    """The upper half of Spark's xxhash64, whose seed is 42."""
    return xxhash.xxh64_intdigest(text.encode(), 42) >> 32


def plain_signatures(text: str) -> list[int]:
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    found = set()
    for i, anchor in enumerate(words):
        if anchor in spotsigs.ANCHORS:
            content = [w for w in words[i + 1 : i + 1 + spotsigs.SPAN] if w not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(content) == spotsigs.CHAIN:
                found.add(short(" ".join([anchor, *content])))
    return sorted(found or {short("w " + w) for w in words} or {short("t " + text)})


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b)


def test_every_column_of_the_fingerprints(spark, tmp_path):
    import random

    rng = random.Random(8)
    anchors = " ".join(rng.choice([*spotsigs.ANCHORS[:12], "snow", "rain", "cloud", "wind", "Sun"]) for _ in range(900))
    rows = [r for r in documents() if r[0] is not None] + [(200, anchors, "en", "s", 1), (201, anchors[: len(anchors) // 2], "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "d"))
    data = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0], r[1].encode()))
    want = []
    for n, (d, t) in enumerate(data):
        after = data[(n + 1) % len(data)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, other, following = plain_signatures(t), plain_signatures(edited), plain_signatures(after)
        written = ["".join(f"{m:08x}" for m in marks) for marks in (own, other)]
        want.append((d, len(t), sha256(edited.encode()).hexdigest(), *written, jaccard(own, other), jaccard(own, following)))
    got = sorted(map(tuple, spotsigs.fingerprints(spark.read.parquet(str(tmp_path / "d"))).collect()), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in sorted(want, key=str)]
    assert [r[5:] for r in got] == [pytest.approx(r[5:]) for r in sorted(want, key=str)]
    assert any(0 < r[5] < 1 for r in got) and len({r[3] for r in got}) > 20


def plain_ftrl(rows, order):
    """Weights by bucket, one document after the other."""
    z, n = Counter(), Counter()
    last = 1 << quality.BITS

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for d in order:
            text, label = rows[d]
            buckets, values = quality.features(text.encode())
            x = [*zip(buckets.tolist(), map(float, values), strict=True), (last, 1.0)]
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(weight(i) * v for i, v in x)))))
            steps = {i: (weight(i), (p - label) * v) for i, v in x}
            for i, (w, g) in steps.items():
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_the_quality_model_is_that_of_plain_updates(spark):
    import random

    rng = random.Random(12)
    rows = {n: (prose(rng, rng.randint(5, 60)) + ("!!! $$$" * 3 if n % 3 else ""), int(n % 3 == 0)) for n in range(60)}
    docs = spark.createDataFrame([(d, t) for d, (t, _) in rows.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, (_, y) in rows.items()], "doc_id long, label int")
    order = [r["doc_id"] for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    want = plain_ftrl(rows, order)
    got = quality.train(docs, labels)
    assert sorted(np.flatnonzero(got).tolist()) == sorted(i for i, w in want.items() if w)
    assert all(got[i] == pytest.approx(w, rel=1e-4, abs=1e-5) for i, w in want.items())
    # a sample takes the first in that order
    few = quality.train(docs, labels, sample_rows=20)
    assert all(few[i] == pytest.approx(w, rel=1e-4, abs=1e-5) for i, w in plain_ftrl(rows, order[:20]).items())
