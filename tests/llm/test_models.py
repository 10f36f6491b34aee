"""Toxicity, centroid clustering and source divergence against plain versions."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, hashing, orchard, toxicity

# ---- toxicity -----------------------------------------------------------------


def plain_bag(word: bytes) -> list[tuple]:
    padded = b" " + word + b" "
    return [(0, word)] + [(n, padded[i : i + n]) for n in toxicity.NGRAMS for i in range(len(padded) - n + 1)]


def test_bags_are_the_word_and_its_character_ngrams():
    words = [b"a", b"idiot", "réeux".encode(), b"idiots"]
    found, at = toxicity.word_bags(words)
    bags = [found[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(b) for b in bags] == [len(plain_bag(w)) for w in words]
    number = dict(zip((g for w in words for g in plain_bag(w)), (x for b in bags for x in b), strict=True))
    assert [sorted(b) for b in bags] == [sorted(number[g] for g in plain_bag(w)) for w in words]
    assert len(set(bags[1]) & set(bags[3])) >= 9  # a word never seen shares its n-grams


def test_means_of_words_follow_from_their_bags():
    evidence = np.random.default_rng(3).random(1 << toxicity.BITS).astype(np.float32)
    words = [b"x", b"ab", b"abc", b"some", b"longerword"]
    found, at = toxicity.word_bags(words)
    want = [evidence[found[a:b]].mean() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert np.allclose(toxicity.word_means(b" " + b" ".join(words) + b" ", evidence), want, atol=1e-5)
    assert len(toxicity.word_means(b"  ", evidence)) == 0


def test_long_texts_score_in_parts():
    evidence = np.zeros((1 << toxicity.BITS) + 1, np.float32)
    evidence[toxicity.word_bags([b"awful"])[0]] = 9
    clean = b"some words here. " * 100_000
    assert len(list(toxicity.pieces(clean))) > 1
    assert toxicity.score_of(clean, evidence) <= 0.5 < 0.99 < toxicity.score_of(clean + b"AWFUL!", evidence)
    assert toxicity.score_of(b"x" * (3 << 20), evidence) <= 0.5


def toxic_rows(n: int, seed: int):
    rng = random.Random(seed)
    bad = ["stupid", "moron", "worthless"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(["th", "er", "an", "ing", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 150))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_training_finds_toxic_texts_and_their_misspellings(spark):
    rows = toxic_rows(400, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, label int")
    evidence = toxicity.train(docs, labels)
    assert np.array_equal(evidence, toxicity.train(docs.repartition(5), labels))  # the same model from any partitions
    fresh = toxic_rows(200, 2)
    scores = [toxicity.score_of(t.encode(), evidence) for _, t, _ in fresh]
    right = [(s >= 0.5) == bool(y) for s, (_, _, y) in zip(scores, fresh, strict=True)]
    assert np.mean(right) > 0.95
    bent = [t.replace("stupid", "stupiid").replace("moron", "morron").replace("worthless", "worthles") for _, t, y in fresh if y]
    assert np.mean([toxicity.score_of(t.encode(), evidence) >= 0.5 for t in bent]) > 0.7


def test_toxicity_on_odd_rows(spark, docs, no_docs, clashing):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert not toxicity.train(docs, none).any()
    evidence = toxicity.train(docs, spark.createDataFrame([(1, 0), (2, 1), (4, 0), (100, 1), (999, 1)], "doc_id long, label int"))
    for rows in (docs, clashing):
        scores = toxicity.score(rows, evidence).collect()
        assert len(scores) == rows.count() and all(0 <= s["score"] <= 1 for s in scores)
    assert toxicity.score(no_docs, evidence).count() == 0
    assert toxicity.train(no_docs, none).any() == False  # noqa: E712


# ---- centroid clustering --------------------------------------------------------


def plain_clusters(rows, k, rounds, dim):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted((sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in seeds]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n], strict=True)] if members[n] else c for n, c in enumerate(centroids)]
    placed = [(i, nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, (d, n) in placed:
        inertia[n] += d
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, (d, n) in placed), key=str)


def vectors(n: int, dim: int, seed: int, steps: int):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-steps, steps) / 16 for _ in range(dim)]) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[n - 1][1]), (7, None), (8, [1.0]), (9, [float("nan")] * dim), (10, [float("inf")] * dim)]
    return rows + [(11, [None] * dim), (12, rows[2][1]), (13, [0.0] * dim)]


@pytest.mark.parametrize(("n", "dim", "k", "steps"), [(300, 4, 12, 40), (300, 2, 20, 3), (5, 3, 40, 9), (60, 1, 7, 2)])
def test_clusters_equal_plain_rounds(spark, n, dim, k, steps):
    rows = vectors(n, dim, n + dim, steps)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "cluster": F.lit("x")})
    got = orchard.cluster(table.repartition(3), k=k, rounds=5, dim=dim)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_clusters(rows, k, 5, dim)


def test_searches_end_early_and_miss_nothing():
    rng = np.random.default_rng(4)
    heaps = rng.integers(-100, 100, (30, 8)) * 1000
    points = np.repeat(heaps, 20, axis=0) + rng.integers(-50, 50, (600, 8))
    lists, apart = orchard.neighbour_lists(heaps)
    measured = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            out = super().__getitem__(at)
            if isinstance(at, np.ndarray) and out.ndim == 2:
                measured.append(len(out))
            return out

    found, far = orchard.nearest(points.view(Counted), heaps, lists, apart)
    want = ((points[:, None, :] - heaps[None]) ** 2).sum(axis=2)
    assert np.array_equal(found, want.argmin(axis=1)) and np.array_equal(np.asarray(far), want.min(axis=1))
    assert sum(measured) < 0.7 * points.shape[0] * len(heaps)  # bounds spare distances


def test_no_vectors_and_refusals(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert orchard.cluster(empty, 3, 2, 4).count() == 0
    huge = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="a component is beyond"):
        orchard.cluster(huge, 1, 1, 2).count()
    with pytest.raises(ValueError, match="64 components"):
        orchard.cluster(huge, 1, 1, 65)


# ---- source divergence ------------------------------------------------------------


def plain_audit(rows, least=30, top=50):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        others = [s for lg, s in groups if lg == lang]
        all_n = {t: sum(counts[lang, s][t] for s in others) for t in kept}

        def share(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = share(counts[lang, source]), share(all_n)
        pairs = [(-sum(abs(p[t] - share(counts[lang, s])[t]) for t in kept), s.encode()) for s in others if s != source]
        terms = [(q[t] - p[t], t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, n) for n, (value, item) in enumerate(found, 1)]
    return sorted(out)


def corpus(n: int, seed: int):
    rng = random.Random(seed)
    words = ["The", "the", "naïve", "ÀB", "x1y", "don't", "snow", "rain", "sun", "wind", "hail", "fog", "ice"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", None])
        source = rng.choice(["a", "a", "a", "b", "c", "é", None]) if lang else "only"
        rows.append((lang, source, " ".join(rng.choice(words[: 5 + len(source or "") * (i % 7)] or words) for _ in range(rng.randint(0, 40)))))
    return rows + [("de", "a", "zwei Dokumente"), ("de", "b", None), ("de", "c", ""), ("it", "z", "solo"), (None, None, None)] + rows[:5]


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_audit_equals_plain_counts(spark, bits):
    rows = corpus(160, 3)
    table = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"n": F.lit(1), "term": F.lit("x")})
    for least, top in ((30, 50), (5, 3)):
        got = divergence.audit(table.repartition(4), least, top, digest_bits=bits)
        assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, least, top)


def test_audit_in_many_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 8)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HELD", 8)
    monkeypatch.setattr(divergence, "PART", 300)
    rows = corpus(120, 5)
    table = spark.createDataFrame(rows, "lang string, source string, text string")
    got = divergence.audit(table, 6, 4)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 6, 4)


def test_audit_of_odd_tables(spark, no_docs, clashing):
    assert divergence.audit(no_docs).count() == 0
    rows = [tuple(r) for r in clashing.select("lang", "source", "text").collect()]
    assert sorted(tuple(r) for r in divergence.audit(clashing, 3).collect()) == plain_audit(rows, 3)


def test_long_texts_are_counted_whole(spark, monkeypatch):
    text = ("alpha beta " * 40_000 + "z" * 5000 + " end. ") * 3
    rows = [("en", "a", text), ("en", "b", "beta"), ("en", "a", "alpha z"), ("fr", "a", text)]
    assert b"".join(divergence._cut(b"a " * (5 << 20))) == b"a " * (5 << 20)
    monkeypatch.setattr(divergence, "PART", 1000)  # in this process: parts of one text
    parts = [w for w, _, _ in divergence._words(iter([pa.record_batch([[r[c] for r in rows] for c in range(3)], ["lang", "source", "text"])]), (1 << 64) - 1)]
    assert sum(len(w.digest) for w in parts) == 2 * 3 * 80_002 + 3
    table = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    for least in (1, 2, 3):
        assert sorted(tuple(r) for r in divergence.audit(table, least).collect()) == plain_audit(rows, least)


def test_a_block_of_terms_takes_a_bounded_amount_of_memory(monkeypatch):
    monkeypatch.setattr(hashing, "_POWERS", {})
    texts = [" ".join(f"w{n}x{m}" for m in range(1000)).replace("0", "o") for n in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 1200), pa.array(["s"] * 1200), pa.array(texts)], ["lang", "source", "text"])
    tracemalloc.start()
    found = sum(len(words.digest) for words, _, _ in divergence._words([batch], (1 << 64) - 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(len(re.findall("[a-z]+", t)) for t in texts) and peak < 120 << 20


def test_counts_are_handed_on_in_small_batches(monkeypatch):
    monkeypatch.setattr(divergence, "HANDED", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8))], ["n"])
    pieces = list(divergence._handed(batch))
    assert [p.num_rows for p in pieces] == [3, 3, 2] and pa.Table.from_batches(pieces).column(0).to_pylist() == list(range(8))
    assert [p.num_rows for p in divergence._handed(batch.slice(0, 0))] == [0]
