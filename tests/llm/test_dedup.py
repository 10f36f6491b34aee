"""Substring dedup, suffix-array dedup and SimHash against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import rlz, simhash, suffixes
from tidemark.llm.components import components

from .conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NULLS_LAST = (1 << 63) - 1


def rows(df):
    return Counter(map(tuple, df.collect()))


def expected_words(docs, length=50):
    first = {}
    for d, t, *_ in docs:
        w, d = WORD.findall(t or ""), NULLS_LAST if d is None else d
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, t, *_ in docs:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (NULLS_LAST if d is None else d):
                gone |= set(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), sha256(kept.encode()).hexdigest()] += 1
    return out


def test_earlier_passages_are_removed(docs, clashing, no_docs):
    want = expected_words(documents())
    assert sum(n[2] for n in want) > 300
    assert rows(rlz.remove(docs)) == want
    assert rows(rlz.remove(clashing)) == want
    assert rlz.remove(no_docs).count() == 0


def test_long_words_of_equal_prefix_sums_differ(spark):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2**64, whatever the base."""
    one = "a"
    for _ in range(11):
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{n}" for n in range(25))
    data = [(1, f"{rest} {one} {rest}"), (2, f"{rest} {two} {rest}"), (3, f"{rest} {one} {rest}")]
    got = {r["doc_id"]: r["n_removed"] for r in rlz.remove(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 51}


def test_factors_cover_what_is_removed(docs):
    removed = {r["doc_id"]: r["n_removed"] for r in rlz.remove(docs).collect()}
    covered: dict = {}
    for r in rlz.factors(docs).collect():
        assert r["end_word"] - r["first_word"] >= 50 and (r["source"] is None or r["doc_id"] is None or r["source"] < r["doc_id"])
        covered.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["end_word"]))
    assert {d: len(w) for d, w in covered.items()} == {d: n for d, n in removed.items() if n}


def expected_bytes(docs, length=400):
    texts = [(d, (t or "").encode()) for d, t, *_ in docs]
    seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = Counter()
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d, len(b), int(gone.sum()), spans, sha256(kept).hexdigest(), len(kept)] += 1
    return out


@pytest.mark.parametrize("members", [suffixes.MEMBERS, 3, 1])
def test_repeated_bytes_are_removed(docs, no_docs, monkeypatch, members):
    """With few members anchors are split by their sides before they get a tree."""
    monkeypatch.setattr(suffixes, "MEMBERS", members)
    assert rows(suffixes.remove(docs)) == expected_bytes(documents())
    assert suffixes.remove(no_docs).count() == 0


def boilerplate(n, seed=9):
    """Texts around passages of several lengths, so that one anchor has many surroundings."""
    rng = random.Random(seed)
    letters = lambda k: "".join(rng.choices("abcdefghij", k=k))
    passages = [letters(k) for k in (380, 399, 400, 401, 450, 600, 900)]
    texts = []
    for i in range(n):
        text = letters(rng.randrange(400))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            text += passage[rng.choice([0, 0, 5]) :] + letters(rng.choice([0, 3, 300]))
        texts.append(text if i % 17 else text[:100])
    return [(n, t) for n, t in enumerate(texts)] + [(n, "ab" * 500) for n in (7, 900)]


def _whole_characters(b, gone):
    """The text without the characters all of whose bytes are gone."""
    out, at = "", 0
    for c in b.decode():
        size = len(c.encode())
        out += "" if gone[at : at + size].all() else c
        at += size
    return out


def kept_by_scan(data, length):
    """Texts without the bytes of windows that an earlier row or place has."""
    first, out = {}, []
    for n, text in enumerate(data):
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], (n, i))
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (n, i):
                gone[i : i + length] = True
        out.append(None if text is None else _whole_characters(b, gone))
    return out


@pytest.mark.parametrize("members", [suffixes.MEMBERS, 2])
def test_large_anchors_and_first_occurrences(spark, tmp_path, monkeypatch, members):
    monkeypatch.setattr(suffixes, "MEMBERS", members)
    data = boilerplate(90)
    spark.createDataFrame(data, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "many"))
    stored = spark.read.parquet(str(tmp_path / "many"))
    want = expected_bytes(data)
    assert sum(r[2] > 0 for r in want) > 30
    assert rows(suffixes.remove(stored)) == want
    numbered = sorted(stored.withColumn("n", F.monotonically_increasing_id()).collect(), key=lambda r: r["n"])
    for length in (250, 400):
        plain = kept_by_scan([r["text"] for r in numbered], length)
        got = {r["n"]: r["text"] for r in suffixes.strip_texts(stored.withColumn("n", F.monotonically_increasing_id()), length, True).collect()}
        assert [got[r["n"]] for r in numbered] == plain


def test_repeats_of_other_columns(clashing):
    assert rows(suffixes.remove(clashing)) == expected_bytes(documents())


def test_interval_tree_and_maximal_repeats():
    sides = [(b"xa", b"cde"), (b"ya", b"cdf"), (b"ya", b"cdf"), (b"q", b"c")]
    found = {(left, right, tuple(sorted(m.tolist()))) for left, right, m in suffixes.maximal_repeats(sides, 1)}
    assert found == {(2, 3, (1, 2)), (1, 2, (0, 1, 2)), (0, 1, (0, 1, 2, 3))}
    assert suffixes.maximal_repeats(sides, 6) == []


def test_reaches_are_those_of_all_pairs():
    rng = random.Random(11)
    for n in (2, 3, 40, 90):
        pool = ["".join(rng.choices("ab", k=12)) for _ in range(8)]
        sides = [tuple((rng.choice(pool)[rng.randrange(9) :] + rng.choice(pool))[: rng.randrange(20)].encode() for _ in range(2)) for _ in range(n)]
        order = np.array(rng.sample(range(n), n))
        for need, numbers in ((5, None), (5, order), (12, None), (12, order), (0, order)):
            left, right = np.full(n, -1), np.full(n, -1)
            for i in range(n):
                for j in range(n):
                    if i != j and (numbers is None or numbers[j] < numbers[i]):
                        before = next((k for k in range(99) if sides[i][0][::-1][k : k + 1] != sides[j][0][::-1][k : k + 1] or k >= len(sides[i][0])), 0)
                        after = next((k for k in range(99) if sides[i][1][k : k + 1] != sides[j][1][k : k + 1] or k >= len(sides[i][1])), 0)
                        if before + after >= need:
                            left[i], right[i] = max(left[i], before), max(right[i], after)
            got = suffixes.reaches(sides, need, numbers)
            assert got[0].tolist() == left.tolist() and got[1].tolist() == right.tolist()


def test_stripped_texts_stay_valid(spark, docs, no_docs, tmp_path):
    got = suffixes.strip_texts(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got.collect() if r["doc_id"] is not None)
    assert suffixes.strip_texts(no_docs).count() == 0
    wide = spark.createDataFrame([(1, "é" * 300), (2, "é" * 300 + "è")], "doc_id long, text string")
    wide.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    assert {r["text"] for r in suffixes.strip_texts(stored).collect()} == {"", "è"}


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(docs, clashing, no_docs):
    data = documents()
    marks = [fingerprint(t) for _, t, *_ in data]
    group = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (d, *_) in zip(group, data, strict=True):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    want = Counter((d, f"{m:016x}", least.get(g)) for (d, *_), m, g in zip(data, marks, group, strict=True))
    assert rows(simhash.near_duplicates(docs)) == want
    assert rows(simhash.near_duplicates(clashing)) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_covering_masks_miss_no_pair():
    rng = np.random.default_rng(1)
    tables = simhash.masks(4)
    assert len(tables) == 31
    for _ in range(3000):
        bits = rng.choice(64, rng.integers(1, 5), replace=False)
        differ = np.uint64(sum(1 << int(b) for b in bits))
        assert ((differ & tables) == 0).any()


def test_links_connect_what_the_radius_connects(spark):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    marks = {int(c) for c in centre}
    for c in centre:
        for _ in range(60):
            marks.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
    marks = sorted(marks)
    df = spark.createDataFrame([(m - (1 << 64) if m >= 1 << 63 else m,) for m in marks], "fingerprint long")
    got = {tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)))) for r in simhash.links(df).distinct().collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in got)

    def roots(pairs):
        root = {m: m for m in marks}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {m: find(m) for m in marks}

    every = [(a, b) for i, a in enumerate(marks) for b in marks[:i] if (a ^ b).bit_count() <= 4]
    assert roots(got) == roots(every) and len(got) < len(every) * 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 100 + n) for n in range(1, 20)] + [(200, 200), (7, 6), (6, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: 0 for n in range(1, 41)} | {100 + n: 100 for n in range(1, 20)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def one_of_each_by_pairs(docs, radius=4):
    """Ids of the rows that stay: the first of what pairs within the radius connect."""
    order = sorted(docs, key=lambda r: NULLS_LAST if r[0] is None else r[0])
    marks = [fingerprint(t) for _, t, *_ in order]
    group = list(range(len(marks)))
    for i in range(len(marks)):
        for j in range(i):
            if group[i] != group[j] and (marks[i] ^ marks[j]).bit_count() <= radius:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return Counter(order[n][0] for n, g in enumerate(group) if g == n)


def like_texts():
    """Near copies in chains, and short texts of few words."""
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for _ in range(8):
            texts.append(" ".join(words))
            words[rng.randrange(300)] = f"w{rng.randrange(5000)}"
    few = "one two three four five six seven".split()
    texts += [" ".join(rng.sample(few, 7)) for _ in range(20)] + [" ".join(few[:3]), " ".join(few[2::-1]), "One  two three", "", " "]
    rng.shuffle(texts)
    return [(n, t) for n, t in enumerate(texts)]


def test_one_row_of_each_component_stays(spark, docs, clashing, no_docs, tmp_path):
    for rows_ in (docs, clashing):
        got = simhash.one_of_each(rows_)
        assert got.columns == rows_.columns
        assert Counter(r["doc_id"] for r in got.collect()) == one_of_each_by_pairs(documents())
    assert simhash.one_of_each(no_docs).count() == 0
    spark.createDataFrame(like_texts(), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "like"))
    want = one_of_each_by_pairs(like_texts())
    assert len(want) < len(like_texts()) - 15
    assert Counter(r["doc_id"] for r in simhash.one_of_each(spark.read.parquet(str(tmp_path / "like"))).collect()) == want


def test_equal_sides_of_different_anchors_are_no_repeat(spark, tmp_path, monkeypatch):
    """Anchors of many surroundings are split by their sides; what stands in the anchor is part of a window."""
    monkeypatch.setattr(suffixes, "MEMBERS", 1)
    rng = np.random.default_rng(4)
    letters = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    pool = letters(60_000)
    least = np.argsort(suffixes.run_hashes(suffixes.byte_values(pool), suffixes.GRAM))
    first, second = (pool[p : p + suffixes.GRAM] for p in least[:2])  # minimizers of any window around them
    reach = 400 - suffixes.GRAM
    sides = [(letters(reach), letters(reach)) for _ in range(3)]
    texts = [(x + anchor + y).decode() for anchor in (first, second) for x, y in sides]
    texts.append((letters(300) + sides[0][0][-200:] + first + sides[0][1][:100] + letters(300)).decode())
    data = list(enumerate(texts))
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "sides"))
    want = expected_bytes(data)
    assert sorted(n[2] for n in want) == [0] * 5 + [428, 428]
    assert rows(suffixes.remove(spark.read.parquet(str(tmp_path / "sides")))) == want


def test_passages_go_by_their_bytes_not_their_words(spark, tmp_path):
    """Passages of over 50 words stay under 400 bytes, in every text; longer ones go from all, the first included."""
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))
    short, long = words(56), words(58)
    assert (len(short), len(long)) == (391, 405)
    planted = [[short]] * 3 + [[long]] * 3 + [[short, long], []]
    data = [(n, " ".join(x for p in [*passages, ""] for x in (words(40), p) if x)) for n, passages in enumerate(planted)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "planted"))
    want = expected_bytes(data)
    removed = {n[0]: n[2] for n in want}
    assert all((removed[n] >= 405) == (long in passages) and (removed[n] == 0) == (long not in passages) for n, passages in enumerate(planted))
    assert rows(suffixes.remove(spark.read.parquet(str(tmp_path / "planted")))) == want
