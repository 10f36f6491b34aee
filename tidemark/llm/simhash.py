"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints within a radius r are found in 2**(r+1) - 1 tables. Each bit
position is given a non-zero vector of r+1 bits; table v keeps the positions
whose vector has an odd inner product with v. The vectors of at most r
differing positions span less than the whole space, so some v is orthogonal to
all of them and that table's masked fingerprints are equal: no pair within the
radius is missed. Distances are checked exactly before a link is made.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import NULL_ID, apart, free_name, id_text, map_texts
from .components import components

SEED = 42
BITS = 64


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, or of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    width = min(shingle, len(words))
    starts = [0, *(e + 1 for e in ends[:-width])]
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; zero without hashes."""
    votes = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        eight = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(eight, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The majority of the shingles' hashes, a repeated shingle as often as it stands there."""
    return majority(shingle_hashes(text.lower().split(), shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long) of every whole text; null and empty texts have zero."""

    def run(ids, texts):
        marks = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return {"doc_id": ids, "fingerprint": marks.view(np.int64)}

    return map_texts(id_text(docs, id_col), run, "doc_id long, fingerprint long")


def masks(radius: int) -> np.ndarray:
    """The tables' masks, as unsigned 64-bit integers."""
    full = (1 << (radius + 1)) - 1
    vectors = [1 + i % full for i in range(BITS)]
    return np.array(
        [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, full + 1)], np.uint64
    )


def forest(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` that join each connected part of distinct fingerprints, no more than needed.

    Every fingerprint reached is compared with those not reached yet, so a dense
    bucket shrinks quickly and its pairs are never listed.
    """
    left, a, b = marks, [], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found, left = left[near], left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                reached.extend(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (marks[:0], marks[:0])


def links(marks: DataFrame, radius: int = 4) -> DataFrame:
    """``a, b``: enough links within ``radius`` to connect what the radius connects, among distinct fingerprints."""
    table_masks = masks(radius)
    keep = F.element_at(F.array(*[F.lit(int(m)) for m in table_masks.view(np.int64)]), F.col("v") + 1)
    masked = F.col("fingerprint").bitwiseAND(keep)
    dealt = (
        marks.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(len(table_masks) - 1))).alias("v"))
        .repartition("v", masked)
        .sortWithinPartitions("v", masked)
    )

    def buckets(v, x):
        """Links of whole buckets, which stand one after the other."""
        key = x & table_masks[v]
        cut = np.flatnonzero((v[1:] != v[:-1]) | (key[1:] != key[:-1])) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(v))
        two = starts[ends - starts == 2]
        near = two[np.bitwise_count(x[two] ^ x[two + 1]) <= radius]
        parts = [(x[near], x[near + 1])]
        parts += [forest(x[s:e], radius) for s, e in zip(starts, ends, strict=True) if e - s > 2]
        return [np.concatenate(p).view(np.int64) for p in zip(*parts, strict=True)]

    def run(batches):
        rest_v, rest_x = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for batch in batches:
            v = np.concatenate([rest_v, batch.column("v").to_numpy()])
            x = np.concatenate([rest_x, batch.column("fingerprint").to_numpy().view(np.uint64)])
            key = x & table_masks[v]
            last = np.flatnonzero((v != v[-1]) | (key != key[-1])) if len(v) else []
            at = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
            rest_v, rest_x = v[at:], x[at:]
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in buckets(v[:at], x[:at])], ["a", "b"])
        if len(rest_v):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in buckets(rest_v, rest_x)], ["a", "b"])

    return dealt.select("v", "fingerprint").mapInArrow(run, "a long, b long")


def groups(marks: DataFrame, radius: int = 4) -> DataFrame:
    """``marks`` with ``_group``, equal for fingerprints that links within ``radius`` connect.

    ``marks`` is read twice and must be a stored frame. Equal fingerprints are one
    vertex, so a group of copies costs one row however large it is.
    """
    roots = components(links(marks.select("fingerprint").distinct(), radius))
    return (
        marks.join(roots, marks["fingerprint"] == roots["node"], "left")
        .withColumn("_group", F.coalesce("root", "fingerprint"))
        .drop("node", "root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", radius: int = 4, shingle: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits) ``, component_id`` for every row.

    ``component_id`` is the smallest doc_id that links reach, null ids aside; a
    component of null ids alone has none. Documents without words have
    fingerprint zero and link like any other.
    """
    found = groups(materialize(fingerprints(docs, id_col, shingle), "fingerprints"), radius)
    least = found.groupBy("_group").agg(F.min("doc_id").alias("component_id"))
    return found.join(apart(least, "_group"), "_group").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate component: the smallest doc_id, nulls last, then the first row.

    Components are those of ``near_duplicates``: copies share a fingerprint, and
    texts without words form one component. ``docs`` must be a stored table: its
    rows are known by their place in the scan.
    """
    row = free_name(docs, "_row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    marks = materialize(fingerprints(rows, row, shingle).withColumnRenamed("doc_id", "row"), "fingerprints")
    found = groups(marks, radius)
    ids = rows.select(F.col(row).alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("id"))
    first = found.join(ids, "row").groupBy("_group").agg(F.min(F.struct("id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)
