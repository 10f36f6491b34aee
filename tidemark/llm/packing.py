"""Best-two-fit packing of documents into sequences of fixed size.

Pieces of equal length are interchangeable, so bins are planned on the
histogram of lengths, which has at most ``capacity`` rows however many pieces
there are, and the plan is carried out by joins. A planned bin is filled
greedily, longest length first. Then its smallest piece is taken out and two
unpacked pieces take its place if they fit the gap more tightly. A plan entry
is repeated as often as the histogram allows, so the number of entries is
bounded by the number of lengths and not by the number of bins.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_text, map_texts
from .tokens import WordTable

# Pieces of one length are numbered within this many salted groups per partition setting.
_SALT_FACTOR = 4


def fill(counts: np.ndarray, capacity: int) -> Counter:
    """One bin as {length: copies} from ``counts[length]`` unpacked pieces."""
    left = counts.copy()
    bin_: Counter = Counter()
    gap = capacity
    # greedy: the longest piece that still fits, as often as it fits
    while gap:
        fits = np.flatnonzero(left[1 : gap + 1])
        if not len(fits):
            break
        length = int(fits[-1]) + 1
        n = min(gap // length, int(left[length]))
        bin_[length] += n
        left[length] -= n
        gap -= n * length
    # two-fit: the smallest piece against the two unpacked ones that fill its gap best
    smallest = min(bin_)
    wide = gap + smallest
    if gap and sum(bin_.values()) > 1 and wide > 1:
        have = left[: wide + 1] > 0
        have[0] = False
        first = np.flatnonzero(have)
        below = np.maximum.accumulate(np.where(have, np.arange(wide + 1), 0))
        second = below[wide - first]
        # a pair of equal lengths takes two pieces
        single = (second == first) & (left[first] < 2)
        second = np.where(single, below[np.maximum(second - 1, 0)], second)
        total = np.where(second > 0, first + second, 0)
        if len(total) and total.max() > smallest:
            best = int(total.argmax())
            bin_[smallest] -= 1
            if not bin_[smallest]:
                del bin_[smallest]
            bin_[int(first[best])] += 1
            bin_[int(second[best])] += 1
    return bin_


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``length, first, last, copies, sequence, offset``.

    Pieces ``first`` .. ``last`` (by rank within their length) go ``copies`` at a
    time into sequences from ``sequence`` on, the first of each at ``offset``.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    while counts.any():
        bin_ = fill(counts, capacity)
        times = min(int(counts[length]) // n for length, n in bin_.items())
        offset = 0
        for length in sorted(bin_, reverse=True):
            n = bin_[length]
            rows.append((length, int(used[length]), int(used[length]) + times * n - 1, n, sequence, offset))
            used[length] += times * n
            counts[length] -= times * n
            offset += n * length
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = 4096, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length_col`` holds 1 .. ``capacity``.

    Rows need not differ. Null, zero or too long lengths raise. Columns of the
    names ``sequence_id`` and ``offset`` are replaced. ``pieces`` is written once
    to the shared folder, since numbering must see the same rows twice.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    length = F.col(length_col).cast("int")
    sound = F.when((length >= 1) & (length <= capacity), length).otherwise(
        F.raise_error(F.concat(F.lit("piece length outside 1 .. capacity: "), F.coalesce(length.cast("string"), F.lit("null"))))
    )
    salts = _SALT_FACTOR * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the salt is stored, so that both passes see the same groups
    stored = materialize(
        pieces.select(*kept, sound.alias("_len"), F.monotonically_increasing_id().alias("_row")).withColumn(
            "_salt", F.pmod("_row", F.lit(salts)).cast("int")
        ),
        "pieces",
    )
    sizes = materialize(stored.groupBy("_len", "_salt").agg(F.count(F.lit(1)).alias("_n")), "piece_sizes")
    histogram = {r[0]: r[1] for r in sizes.groupBy("_len").agg(F.sum("_n")).collect()}  # at most `capacity` rows
    before = W.partitionBy("_len").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_len", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_len", "_salt").orderBy("_row")
    ranked = (
        stored.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, ["_len", "_salt"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    return _place(spark, ranked, plan(histogram, capacity), kept)


def _place(spark: SparkSession, ranked: DataFrame, rows: list, kept: list[str]) -> DataFrame:
    """Looks each piece's rank up among the plan rows of its length.

    A length's plan rows are one sorted array; its rank is found there by the
    number of rows that begin at or below it. The plan's size depends on the
    number of lengths alone (at most ``capacity``), hence the broadcast.
    """
    by_length: dict[int, list] = {}
    for length, first, _, n, sequence, offset in rows:
        by_length.setdefault(length, []).append((first, n, sequence, offset))
    table = spark.createDataFrame(
        [(k, v) for k, v in by_length.items()],
        "_len int, _plan array<struct<first: long, n: long, sequence: long, offset: long>>",
    )
    slot = F.expr("element_at(filter(_plan, p -> p.first <= _rank), -1)")
    nth = F.col("_rank") - F.col("_slot.first")
    return (
        ranked.join(F.broadcast(table), "_len")
        .withColumn("_slot", slot)
        .select(
            *kept,
            (F.col("_slot.sequence") + F.floor(nth / F.col("_slot.n"))).cast("long").alias("sequence_id"),
            (F.col("_slot.offset") + F.pmod(nth, F.col("_slot.n")) * F.col("_len")).cast("long").alias("offset"),
        )
    )


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and an end id, cut where longer than ``capacity``.

    Null and empty texts hold the end id alone. Rows are kept apart even where
    they repeat.
    """
    from zlib import crc32

    end = end_id.to_bytes(4, "little")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(ids, texts):
        table = WordTable.of(tokenizer_path)
        out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc, data in zip(ids, table.ids(texts), strict=True):
            data += end
            for n, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                for c, v in zip(out, (doc, n, at // 4, len(part) // 4, crc32(part)), strict=True):
                    out[c].append(v)
        return out

    return map_texts(id_text(docs), run, schema)
