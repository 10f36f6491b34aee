"""Suffix-array deduplication: repeated byte strings by a common-prefix interval tree.

A text is sampled at anchors: of the ``GRAM``-byte strings in every window of
``length`` bytes the minimizer, which equal windows share at the same place.
Anchored suffixes are compared, sorted by what follows the anchor. Only anchors
that occur more than once matter, and of these only distinct surroundings: an
occurrence whose whole surroundings (all windows around the anchor) repeat is
covered at once.

The remaining surroundings of one anchor form an enhanced suffix array: sorted
suffixes with the common-prefix lengths of neighbours. A stack scan visits its
interval tree from the leaves up. In an interval all suffixes share a prefix;
those whose texts differ on the left, but by no more than the window allows,
make a maximal repeat with all its occurrences.

An anchor with more surroundings than ``MEMBERS`` is split before: a window reaches
``y`` bytes beyond its anchor and the rest of its length before it, so windows whose
``y`` lies in an interval agree in the interval's least reach on either side. Halving
the intervals splits a group by ever longer sides; every two surroundings that share a
window stay together in one of the parts. A part all of whose members agree in every
window of its interval is a repeat as it is, any other small part gets its tree.

Texts are scanned several times and rows are known by their place in the scan:
``docs`` must be a stored table, or columns of one.
"""

from __future__ import annotations

import struct
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import apart, blocks, free_name, id_text, map_texts, packed, unpack
from .hashing import byte_values, covered, minimizers, run_hashes, signed

GRAM = 128
# Surroundings of one anchor that one task takes: some 550 bytes each.
MEMBERS = 8192


def _sides(data: bytes, at: int, length: int) -> tuple[bytes, bytes]:
    """What stands before and after an anchor, as far as a window around it can reach."""
    reach = length - GRAM
    return data[max(0, at - reach) : at], data[at + GRAM : at + GRAM + reach]


def _around(data: bytes, at: int, length: int) -> int:
    """A hash of the surroundings; the place of the anchor in them counts."""
    before, after = _sides(data, at, length)
    return xxhash.xxh3_64_intdigest(before + data[at : at + GRAM] + after, len(before))


def _merged(places: np.ndarray, reach: int) -> bytes:
    """The spans around some places of a text, overlapping ones joined, as packed 32-bit starts and ends."""
    starts, ends = places - reach, places + GRAM + reach
    new = np.append(True, starts[1:] > ends[:-1])
    pairs = np.column_stack([starts[new], ends[np.append(new[1:], True)]])
    return pairs.astype(np.int32).tobytes()


def _occurrences(rows: DataFrame, length: int) -> DataFrame:
    """``row, at, n, more, rest, anchor, around``: the anchors of every text, with 64-bit hashes.

    A text's ``n`` anchors of the same surroundings are one row, with the first
    place; ``more`` then holds all their spans and ``rest`` those but the first. So
    a line that a text repeats a thousand times counts once.
    """
    reach = length - GRAM

    def run(ids, texts):
        out = {c: [] for c in ("row", "at", "n", "more", "rest", "anchor", "around")}
        for row, data in zip(ids, texts, strict=True):
            if len(data) < length:
                continue
            grams = run_hashes(byte_values(data), GRAM)
            places = minimizers(grams, length - GRAM + 1)[0]
            around = np.array([_around(data, p, length) for p in places.tolist()], np.uint64).view(np.int64)
            anchor = signed(grams[places])
            order = np.lexsort((places, around, anchor))
            same = (np.diff(anchor[order]) == 0) & (np.diff(around[order]) == 0)
            first = np.flatnonzero(np.append(True, ~same))
            n = np.diff(first, append=len(order))
            out["row"].append(np.full(len(first), row, np.int64))
            out["at"].append(places[order[first]].astype(np.int32))
            out["n"].append(n.astype(np.int32))
            runs = [places[order[f : f + k]] for f, k in zip(first.tolist(), n.tolist(), strict=True)]
            out["more"] += [_merged(r, reach) if len(r) > 1 else None for r in runs]
            out["rest"] += [_merged(r[1:], reach) if len(r) > 1 else None for r in runs]
            out["anchor"].append(anchor[order[first]])
            out["around"].append(around[order[first]])
        types = {"at": np.int32, "n": np.int32}
        joined = {c: np.concatenate([np.zeros(0, types.get(c, np.int64)), *v]) for c, v in out.items() if c not in ("more", "rest")}
        return joined | {c: out[c] for c in ("more", "rest")}

    return map_texts(rows, run, "row long, at int, n int, more binary, rest binary, anchor long, around long")


def _neighbours(items: list[bytes]) -> np.ndarray:
    """Common-prefix length of each sorted item with the one before it (0 for the first)."""
    out = np.zeros(len(items), np.int64)
    for n in range(1, len(items)):
        a, b = items[n - 1], items[n]
        short = min(len(a), len(b))
        if a[:short] == b[:short]:
            out[n] = short
        else:
            differ = np.frombuffer(a, np.uint8, short) != np.frombuffer(b, np.uint8, short)
            out[n] = int(differ.argmax())
    return out


def intervals(prefixes: np.ndarray) -> list[tuple[int, int, int]]:
    """The interval tree of a sorted array from its common prefixes: ``depth, first, end``, children before parents."""
    found, stack = [], []
    for n, depth in enumerate([*prefixes[1:].tolist(), -1], 1):
        first = n - 1
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            found.append((top, first, n))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return found


def maximal_repeats(sides: list[tuple[bytes, bytes]], need: int) -> list[tuple[int, int, np.ndarray]]:
    """``left, right, members``: groups that agree in ``left`` bytes before and ``right`` bytes after an anchor.

    ``left + right`` is at least ``need``. An interval's members agree on the
    right; sorted by their reversed left sides, runs of them agree on the left. A
    run counts where extending it to the left loses a member (its members' left
    sides differ there, or one ends) and where the interval is the smallest that
    holds it, so that extending it to the right loses one too.
    """
    order = sorted(range(len(sides)), key=lambda i: sides[i][1])
    backwards = sorted(range(len(sides)), key=lambda i: sides[i][0][::-1])
    prefixes = _neighbours([sides[i][1] for i in order])
    left_prefixes = _neighbours([sides[i][0][::-1] for i in backwards])
    rank, right_rank = np.empty(len(sides), np.int64), np.empty(len(sides), np.int64)
    rank[backwards] = right_rank[order] = np.arange(len(sides))
    order, backwards = np.array(order), np.array(backwards)
    out = []
    for depth, first, end in intervals(prefixes):
        members = order[first:end]
        ranks = np.sort(rank[members])
        # least common left side between neighbours of the interval
        common = np.array([left_prefixes[a + 1 : b + 1].min() for a, b in zip(ranks[:-1], ranks[1:], strict=True)])
        for left, a, b in intervals(np.append(0, common)):
            own = backwards[ranks[a:b]]
            places = right_rank[own]
            if left + depth >= need and prefixes[places.min() + 1 : places.max() + 1].min() == depth:
                out.append((left, depth, own))
    return out


class _Least:
    """Least values of runs of an array, all queries at once (a sparse table)."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least of ``values[first..last]``, both ends included, for each pair."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for n in np.unique(level).tolist():
            at = level == n
            out[at] = np.minimum(self.rows[n][first[at]], self.rows[n][last[at] + 1 - (1 << n)])
        return out


def _earlier(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each member the least of ``common`` up to the nearest one before it of a smaller order; -1 without one."""
    at, least = np.arange(len(order)) - 1, np.append(-1, common)
    todo = np.flatnonzero((at >= 0) & (order[at] > order))
    while len(todo):
        passed = at[todo]  # what lies between it and its own nearest is of greater order still
        least[todo] = np.minimum(least[todo], least[passed])
        at[todo] = at[passed]
        todo = todo[at[todo] >= 0]
        todo = todo[order[at[todo]] > order[todo]]
    return np.where(at < 0, -1, least)


def reaches(sides: list[tuple[bytes, bytes]], need: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each member how far repeats of ``need`` bytes beside the anchor reach before and after it; -1 for none.

    A stack scan visits the intervals of members that agree on the right. Within
    one, members sorted by their reversed left sides agree most with a neighbour:
    that is the longest extension to the left that another occurrence has too. With
    ``order`` (distinct numbers) only members of a smaller number count as others.
    """
    rights = np.array(sorted(range(len(sides)), key=lambda i: sides[i][1]))
    backwards = np.array(sorted(range(len(sides)), key=lambda i: sides[i][0][::-1]))
    rank = np.empty(len(sides), np.int64)
    rank[backwards] = np.arange(len(sides))
    common_left = _Least(_neighbours([sides[i][0][::-1] for i in backwards]))
    left, right = np.full(len(sides), -1, np.int64), np.full(len(sides), -1, np.int64)
    for depth, first, end in intervals(_neighbours([sides[i][1] for i in rights])):
        ranks = np.sort(rank[rights[first:end]])
        common = common_left.of(ranks[:-1] + 1, ranks[1:])
        if common.max() + depth < need:
            continue
        own = backwards[ranks]
        if order is None:
            best = np.maximum(np.append(common, -1), np.append(-1, common))
        else:
            best = np.maximum(_earlier(order[own], common), _earlier(order[own][::-1], common[::-1])[::-1])
        hit = (best >= 0) & (best + depth >= need)
        left[own[hit]] = np.maximum(left[own[hit]], best[hit])
        right[own[hit]] = np.maximum(right[own[hit]], depth)
    return left, right


def _group_spans(group: list[tuple], need: int, first_stays: bool) -> list[tuple[int, int, int]]:
    """``row, start, end`` of what repeats of at least the window cover around each anchor of a group.

    Members are ``row, at, n, before, after``. With ``first_stays`` a member needs an
    earlier one; else a member that occurs ``n > 1`` times is covered already.
    """
    order = None
    if first_stays:
        order = np.empty(len(group), np.int64)
        order[sorted(range(len(group)), key=lambda i: group[i][:2])] = np.arange(len(group))
    left, right = reaches([g[3:5] for g in group], need, order)
    # a member's spans all hold the anchor, so their union reaches from the farthest left to the farthest right
    return [
        (g[0], g[1] - int(a), g[1] + GRAM + int(b))
        for g, a, b in zip(group, left, right, strict=True)
        if a >= 0 and (first_stays or g[2] == 1)
    ]


def repeats(rows: DataFrame, length: int = 400, first_stays: bool = False) -> DataFrame:
    """``row, spans``: what repeated strings cover of each text (``doc_id, text``, ids unique).

    A string of ``length`` bytes is repeated if it starts anywhere else, in the
    same text too; with ``first_stays`` only if it starts in a row of a smaller
    number, or earlier in the same text. Texts without a repeated string have no
    row. A span has ``start``, ``end``, which may lie beyond the text, and ``more``,
    packed pairs instead of these.
    """
    reach = length - GRAM
    occurrences = materialize(_occurrences(rows, length), "occurrences")
    groups = (
        occurrences.groupBy("anchor")
        .agg(F.sum("n").alias("total"), F.min("around").alias("least"), F.max("around").alias("most"))
        .where("total > 1")
        .select("anchor", (F.col("least") != F.col("most")).alias("mixed"))
    )
    # repeated anchors, written once: several plans read them
    shared = materialize(occurrences.join(apart(groups, "anchor"), "anchor"), "anchors")
    discard(occurrences)
    # in groups of several surroundings, those that occur twice cover their places at once
    classes = materialize(
        (shared if first_stays else shared.where("mixed"))
        .groupBy("anchor", "around")
        .agg(F.sum("n").alias("n"), F.min(F.struct("row", "at")).alias("place"), F.max("mixed").alias("mixed")),
        "surroundings",
    )
    twice = apart(classes.where("n > 1").select("anchor", "around", "place"), "anchor", "around")
    if first_stays:
        places = shared.join(twice, ["anchor", "around"])
        first = (F.col("row") == F.col("place.row")) & (F.col("at") == F.col("place.at"))
        places = places.where(~first | (F.col("n") > 1)).withColumn("more", F.when(first, F.col("rest")).otherwise(F.col("more")))
    else:
        places = shared.where("not mixed").unionByName(
            shared.where("mixed").join(twice, ["anchor", "around"], "left_semi").select(shared.columns)
        )
    whole = places.select(
        "row", (F.col("at") - reach).alias("start"), (F.col("at") + GRAM + reach).alias("end"), "more"
    )
    mixed = classes.where("mixed")
    sizes = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"))
    known = _surroundings(rows, mixed.join(apart(sizes, "anchor"), "anchor"), length)
    small = known.where(F.col("members") <= MEMBERS).withColumns({"h1": F.col("anchor"), "h2": F.lit(0).cast("long")})
    partial = _in_groups(small, length, first_stays)
    for spans in _in_parts(known.where(F.col("members") > MEMBERS), length, first_stays):
        partial = partial.unionByName(spans)
    spans = whole.unionByName(partial.withColumn("more", F.lit(None).cast("binary")))
    return spans.groupBy("row").agg(F.collect_list(F.struct("start", "end", "more")).alias("spans"))


def _surroundings(rows: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """One occurrence of each class with the bytes around it, written once."""
    wanted = classes.select("place.*", "anchor", "n", "members").groupBy("row").agg(
        F.collect_list(F.struct("at", "anchor", "n", "members")).alias("wanted")
    )
    joined = packed(rows).withColumnRenamed("doc_id", "row").join(wanted, "row")
    schema = "row long, at int, anchor long, n long, members long, before binary, after binary"

    def run(batches):
        for block in blocks(batches, 64):
            out = []
            for row, data, wanted in zip(block.column(0).to_pylist(), unpack(block.column(1)), block.column(2).to_pylist(), strict=True):
                out += [(row, w["at"], w["anchor"], w["n"], w["members"], *_sides(data, w["at"], length)) for w in wanted]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            arrays = [pa.array([r[n] for r in out], t) for n, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "at", "anchor", "n", "members", "before", "after"])

    return materialize(joined.select("row", "packed", "wanted").mapInArrow(run, schema), "sides")


def _in_groups(known: DataFrame, length: int, first_stays: bool) -> DataFrame:
    """Spans found within small groups (of equal ``h1, h2``), each in one task."""
    need = length - GRAM

    def run(batches):
        group, key = [], None
        for block in blocks(batches, 1024):
            out = []
            for *member, h1, h2 in zip(*[c.to_pylist() for c in block.columns], strict=True):
                if (h1, h2) != key:
                    out += _group_spans(group, need, first_stays) if len(group) > 1 else []
                    group, key = [], (h1, h2)
                group.append(member)
            yield _span_batch(out)
        yield _span_batch(_group_spans(group, need, first_stays) if len(group) > 1 else [])

    dealt = known.repartition("h1", "h2").sortWithinPartitions("h1", "h2")
    return dealt.select("row", "at", "n", "before", "after", "h1", "h2").mapInArrow(run, "row long, start int, end int")


def _span_batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate(types)], ["row", "start", "end"])


def _halves(lo: int, hi: int) -> list[tuple[int, int]]:
    middle = (lo + hi) // 2
    return [(lo, middle), (middle + 1, hi)]


def _in_parts(known: DataFrame, length: int, first_stays: bool):
    """Span frames of large anchors, from ever narrower intervals of how far windows reach beyond the anchor.

    A round halves the intervals of what is still large, so there are at most
    as many rounds as the reach has bits.
    """
    reach = length - GRAM
    names = ["row", "at", "n", "anchor", "before", "after", "lo", "hi", "h1", "h2", "full"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()] + [pa.int64()] * 3

    def split(batches):
        for block in blocks(batches, 512):
            out = []
            for row, at, n, anchor, before, after, lo, hi in zip(*[c.to_pylist() for c in block.columns], strict=True):
                for a, b in _halves(lo, hi):
                    if len(after) < a or len(before) < reach - b:
                        continue  # no window of this interval fits into the text
                    head = struct.pack("<qii", anchor, a, b)
                    least = head + before[len(before) - (reach - b) :] + after[:a]
                    most = b"".join((head, struct.pack("<ii", min(len(before), reach - a), min(len(after), b)), before[max(0, len(before) - (reach - a)) :], after[:b]))
                    h = xxhash.xxh3_128_intdigest(least)
                    full = xxhash.xxh3_64_intdigest(most) - (1 << 63)
                    out.append((row, at, n, anchor, before, after, a, b, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63), full))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names)

    schema = (
        "row long, at int, n long, anchor long, before binary, after binary, lo int, hi int, h1 long, h2 long, full long"
    )
    large = known.withColumns({"lo": F.lit(0), "hi": F.lit(reach)})
    while not large.isEmpty():
        parts = materialize(large.select(names[:8]).mapInArrow(split, schema), "parts")
        sizes = parts.groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("members"),
            # equal surroundings as far as any window of the interval reaches
            (F.min("full") == F.max("full")).alias("one"),
            F.min(F.when((F.length("before") >= reach - F.col("lo")) & (F.length("after") >= F.col("hi")), 1).otherwise(0)).alias("fits"),
            F.min(F.struct("row", "at")).alias("place"),
        )
        sizes = sizes.where("members > 1").withColumn("one", F.col("one") & (F.col("fits") == 1)).drop("fits")
        sized = materialize(parts.join(apart(sizes, "h1", "h2"), ["h1", "h2"]), "sized")
        discard(parts)
        later = (F.col("row") != F.col("place.row")) | (F.col("at") != F.col("place.at"))
        covered_now = sized.where("one").where(later if first_stays else F.col("n") == 1)
        yield covered_now.select(
            "row", (F.col("at") - (reach - F.col("lo"))).cast("int").alias("start"), (F.col("at") + GRAM + F.col("hi")).cast("int").alias("end")
        )
        yield _in_groups(sized.where(~F.col("one") & (F.col("members") <= MEMBERS)), length, first_stays)
        large = sized.where(~F.col("one") & (F.col("members") > MEMBERS))


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``row, doc_id, packed, spans`` for every row; see ``repeats``."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("row"))
    texts = id_text(rows, "row")
    ids = rows.select("row", F.col("doc_id").cast("long").alias("doc_id"))
    return (
        packed(texts)
        .withColumnRenamed("doc_id", "row")
        .join(repeats(texts, length), "row", "left")
        .join(ids, "row")
        .select("row", "doc_id", "packed", "spans")
    )


def gone(data: bytes, spans: list[dict] | None) -> np.ndarray:
    """Mask of the bytes that the spans cover."""
    if not spans:
        return np.zeros(len(data), bool)
    pairs = [np.frombuffer(s["more"], np.int32) if s["more"] else np.array([s["start"], s["end"]]) for s in spans]
    edges = np.clip(np.concatenate(pairs).reshape(-1, 2), 0, len(data))
    return covered(edges[:, 0], edges[:, 1], len(data))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept`` for every row, repeated rows included.

    Every byte goes that a string of ``length`` bytes covers which also starts
    anywhere else, overlaps and the same text included; null texts are empty.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept"]

    def run(batches):
        for block in blocks(batches):
            out = []
            for doc, data, spans in zip(block.column(0).to_pylist(), unpack(block.column(1)), block.column(2).to_pylist(), strict=True):
                cut = gone(data, spans)
                kept = np.frombuffer(data, np.uint8)[~cut].tobytes()
                runs = int(np.count_nonzero(np.diff(cut.astype(np.int8), prepend=0) == 1))
                out.append((doc, len(data), len(data) - len(kept), runs, sha256(kept).hexdigest(), len(kept)))
            types = [pa.int64()] * 4 + [pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in enumerate(types)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long"
    return marked(docs, id_col, text_col, length).select("doc_id", "packed", "spans").mapInArrow(run, schema)


def strip_texts(docs: DataFrame, length: int = 400, first_stays: bool = False) -> DataFrame:
    """``docs`` with repeated bytes cut out of ``text``, and ``n_chars`` (if there) set to its new length.

    With ``first_stays`` the first occurrence of a repeated string is kept, by place in
    the scan; otherwise all go. Text stays valid: a character goes only if all its bytes
    do. Null stays null, empty texts stay empty; rows of one id or text count each.
    """
    row, spans_name = free_name(docs, "_row"), free_name(docs, "_cut")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = repeats(id_text(numbered, row), length, first_stays).select(F.col("row").alias(row), F.col("spans").alias(spans_name))
    names = docs.columns
    text = names.index("text")

    def run(batches):
        for block in blocks(batches):
            texts = []
            for data, spans in zip(block.column(text).cast(pa.binary()).to_pylist(), block.column(len(names)).to_pylist(), strict=True):
                if data and spans:
                    cut = gone(data, spans)
                    first = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                    chars = np.logical_and.reduceat(cut, first)
                    whole = np.repeat(chars, np.diff(first, append=len(data)))
                    data = np.frombuffer(data, np.uint8)[~whole].tobytes()
                texts.append(None if data is None else data.decode())
            columns = list(block.columns)[: len(names)]
            columns[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    out = numbered.join(found, row, "left").select(*names, spans_name).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
