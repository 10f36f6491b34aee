"""Source divergence audit: how the sources of a language differ in their use of common terms.

Late string materialization: a term is known by a 64-bit digest, and shuffles of counts
move digests. A first scan counts each digest's documents by language. A second one
counts only digests that are common enough, by source, and spells each of them once per
task. The smallest and the largest spelling of a digest are compared. Where they differ,
several terms share it: it is split, and a third scan counts these digests alone by
text. Other text is joined back only for the terms that are reported. Scans learn which
digests count from a bitmap of fixed size: a digest that only shares a bit is counted in
vain and left out by a join.

Sources are compared in blocks of terms and tiles of sources: a block holds at most
some ``CELLS`` counts, so a frequent term or a source with a third of all rows is
never one task's whole work. Terms that no source of a tile uses are added as one
product, not as rows.

Null text, language and source are read as empty. Repeated rows count each. A language
without kept terms has pairs of value 0 and no terms; a language with one source has
terms (none can be above its language) but no pairs. Long texts are read in parts.
Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import apart, raw
from .hashing import span_hashes

HELD = 1 << 20  # counts a task holds before it hands them on
PART = 1 << 20  # bytes of text that are read at once; hashing them takes some hundred bytes of memory for each
HANDED = 1 << 16  # counts in one batch that a task hands on
BITS = 25  # of a digest that choose its place in the bitmap: 4 MB
TILE = 256
CELLS = 1 << 20
BILLION = 1_000_000_000

_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _cut(text: bytes) -> Iterator[bytes]:
    """A folded text in parts of some ``PART`` bytes that cut no term."""
    start = 0
    while len(text) - start > PART:
        gap = text.find(b" ", start + PART)
        if gap < 0:
            break
        yield text[start:gap]
        start = gap
    yield text[start:]


class _Words:
    """Terms of some texts, read together: where they stand, whose they are, and their digests."""

    def __init__(self, owners: list[int], parts: list[bytes], mask: int):
        self.data = b" " + b" ".join(parts) + b" "
        inside = np.frombuffer(self.data, np.uint8) != 0x20
        edges = np.flatnonzero(np.diff(inside.astype(np.int8))) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        offsets = np.cumsum([1, *(len(p) + 1 for p in parts[:-1])])
        self.owner = np.array(owners, np.int64)[np.searchsorted(offsets, self.starts, "right") - 1]
        self.digest = (span_hashes(self.data, self.starts, self.ends) & np.uint64(mask)).view(np.int64)

    def word(self, n: int) -> bytes:
        return self.data[self.starts[n] : self.ends[n]]

    def unlike(self, rows: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Which terms differ in text from the one of their ``model``, compared by eight bytes at a time."""
        octets = np.frombuffer(self.data + b"\0" * 8, np.uint8)
        length, like = self.ends[rows] - self.starts[rows], self.ends[model] - self.starts[model]
        out = length != like
        at, todo = 0, np.flatnonzero(~out)
        eight = np.arange(8)
        while len(todo):
            left, right = (octets[(self.starts[x[todo]] + at)[:, None] + eight] for x in (rows, model))
            inside = (at + eight)[None, :] < length[todo][:, None]
            out[todo] |= ((left != right) & inside).any(axis=1)
            at += 8
            todo = todo[~out[todo] & (length[todo] > at)]
        return out


def _words(batches, mask: int) -> Iterator[tuple[_Words, list[tuple[str, str]], bool]]:
    """Terms of whole texts, a few MB at a time, and the groups of their documents.

    The owners number documents from 0. The flag says that the first of them goes
    on from the block before: a long text comes in several blocks.
    """
    owners, parts, groups, size, goes_on = [], [], [], 0, False
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            few = batch.slice(start, 64)
            for lang, source, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist(), raw(few.column(2)), strict=True):
                groups.append((lang, source))
                for part in _cut(text.translate(_FOLD)):
                    if size and size + len(part) > PART:
                        yield _Words(owners, parts, mask), groups, goes_on
                        goes_on = bool(owners) and owners[-1] == len(groups) - 1
                        owners, parts, groups, size = [], [], [(lang, source)], 0
                    owners.append(len(groups) - 1)
                    parts.append(part)
                    size += len(part)
    if parts:
        yield _Words(owners, parts, mask), groups, goes_on


def _pairs_of(codes: np.ndarray, owners: np.ndarray, n_owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (code, owner) pairs with their counts."""
    both, n = np.unique(codes * n_owners + owners, return_counts=True)
    return both // n_owners, both % n_owners, n


class _Counts:
    """Counts by two keys, gathered from many blocks and handed on when there are many."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def merged(self) -> tuple[np.ndarray, ...]:
        """Rows of equal (first, second) column added up."""
        one, two, *sums = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        first = np.flatnonzero(np.append(True, (np.diff(one) != 0) | (np.diff(two) != 0))) if len(one) else np.zeros(0, np.int64)
        out = (one[first], two[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in sums))
        self.parts, self.rows = [out], len(first)
        return out

    def full(self) -> bool:
        if self.rows > HELD:
            self.merged()
        return self.rows > HELD // 2


def _handed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, so that the executor does not hold it whole beside the task."""
    for start in range(0, max(batch.num_rows, 1), HANDED):
        yield batch.slice(start, HANDED)


def _named(names: list[str], codes: np.ndarray) -> pa.Array:
    return pa.array(names, pa.string()).take(pa.array(codes))


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def document_counts(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """``lang, digest, docs``: documents that hold each digest, added up by task."""
    mask = (1 << digest_bits) - 1

    def run(batches):
        langs: dict[str, int] = {}
        counts, seen = _Counts(), np.zeros(0, np.int64)

        def flush():
            lang, digest, docs = counts.merged() if counts.parts else [np.zeros(0, np.int64)] * 3
            counts.parts, counts.rows = [], 0
            return pa.RecordBatch.from_arrays([_named(list(langs), lang), pa.array(digest), pa.array(docs)], ["lang", "digest", "docs"])

        for words, groups, goes_on in _words(batches, mask):
            found, code = np.unique(words.digest, return_inverse=True)
            lang = np.array([langs.setdefault(g[0], len(langs)) for g in groups], np.int64)
            code, owner, _ = _pairs_of(code, words.owner, len(groups))
            if goes_on:  # the first text's digests of earlier blocks have been counted
                again = (owner == 0) & np.isin(found[code], seen)
                code, owner = code[~again], owner[~again]
            last = found[code[owner == len(groups) - 1]]
            seen = np.union1d(seen, last) if goes_on and len(groups) == 1 else last
            counts.add(lang[owner], found[code], np.ones(len(code), np.int64))
            if counts.full():
                yield from _handed(flush())
        yield from _handed(flush())

    return _read(docs).mapInArrow(run, "lang string, digest long, docs long")


def _bitmap(digests: DataFrame) -> np.ndarray:
    """Which values of the digests' last bits occur: a bitmap of fixed size, made by the executors 64 bits a row."""
    place = F.col("digest").bitwiseAND((1 << BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
    rows = digests.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return words


def _known(bitmap: np.ndarray, digest: np.ndarray) -> np.ndarray:
    place = digest & ((1 << BITS) - 1)
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


def source_counts(docs: DataFrame, bitmap: np.ndarray, digest_bits: int = 64) -> DataFrame:
    """``lang, source, digest, n, term``: occurrences of the bitmap's digests, added up by task, and their spellings.

    A row has either a count or a ``term``. Every spelling of a digest that a task
    meets comes at least once.
    """
    mask = (1 << digest_bits) - 1
    names = ["lang", "source", "digest", "n", "term"]

    def run(batches):
        known_groups: dict[tuple[str, str], int] = {}
        counts, spelled = _Counts(), {}

        def flush():
            group, digest, n = counts.merged() if counts.parts else [np.zeros(0, np.int64)] * 3
            counts.parts, counts.rows = [], 0
            texts = [_named([g[c] for g in known_groups], group) for c in (0, 1)]
            return pa.RecordBatch.from_arrays([*texts, pa.array(digest), pa.array(n), pa.nulls(len(n), pa.string())], names)

        def spell(digests, terms):
            none = [pa.nulls(len(terms), t) for t in (pa.string(), pa.string(), pa.int64())]
            text = pa.array(terms, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([*none[:2], pa.array(digests, pa.int64()), none[2], text], names)

        for words, groups, _ in _words(batches, mask):
            rows = np.flatnonzero(_known(bitmap, words.digest))
            found, first, code = np.unique(words.digest[rows], return_index=True, return_inverse=True)
            group = np.array([known_groups.setdefault(g, len(known_groups)) for g in groups], np.int64)
            code_, owner, n = _pairs_of(code, group[words.owner[rows]], len(known_groups))
            counts.add(owner, found[code_], n)
            other = rows[words.unlike(rows, rows[first][code])] if len(rows) else rows
            new = [(d, w) for d, r in zip(found.tolist(), rows[first].tolist(), strict=True) if spelled.get(d) != (w := words.word(r))]
            new += {(int(words.digest[r]), words.word(r)) for r in other.tolist()}
            if new:
                yield from _handed(spell(*map(list, zip(*new, strict=True))))
                spelled.update(new)
                if len(spelled) > HELD:
                    spelled.clear()
            if counts.full():
                yield from _handed(flush())
        yield from _handed(flush())

    return _read(docs).mapInArrow(run, "lang string, source string, digest long, n long, term string")


def text_counts(docs: DataFrame, bitmap: np.ndarray, digest_bits: int = 64) -> DataFrame:
    """``lang, source, digest, split, n, docs`` by text, for the bitmap's digests: those several terms share."""
    mask = (1 << digest_bits) - 1
    names = ["lang", "source", "digest", "split", "n", "docs"]

    def run(batches):
        n, docs, seen = Counter(), Counter(), set()

        def flush():
            keys = list(n)
            arrays = [pa.array([k[c] for k in keys], t) for c, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.binary()))]
            arrays[3] = arrays[3].cast(pa.string())
            arrays += [pa.array([x[k] for k in keys], pa.int64()) for x in (n, docs)]
            n.clear()
            docs.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for words, groups, goes_on in _words(batches, mask):
            if not goes_on:
                seen = set()
            owner = 0
            for r in np.flatnonzero(_known(bitmap, words.digest)).tolist():
                if words.owner[r] != owner:
                    owner, seen = words.owner[r], set()
                key = (*groups[owner], int(words.digest[r]), words.word(r))
                n[key] += 1
                docs[key] += key not in seen
                seen.add(key)
            if owner != len(groups) - 1:
                seen = set()
            if len(n) > HELD // 8:
                yield from _handed(flush())
        yield from _handed(flush())

    return _read(docs).mapInArrow(run, "lang string, source string, digest long, split string, n long, docs long")


def kept_counts(docs: DataFrame, least_docs: int = 30, digest_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Occurrences of each language's kept terms, and the terms' text.

    The first table has ``lang, source, digest, split, n``: ``split`` is empty, or the
    term itself where its digest stands for several. The second has ``digest, split,
    term``, one row per term. Both rest on stored tables.
    """
    common = document_counts(docs, digest_bits).groupBy("lang", "digest").agg(F.sum("docs").alias("docs"))
    kept = materialize(common.where(F.col("docs") >= least_docs).select("lang", "digest"), "kept_digests")
    rows = materialize(source_counts(docs, _bitmap(kept), digest_bits), "source_counts")
    counts = rows.where("term IS NULL").groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"))
    counts = counts.join(apart(kept, "lang", "digest"), ["lang", "digest"], "left_semi").withColumn("split", F.lit(""))
    counts = counts.select("lang", "source", "digest", "split", "n")
    spelled = rows.where("term IS NOT NULL").groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    spelled = spelled.join(kept.select("digest").distinct(), "digest", "left_semi")
    texts = materialize(spelled, "term_texts")
    alone = texts.where("least = most").select("digest", F.lit("").alias("split"), F.col("least").alias("term"))
    mixed = texts.where("least <> most").select("digest")
    if mixed.isEmpty():
        return counts, alone
    again = text_counts(docs, _bitmap(mixed), digest_bits).join(mixed, "digest", "left_semi")
    again = again.groupBy("lang", "source", "digest", "split").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    again = materialize(again, "split_counts")
    enough = again.groupBy("lang", "digest", "split").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    again = again.drop("docs").join(enough, ["lang", "digest", "split"], "left_semi").select(*counts.columns)
    named = again.select("digest", "split").distinct().withColumn("term", F.col("split"))
    return counts.join(mixed, "digest", "left_anti").select(*counts.columns).unionByName(again), alone.unionByName(named)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10**9 * (count + 5) / (total + 5 * terms))``, exact for any sizes; 0 without terms."""
    top = (count + 5).cast("decimal(20,0)") * BILLION
    whole = F.call_function("div", top, F.nullif((total + 5 * terms).cast("decimal(20,0)"), F.lit(0)))
    return F.coalesce(whole + 1, F.lit(0)).cast("long")


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences of all source pairs of two tiles, over one block of terms."""
    sources = pdf[pdf["digest"].isna()].drop_duplicates("gid")
    used = pdf[pdf["digest"].notna()]
    base, gid = sources["p"].to_numpy(np.int64), sources["gid"].to_numpy(np.int64)
    order = np.argsort(gid)
    base, gid, tile = base[order], gid[order], sources["tile"].to_numpy()[order]
    terms = int(sources["block_terms"].iloc[0]) if len(sources) else 0
    key, _ = pd.factorize(pd.MultiIndex.from_frame(used[["digest", "split"]])) if len(used) else (np.zeros(0, int), None)
    present = int(key.max()) + 1 if len(key) else 0
    table = np.repeat(base[:, None], present, axis=1)
    table[np.searchsorted(gid, used["gid"].to_numpy(np.int64)), key] = used["p"].to_numpy(np.int64)
    left, right = int(pdf["ti"].iloc[0]), int(pdf["tj"].iloc[0])
    out = []
    others = np.flatnonzero(tile == right)
    for a in np.flatnonzero(tile == left):
        b = others[others > a] if left == right else others
        value = np.abs(table[b] - table[a]).sum(axis=1) + np.abs(base[b] - base[a]) * (terms - present)
        out.append(pd.DataFrame({"a": gid[a], "b": gid[b], "value": value}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "value": []}, dtype="int64")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, digest_bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: each other source of the language, by the sum of differences of the
    two sources' shares over all kept terms. Part ``term``: the terms a source uses more
    than its language does, by the difference, the first ``top`` of them.
    """
    counted, texts = kept_counts(docs, least_docs, digest_bits)
    entries = materialize(counted, "entries")
    groups = _read(docs).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")
    by_term = entries.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"))
    langs = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    sources = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    none = ("terms", "lang_total", "total")
    groups = (
        groups.join(sources, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .join(sizes, "lang")
        .fillna(0, list(none))
        .withColumn("gid", F.monotonically_increasing_id())
        .withColumn("tiles", F.ceil(F.col("sources") / TILE).cast("int"))
        .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
        .withColumn("cuts", F.ceil(F.col("terms") * F.least("sources", F.lit(TILE)) / CELLS).cast("int"))
        .withColumn("cuts", F.greatest("cuts", F.lit(1)))
        .withColumn("base", _share(F.lit(0), F.col("total"), F.col("terms")))
    )
    groups = materialize(groups, "groups")
    shares = entries.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    return _pairs(shares, groups, by_term).unionByName(_terms(shares, by_term, texts, top))


def _pairs(shares: DataFrame, groups: DataFrame, by_term: DataFrame) -> DataFrame:
    cut = F.pmod(F.xxhash64("digest", "split"), F.col("cuts"))
    columns = ["lang", "block", "ti", "tj", "gid", "tile", "digest", "split", "p", "block_terms"]
    tiles = F.sequence(F.lit(0), F.col("tiles") - 1)

    def dealt(rows):
        met = rows.withColumn("other", F.explode(tiles))
        return met.withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other"))

    cuts = groups.select("lang", "cuts").distinct()
    sizes = by_term.join(cuts, "lang").groupBy("lang", cut.alias("block")).agg(F.count(F.lit(1)).alias("block_terms"))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn("block", F.col("block").cast("long"))
    every = every.join(sizes.withColumn("block", F.col("block").cast("long")), ["lang", "block"], "left").fillna(0, ["block_terms"])
    missing = {"digest": F.lit(None).cast("string"), "split": F.lit(None).cast("string")}
    heads = dealt(every.withColumns(missing | {"p": F.col("base")}))
    used = dealt(shares.withColumns({"block": cut.cast("long"), "block_terms": F.lit(0).cast("long"), "digest": F.col("digest").cast("string")}))
    summed = heads.select(*columns).unionByName(used.select(*columns)).groupBy("lang", "block", "ti", "tj").applyInPandas(
        _pair_sums, "a long, b long, value long"
    )
    both = summed.groupBy("a", "b").agg(F.sum("value").alias("value"))
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("gid", "lang", "source")
    named = both.join(names.withColumnRenamed("gid", "a"), "a").join(
        names.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b"
    )
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(shares: DataFrame, by_term: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    """Ranks by value with all ties first, without any text; then the text of what is left cuts the ties."""
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    above = shares.join(apart(by_term, "lang", "digest", "split"), ["lang", "digest", "split"]).withColumn("value", F.col("p") - q)
    above = above.where("n > 0 AND value > 0").select("lang", "source", "digest", "split", "value")
    per_source = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    tied = above.withColumn("place", F.rank().over(per_source)).where(F.col("place") <= top).drop("place")
    spelled = tied.join(texts, ["digest", "split"])
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    ranked = spelled.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
