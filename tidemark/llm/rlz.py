"""Substring deduplication by relative Lempel-Ziv parsing against all documents.

Every document is a reference for those with larger ids. Its words are cut into
blocks at content-defined anchors: the minimizers of ten-word runs, which any
two equal windows of ``length`` words share at the same place. All anchors are
indexed. A document is parsed against the index greedily: where its anchors
occur in an earlier document, its windows are looked up; a factor goes on while
the next window has the same source and ends where it has not. As every window
of a shared block is looked up, those across factor boundaries too, the union
of the factors is exactly what windows of earlier documents cover.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, apart, blocks, id_text, map_texts, packed, unpack
from .hashing import covered, minimizers, run_hashes, signed, word_hashes, word_spans

GRAM = 10  # words of an anchor


def _windows(data: bytes, length: int):
    """Word spans; hashes of the windows; hashes of the anchors; each window's anchor."""
    starts, ends = word_spans(data)
    if len(starts) < length:
        return starts, ends, None, None, None
    words = word_hashes(data, starts, ends)
    grams = run_hashes(words, GRAM)
    places, of = minimizers(grams, length - GRAM + 1)
    return starts, ends, signed(run_hashes(words, length)), signed(grams[places]), of


def _digest(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(data.split()))


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))


def _copies(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, copies``: digests of a document's texts that an earlier document has word for word."""

    def run(ids, texts):
        whole = [(i, _digest(t)) for i, t in zip(ids, texts, strict=True) if len(t.split()) >= length]
        return {"doc_id": [i for i, _ in whole], "digest": [d for _, d in whole]}

    digests = map_texts(docs, run, "doc_id long, digest binary")
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return (
        digests.join(apart(first.where("first < last"), "digest"), "digest")
        .where("doc_id > first")
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("copies"))
    )


def _shared(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, anchors, firsts``: a document's anchors that another one has too, with the smallest id that has them."""

    def run(ids, texts):
        found = []
        for data in texts:
            anchors = _windows(data, length)[3]
            found.append(np.unique(anchors) if anchors is not None else np.zeros(0, np.int64))
        return {"doc_id": np.repeat(np.array(ids, np.int64), [len(a) for a in found]), "anchor": np.concatenate(found)}

    anchors = map_texts(docs, run, "doc_id long, anchor long")
    ends = anchors.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return (
        anchors.join(apart(ends.where("first < last"), "anchor"), "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("anchor", "first")).alias("found"))
        .select("doc_id", F.col("found.anchor").alias("anchors"), F.col("found.first").alias("firsts"))
    )


def _lookups(docs: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """``doc_id, anchor, window, first`` for the distinct windows of shared blocks; whole copies need none."""
    joined = packed(docs).join(_shared(docs, length), "doc_id").join(copies, "doc_id", "left")
    schema = "doc_id long, anchor long, window long, first long"

    def run(batches):
        for block in blocks(batches):
            columns = [block.column(n).to_pylist() for n in range(3)]
            parts = []
            for doc, anchors, firsts, data, copied in zip(*columns, unpack(block.column(3)), block.column(4).to_pylist(), strict=True):
                _, _, windows, places, of = _windows(data, length)
                if windows is None or copied and _digest(data) in copied:
                    continue
                order = np.argsort(anchors)
                known, firsts = np.array(anchors, np.int64)[order], np.array(firsts, np.int64)[order]
                at = np.minimum(np.searchsorted(known, places), len(known) - 1)
                hit = known[at] == places
                chosen = np.flatnonzero(hit[of])
                _, distinct = np.unique(windows[chosen], return_index=True)
                chosen = chosen[distinct]
                place = of[chosen]
                parts.append((np.full(len(chosen), doc, np.int64), places[place], windows[chosen], firsts[at[place]]))
            if parts:
                arrays = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "anchor", "window", "first"])

    return joined.select("doc_id", "anchors", "firsts", "packed", "copies").mapInArrow(run, schema)


def parse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id, packed, windows, sources, copies``: each text with what its parse needs.

    ``windows`` are the hashes of its windows that start in an earlier document
    too and ``sources`` the smallest ids these start in.
    """
    docs = _ids(docs, id_col, text_col)
    copies = _copies(docs, length)
    lookups = _lookups(docs, copies, length)
    # 128 bits decide: the window's and its anchor's hash
    ends = lookups.groupBy("anchor", "window").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    first = apart(ends.where("source < last").drop("last"), "anchor", "window")
    found = (
        lookups.where("first < doc_id")
        .drop("first")
        .join(first, ["anchor", "window"])
        .where("source < doc_id")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("window", "source")).alias("found"))
    )
    return (
        packed(docs)
        .join(found, "doc_id", "left")
        .join(copies, "doc_id", "left")
        .select("doc_id", "packed", F.col("found.window").alias("windows"), F.col("found.source").alias("sources"), "copies")
    )


def _factors(data: bytes, windows, sources, copies, length: int):
    """Words' spans, and first word, end word and source of each factor; the source of a whole copy is not looked up."""
    starts, ends, own, _, _ = _windows(data, length)
    none = np.zeros(0, np.int64)
    if own is None or not windows and not copies:
        return starts, ends, none, none, none
    if copies and _digest(data) in copies:
        return starts, ends, np.zeros(1, np.int64), np.array([len(starts)]), none
    order = np.argsort(windows or none)
    known, sources = np.array(windows or [], np.int64)[order], np.array(sources or [], np.int64)[order]
    at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
    hit = np.flatnonzero(known[at] == own) if len(known) else none
    source = sources[at[hit]] if len(known) else none
    # greedy: a factor goes on while the next window has the same source
    new = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(source, prepend=-1) != 0))
    last = np.append(new[1:], len(hit)) - 1
    return starts, ends, hit[new], hit[last] + length if len(hit) else none, source[new]


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row.

    A word goes if a window of ``length`` words covers it that also starts in a
    document with a smaller id. Rows of one id are one document, which is no
    source for itself; null ids count as the largest and null texts have no words.
    Windows are judged on the input. The kept words are joined by one blank.
    """

    def run(batches):
        for block in blocks(batches):
            out = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": []}
            rest = [block.column(n).to_pylist() for n in (2, 3, 4)]
            for doc, data, *found in zip(block.column(0).to_pylist(), unpack(block.column(1)), *rest, strict=True):
                starts, ends, first, end, _ = _factors(data, *found, length)
                gone = covered(first, end, len(starts))
                words = data.split()
                kept = [words[i] for i in np.flatnonzero(~gone)] if len(first) else words
                row = (None if doc == NULL_ID else doc, len(words), len(words) - len(kept), sha256(b" ".join(kept)).hexdigest())
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                 pa.array(out["kept_sha256"], pa.string())], list(out)
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return parse(docs, id_col, text_col, length).mapInArrow(run, schema)


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id, first_word, end_word, source``: the factors of every document, each at least ``length`` words.

    Neighbouring factors of different sources overlap by up to ``length - 1``
    words. ``source`` is null for a text that is a whole copy.
    """

    def run(batches):
        for block in blocks(batches):
            parts = []
            rest = [block.column(n).to_pylist() for n in (2, 3, 4)]
            for doc, data, *found in zip(block.column(0).to_pylist(), unpack(block.column(1)), *rest, strict=True):
                _, _, first, end, source = _factors(data, *found, length)
                source = source.tolist() if len(source) else [None] * len(first)
                parts += zip([None if doc == NULL_ID else doc] * len(first), first.tolist(), end.tolist(), source, strict=True)
            columns = [[p[n] for p in parts] for n in range(4)]
            names = ["doc_id", "first_word", "end_word", "source"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "doc_id long, first_word long, end_word long, source long"
    return parse(docs, id_col, text_col, length).mapInArrow(run, schema)
