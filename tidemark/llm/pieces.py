"""SentencePiece encoding and decoding by a table of distinct marked words.

Pieces of the model cannot cross white-space markers, so every distinct marked
word is segmented once and its ids are put back at each of its places. The
table belongs to a worker and is kept over its batches: a shuffle of every
word's places would move more bytes than the texts have.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame

from .common import id_text, map_texts
from .tokens import PieceTable


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, the end id last; null and empty texts have it alone."""

    def run(ids, texts):
        table = PieceTable.of(model_path)
        return {"doc_id": ids, "ids": [[int(i) for i in joined.split()] for joined, _ in table.texts(texts)]}

    return map_texts(id_text(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` from rows of ``encode``; null ids decode to the empty text."""

    def run(batches):
        import pyarrow as pa

        model = PieceTable.of(model_path).model
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` without building lists of ids."""

    def run(ids, texts):
        table = PieceTable.of(model_path)
        joined, decoded = zip(*table.texts(texts), strict=True)
        return {
            "doc_id": ids,
            "n_tokens": [j.count(b" ") + 1 for j in joined],
            "ids_sha256": [sha256(j).hexdigest() for j in joined],
            "decoded_sha256": [sha256(t).hexdigest() for t in decoded],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(id_text(docs), run, schema)
