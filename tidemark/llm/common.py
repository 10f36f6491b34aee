"""Arrow batches of texts, and packed texts for shuffles."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_ROWS = 256
# A missing doc_id orders after every other one.
NULL_ID = (1 << 63) - 1


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if nothing else does."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, whatever else the table holds; null text becomes empty."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that Python objects of one slice exist at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without nulls."""
    return column.cast(pa.binary()).to_pylist()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, an aggregate to be joined on ``keys``, after a shuffle of its own.

    Otherwise aggregate and join share one stage, whose partitions adaptive
    execution must leave whole; so it can split the other side's hot keys.
    """
    return df.repartition(F.xxhash64(*keys))


def map_texts(df: DataFrame, function: Callable[[list, list[bytes]], dict], schema: str) -> DataFrame:
    """``function(ids, texts)`` for each block of ``doc_id, text`` rows; it returns columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for block in blocks(batches):
            out = function(block.column(0).to_pylist(), raw(block.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def packed(df: DataFrame) -> DataFrame:
    """``doc_id, packed``: texts under a fast compression, so that a shuffle of whole texts writes less."""

    def pack(ids, texts):
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        return {"doc_id": ids, "packed": [press.compress(t) for t in texts]}

    return map_texts(df, pack, "doc_id long, packed binary")


def unpack(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x) for x in column.to_pylist()]
