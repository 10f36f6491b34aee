"""The latest row per id, stored in hash buckets, so that a late extract touches its own buckets only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold
from ..operators.dedupe import latest_per_key
from ..session import discard, folder_exists, materialize, replace_partitions

BUCKET = "bucket"


class LatestRows:
    """Rows of one table by ``key``, at most one each: the first in ``order``, ties cut by all other columns.

    ``merge`` takes any further extract: repeated, late or new ids. It reads the
    stored buckets its ids fall into, keeps the better row of each id and replaces
    these buckets. Merging the same extract again changes nothing, so a load that
    broke is simply repeated. The number of buckets belongs to the folder: choose
    it so that a bucket is some tasks' work, and well above the buckets a usual
    late extract touches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, order: Sequence[Column], buckets: int):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, list(order), buckets
        self.columns = schema.names
        self.schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(fold(F.col(self.key))), F.lit(self.buckets)).cast("int")

    def rows(self) -> DataFrame:
        """All latest rows."""
        return self._stored().select(*self.columns)

    def _stored(self) -> DataFrame:
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def stored_beside(self, buckets: Sequence[int]) -> DataFrame:
        """The stored rows of some buckets; the other buckets' files are not opened."""
        return self._stored().where(F.col(BUCKET).isin(list(buckets)))

    def merge(self, extract: DataFrame) -> list[int]:
        """Take an extract in; returns the buckets it touched, which are at most ``buckets`` numbers."""
        incoming = materialize(extract.select(*self.columns).withColumn(BUCKET, self._bucket()), "extract")
        touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())
        if not touched:
            discard(incoming)
            return []
        others = [F.col(c) for c in self.columns if c != self.key]
        best = latest_per_key(
            self.stored_beside(touched).unionByName(incoming), [F.col(BUCKET), fold(F.col(self.key))], self.order, [*others, F.col(self.key)]
        )
        # the stored rows of these buckets are among what replaces them
        best = materialize(best, "latest")
        replace_partitions(best, self.path, BUCKET, touched)
        discard(incoming, best)
        return touched
