"""Stored surrogate keys: natural id to key, for every keyed table, across loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold
from ..operators.keys import with_position
from ..session import complete_folders


class KeyRegistry:
    """Keys under ``root``, one folder per table and in it one folder per load that met new ids.

    A key, once given, never changes. New ids get the next free numbers in the
    order of their text, without a gap. A batch counts from the moment it is
    whole; what a broken load left is written over by the next. A repeated run of
    a load finds all its ids known and writes nothing. One load at a time may give
    keys of a table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def known(self, table: str) -> DataFrame:
        """``id`` (in comparison form, NULL for the missing id) and ``key`` of all ids met so far."""
        batches = complete_folders(self.spark, f"{self.root}/{table}/batch=*")
        if not batches:
            return self.spark.createDataFrame([], "id string, key bigint")
        return self.spark.read.schema("id string, key bigint").parquet(*batches)

    def register(self, ids: DataFrame, table: str, natural: str, order: Sequence[Column] = ()) -> DataFrame:
        """``known`` after giving keys to those ids of column ``natural`` that have none."""
        known = self.known(table)
        seen = ids.groupBy(fold(F.col(natural)).alias("id")).agg(F.min(natural).alias("_text"))
        fresh = seen.join(known.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left_anti")
        batches = complete_folders(self.spark, f"{self.root}/{table}/batch=*")
        last = known.agg(F.coalesce(F.max("key"), F.lit(0))).first()[0] if batches else 0
        placed = with_position(fresh, "key", [*order, F.col("_text").asc_nulls_first()])
        new = placed.select("id", (F.col("key") + last).alias("key"))
        if new.isEmpty():
            return known
        new.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={len(batches)}")
        return self.known(table)

    def keyed(self, rows: DataFrame, table: str, natural: str, key: str) -> DataFrame:
        """``rows`` with column ``key`` from the registry, which learns new ids first."""
        keys = self.register(rows.select(natural), table, natural).select(F.col("id").alias("_id"), F.col("key").alias(key))
        return rows.join(keys, fold(F.col(natural)).eqNullSafe(F.col("_id"))).drop("_id")
