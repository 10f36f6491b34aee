"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[Column],
    order_by: Sequence[Column],
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Keep the first row of each key in ``order_by`` order, ties cut by ``tiebreak``.

    Filtering on row number 1 lets Spark keep one row per key in every input
    partition before the shuffle, so a key that owns a large share of the table
    reaches its task as one row per input partition.
    """
    ranked = W.partitionBy(*keys).orderBy(*order_by, *tiebreak)
    return df.withColumn("_row", F.row_number().over(ranked)).where("_row = 1").drop("_row")
