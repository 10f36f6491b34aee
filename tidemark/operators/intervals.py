"""Counting intervals that are open at a month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timekeys import key_to_month, month_key


def active_by_month(
    df: DataFrame, keys: Sequence[str], start: str, end: str, horizon: Column, name: str
) -> DataFrame:
    """Intervals open per key and month, for months with at least one.

    ``start`` and ``end`` are ``yyyymm`` keys; a NULL end is open up to
    ``horizon``, the last month reported. An interval without a start, or that
    ends before it, never opens and counts nowhere. Only the changes are aggregated: +1
    in the first month, -1 in the month after the last one. A running sum then
    gives the level, and only the result rows are spelled out month by month,
    so neither a long interval nor a busy key multiplies rows before the
    aggregation.
    """
    opened = F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))
    changes = (
        df.where(opened)
        .select(
            *keys,
            F.explode(
                F.array(
                    F.struct(key_to_month(F.col(start)).alias("month"), F.lit(1).alias("step")),
                    F.struct(F.add_months(key_to_month(F.col(end)), 1).alias("month"), F.lit(-1).alias("step")),
                )
            ).alias("c"),
        )
        .where("c.month IS NOT NULL")
        .groupBy(*keys, F.col("c.month").alias("_month"))
        .agg(F.sum("c.step").alias("_step"))
    )
    per_key = W.partitionBy(*keys).orderBy("_month")
    level = F.sum("_step").over(per_key.rowsBetween(W.unboundedPreceding, W.currentRow))
    until = F.coalesce(F.add_months(F.lead("_month").over(per_key), -1), horizon)
    return (
        changes.select(*keys, "_month", level.alias(name), F.least(until, horizon).alias("_until"))
        .where((F.col(name) > 0) & (F.col("_month") <= F.col("_until")))
        .select(*keys, F.explode(F.expr("sequence(_month, _until, INTERVAL 1 MONTH)")).alias("_m"), name)
        .select(*keys, month_key(F.col("_m")).alias("date_key"), name)
    )
