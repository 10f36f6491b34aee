"""Window functions over one ordered partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timekeys import month_number


def rank_desc(value: Column) -> Column:
    """Rank of report lines, largest first, NULL last.

    For grouped results (one row per segment); it orders them in one task.
    Row-level ordering goes through ``with_position``.
    """
    return F.rank().over(W.orderBy(value.desc_nulls_last()))


def lead_over_next(value: Column) -> Column:
    """Distance of each report line to the next smaller one."""
    return value - F.lead(value).over(W.orderBy(value.desc_nulls_last()))


def delta_prev(value: Column, partition: str, order: str) -> Column:
    """Change against the previous existing row, NULL on the first."""
    return value - F.lag(value, 1).over(W.partitionBy(partition).orderBy(order))


def running_count(predicate: Column, partition: str, order: str) -> Column:
    """Rows so far, this one included, on which ``predicate`` holds; it never resets."""
    frame = W.partitionBy(partition).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.sum(F.when(predicate, 1).otherwise(0)).over(frame)


def delta_calendar(value: Column, partition: str, month: str) -> Column:
    """Change against the calendar month before, NULL where that month has no row.

    The frame is a range over month numbers, so no missing month has to be spelled out.
    """
    before = W.partitionBy(partition).orderBy(month_number(F.col(month))).rangeBetween(-1, -1)
    return value - F.max(value).over(before)


def with_streak(df: DataFrame, name: str, predicate: Column, partition: str, month: str) -> DataFrame:
    """Add how many months in a row ``predicate`` has held, this one included; 0 where it does not hold.

    A month without a row ends a streak. Two windows of one partitioning: a row
    that fails, or that follows a gap, marks where counting starts anew, and a
    streak is the distance to the last such mark.
    """
    per_row = W.partitionBy(partition).orderBy("_month")
    numbered = df.withColumns({"_month": month_number(F.col(month)), "_holds": F.coalesce(predicate, F.lit(False))})
    gap = F.coalesce(F.col("_month") - F.lag("_month").over(per_row) != 1, F.lit(True))
    start = F.when(~F.col("_holds"), F.col("_month")).when(gap, F.col("_month") - 1)
    so_far = per_row.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = numbered.withColumn("_start", start)
    streak = F.when(F.col("_holds"), F.col("_month") - F.max("_start").over(so_far)).otherwise(0)
    return marked.withColumn(name, streak).drop("_month", "_holds", "_start")
