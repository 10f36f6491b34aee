"""Global positions, dense surrogate keys, exact tiles and key lookup.

A window without PARTITION BY would send the whole table to one task. Here the
rows are range-partitioned by the full ordering (tiebreak included, so a value
shared by many rows is spread too), sorted inside each partition and numbered
there; a small table of partition sizes turns local numbers into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import fold
from ..session import materialize

# monotonically_increasing_id puts the partition above bit 33, the row below it
_ROW_BITS = 33


def with_position(df: DataFrame, name: str, order_by: Sequence[Column], total: str | None = None) -> DataFrame:
    """Add the 1-based global position in ``order_by`` order, which must be total.

    With ``total`` the row count is added too. The numbered rows are written
    once to shared storage: a second computation of the range partitioning may
    cut at other bounds, which must not mix with the partition sizes.
    """
    numbered = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "position",
    )
    part = F.shiftrightunsigned("_slot", _ROW_BITS)
    local = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    # one row per range partition
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(W.partitionBy()).alias("_total"),
    )
    extra = [F.col("_total").alias(total)] if total else []
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (local + F.col("_offset")).alias(name), *extra)
    )


def with_surrogate_key(df: DataFrame, name: str, order_by: Sequence[Column], start: int = 1) -> DataFrame:
    """Add a dense key ``start`` .. ``start + n - 1`` in ``order_by`` order."""
    numbered = with_position(df, name, order_by)
    return numbered.withColumn(name, F.col(name) + (start - 1)).select(name, *df.columns)


def extend_surrogate_key(known: DataFrame, incoming: DataFrame, name: str, natural: str) -> DataFrame:
    """Known rows with their keys unchanged, plus new natural ids numbered after them.

    ``incoming`` holds one row per natural id and the non-key columns of ``known``.
    """
    fresh = incoming.withColumn("_match", fold(F.col(natural))).join(
        known.select(fold(F.col(natural)).alias("_match")), "_match", "left_anti"
    )
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    numbered = with_position(fresh.drop("_match"), name, [F.col(natural)]).withColumn(name, F.col(name) + last)
    return known.unionByName(numbered.select(*known.columns))


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    key: str,
    how: str = "inner",
    default: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Add ``key`` (and ``carry`` columns) of the dimension row whose ``on`` text equals ours.

    ``how="inner"`` drops unmatched rows, ``how="left"`` gives them ``default``.
    No broadcast is forced: Spark broadcasts a dimension whose measured size is
    under its threshold and otherwise joins by shuffle, where adaptive execution
    splits a hot natural key over several tasks.
    """
    side = dim.select(fold(F.col(on)).alias("_match"), key, *carry)
    joined = df.withColumn("_match", fold(F.col(on))).join(side, "_match", how).drop("_match")
    if default is not None:
        joined = joined.withColumn(key, F.coalesce(key, F.lit(default)))
    return joined


def ntile_scalable(
    df: DataFrame, tiles: int, order_by: Sequence[Column], tiebreak: Sequence[Column], name: str
) -> DataFrame:
    """Exact NTILE over the whole frame without a single-task window.

    With n = tiles * q + r rows the first r tiles hold q + 1 rows, the rest q.
    """
    placed = with_position(df, "_pos", [*order_by, *tiebreak], total="_n")
    q = F.call_function("div", F.col("_n"), F.lit(tiles).cast("bigint"))
    r = F.col("_n") % tiles
    index = F.col("_pos") - 1
    wide = r * (q + 1)
    tile = F.when(index < wide, F.call_function("div", index, q + 1)).otherwise(
        r + F.call_function("div", index - wide, F.greatest(q, F.lit(1).cast("bigint")))
    )
    return placed.withColumn(name, (tile + 1).cast("int")).drop("_pos", "_n")
