"""Conditional and segment aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import hundredths, round_ratio
from ..functions.text import fold


def sum_if(predicate: Column, value: Column) -> Column:
    """Sum over the rows where ``predicate`` holds, 0 where none does."""
    return F.sum(F.when(predicate, value).otherwise(F.lit(0)))


def avg_if(predicate: Column, value: Column) -> Column:
    """Average over the rows where ``predicate`` holds, NULL values skipped."""
    return F.avg(F.when(predicate, value))


def by_segment(df: DataFrame, free_text: Sequence[str], keys: Sequence[str], sums: Sequence[Column]) -> DataFrame:
    """Group by ``free_text`` without regard to case, and by ``keys`` as they are.

    ``sums`` are aliased sums. The rows are hash-aggregated on the exact texts
    first; only the few resulting lines are merged across spellings, the
    smallest spelling being the label. (A text minimum over the rows themselves
    would force Spark to sort them.)
    """
    lines = df.groupBy(*free_text, *keys).agg(*sums)
    totals = [f for f in lines.schema.fields if f.name not in {*free_text, *keys}]
    merged = lines.groupBy(*[fold(F.col(c)).alias(f"_{c}") for c in free_text], *keys).agg(
        *[F.min(c).alias(c) for c in free_text],
        *[F.expr(f"cast(sum({f.name}) AS {f.dataType.simpleString()}) AS {f.name}") for f in totals],
    )
    return merged.select(*free_text, *keys, *[f.name for f in totals])


def measure_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Per key, the sum in hundredths and the non-NULL count of each measure.

    Averages over any coarser grouping follow from these, so the rows can be
    reduced before they meet a dimension. ``carry`` columns are constant per key.
    """
    totals = [f for m in measures for f in (F.sum(hundredths(m)).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carry], *totals)


def profile_delta(
    totals: DataFrame,
    free_text: Sequence[str],
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, str, str]],
    flag: str,
) -> DataFrame:
    """Average of each measure where ``flag`` is 1, where it is 0, and the difference.

    ``totals`` comes from ``measure_totals``; ``measures`` maps a measure to its
    three output names. Averages and differences are rounded to two decimals,
    the difference from the unrounded averages.
    """
    parts = [
        F.expr(f"sum(if({flag} = {side}, {m}_{what}, 0)) AS _{m}_{what}_{side}")
        for m in measures
        for what in ("sum", "n")
        for side in (1, 0)
    ]
    grouped = by_segment(totals, free_text, keys, parts)
    out = []
    for m, (name_on, name_off, name_delta) in measures.items():
        s1, s0 = (f"cast(_{m}_sum_{side} AS decimal(20,0))" for side in (1, 0))
        n1, n0 = (f"cast(_{m}_n_{side} AS decimal(14,0))" for side in (1, 0))
        out += [
            round_ratio(s1, f"{n1} * 100", 2).alias(name_on),
            round_ratio(s0, f"{n0} * 100", 2).alias(name_off),
            round_ratio(f"({s1} * {n0} - {s0} * {n1})", f"{n1} * {n0} * 100", 2).alias(name_delta),
        ]
    return grouped.select(*free_text, *keys, *out)
