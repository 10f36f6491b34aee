"""Monthly usage and ticket roll-ups as states that add up.

A state holds what a month's figures follow from and what adds up without the rows
behind it: active days as bits, the set of features, sums and counts. States of
separate extracts merge to the state of both together, as long as no row is in both;
figures are finished when they are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_ratio
from .facts import per_feature

_USAGE_SUMS = ("uses", "seconds", "timed_rows", "errors", "beta_rows")
_TICKET_SUMS = ("opened", "unresolved", "hours", "closed", "score", "scored")


def usage_state(usage: DataFrame) -> DataFrame:
    """State of each subscription and month of clean usage rows."""
    return (
        per_feature(usage)
        .groupBy("subscription_id", "date_key")
        .agg(
            F.bit_or("_days").alias("days"),
            # one row per feature by now
            F.array_sort(F.collect_list("_feature")).alias("features"),
            *[F.sum(f"_{c}").alias(c) for c in _USAGE_SUMS],
        )
    )


def merge_usage(*parts: DataFrame) -> DataFrame:
    """One state per subscription and month from the states of separate extracts."""
    rows = reduce(DataFrame.unionByName, parts)
    features = F.array_sort(F.array_distinct(F.flatten(F.collect_list("features"))))
    return rows.groupBy("subscription_id", "date_key").agg(
        F.bit_or("days").alias("days"), features.alias("features"), *[F.sum(c).alias(c) for c in _USAGE_SUMS]
    )


def finish_usage(state: DataFrame) -> DataFrame:
    """The figures of ``monthly_feature``."""
    return state.select(
        "subscription_id",
        "date_key",
        active_days().alias("active_days"),
        F.size("features").cast("bigint").alias("feature_adoption_count"),
        F.col("uses").alias("total_usage_count"),
        F.col("seconds").alias("total_usage_duration_secs"),
        F.col("errors").alias("total_error_count"),
        F.col("beta_rows").alias("beta_feature_usage_count"),
        round_ratio("seconds", "timed_rows", 2).alias("avg_usage_duration_secs"),
    )


def active_days():
    return F.coalesce(F.bit_count("days"), F.lit(0))


def merge_tickets(*parts: DataFrame) -> DataFrame:
    """One state per account and month from the ticket states of separate extracts."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("account_id", "date_key").agg(*[F.sum(c).alias(c) for c in _TICKET_SUMS])
