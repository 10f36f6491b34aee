"""Raw text to typed, canonical rows: one narrow projection per table, plus
deduplication for the two sources that repeat ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null,
    canonicalize,
    fold,
    parse_decimal,
    parse_dmy,
    parse_flag,
    parse_iso_date,
    parse_iso_datetime,
    parse_rounded_uint,
    parse_uint,
)
from ..operators.dedupe import latest_per_key
from ..schemas import BILLING_FREQUENCIES, PLAN_TIERS, PRIORITIES, RAW_COLUMNS, REFERRAL_SOURCES


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(c).alias(c) for c in names]


def _flags(*names: str) -> list[Column]:
    return [parse_flag(F.col(c)).alias(c) for c in names]


def _spelled(c: Column, values: tuple[str, ...]) -> Column:
    """Canonical spelling of a known value; an unknown one is kept for the domain rule to report."""
    return F.coalesce(canonicalize(c, values), blank_to_null(c))


def clean_accounts(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_trimmed("account_id", "account_name", "industry"),
        F.upper(F.trim("country")).alias("country"),
        parse_dmy(F.col("signup_date")).alias("signup_date"),
        _spelled(F.col("referral_source"), REFERRAL_SOURCES).alias("referral_source"),
        canonicalize(F.col("plan_tier"), PLAN_TIERS).alias("plan_tier"),
        parse_uint(F.col("seats"), 1).alias("seats"),
        *_flags("is_trial", "churn_flag"),
    )


def clean_subscriptions(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_trimmed("subscription_id", "account_id"),
        parse_iso_date(F.col("start_date")).alias("start_date"),
        parse_iso_date(F.col("end_date")).alias("end_date"),
        canonicalize(F.col("plan_tier"), PLAN_TIERS).alias("plan_tier"),
        parse_uint(F.col("seats"), 1).alias("seats"),
        parse_decimal(F.col("mrr_amount"), 10, 2, "0").alias("mrr_amount"),
        *_flags("is_trial", "upgrade_flag", "downgrade_flag", "churn_flag"),
        _spelled(F.col("billing_frequency"), BILLING_FREQUENCIES).alias("billing_frequency"),
        *_flags("auto_renew_flag"),
    )


def type_churn_events(raw: DataFrame) -> DataFrame:
    """Typed churn events, repeated ids still in."""
    return raw.select(
        *_trimmed("churn_event_id", "account_id"),
        parse_dmy(F.col("churn_date")).alias("churn_date"),
        blank_to_null(F.col("reason_code")).alias("reason_code"),
        parse_decimal(F.col("refund_amount_usd"), 10, 2, "0").alias("refund_amount_usd"),
        *_flags("preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation"),
        blank_to_null(F.col("feedback_text")).alias("feedback_text"),
    )


def clean_churn_events(raw: DataFrame) -> DataFrame:
    """One row per event id, the one with the latest churn date."""
    columns = RAW_COLUMNS["churn_events"]
    return latest_per_key(
        type_churn_events(raw),
        [fold(F.col("churn_event_id"))],
        [F.col("churn_date").desc_nulls_last()],
        [F.col(c) for c in columns if c not in ("churn_event_id", "churn_date")],
    ).select(*columns)


def type_feature_usage(raw: DataFrame) -> DataFrame:
    """Typed usage rows, repeated ids still in, with the date as it was written."""
    return raw.select(
        *_trimmed("usage_id", "subscription_id"),
        parse_iso_date(F.col("usage_date")).alias("usage_date"),
        *_trimmed("feature_name"),
        *[parse_uint(F.col(c), 0).alias(c) for c in ("usage_count", "usage_duration_secs", "error_count")],
        *_flags("is_beta_feature"),
        F.col("usage_date").alias("usage_date_text"),
    )


def clean_feature_usage(raw: DataFrame) -> DataFrame:
    """One row per usage id, the one whose date text sorts last."""
    columns = RAW_COLUMNS["feature_usage"]
    return latest_per_key(
        type_feature_usage(raw),
        [fold(F.col("usage_id"))],
        [F.col("usage_date_text").desc_nulls_last()],
        [F.col(c) for c in columns if c not in ("usage_id", "usage_date")],
    ).select(*columns)


def clean_support_tickets(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_trimmed("ticket_id", "account_id"),
        parse_iso_date(F.col("submitted_at")).cast("timestamp_ntz").alias("submitted_at"),
        parse_iso_datetime(F.col("closed_at")).alias("closed_at"),
        canonicalize(F.col("priority"), PRIORITIES, default="low").alias("priority"),
        parse_uint(F.col("first_response_time_minutes"), 0).alias("first_response_time_minutes"),
        parse_rounded_uint(F.col("satisfaction_score")).alias("satisfaction_score"),
        *_flags("escalation_flag"),
    )


CLEANERS = {
    "accounts": clean_accounts,
    "subscriptions": clean_subscriptions,
    "churn_events": clean_churn_events,
    "support_tickets": clean_support_tickets,
    "feature_usage": clean_feature_usage,
}
