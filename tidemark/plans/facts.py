"""The three facts and the monthly roll-ups they rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fold, hours_between, month_end, month_key, round_ratio
from ..operators.aggregates import sum_if
from ..operators.keys import lookup_key, with_surrogate_key
from ..operators.windows import delta_prev, running_count
from ..schemas import LOW_ENGAGEMENT_DAYS, UNKNOWN_REASON_KEY
from ..sources.keystore import KeyRegistry
from .dims import as_typed


def build_fact_subscriptions(bridge: DataFrame) -> DataFrame:
    """Subscriptions of known accounts; a NULL end month means still active."""
    return as_typed(
        bridge.where("account_key IS NOT NULL").select(
            "subscription_key",
            "account_key",
            month_key(F.col("start_date")).alias("start_date_key"),
            month_key(F.col("end_date")).alias("end_date_key"),
            F.col("mrr_amount").alias("mrr"),
            F.col("churn_flag").alias("is_churned"),
            F.col("upgrade_flag").alias("is_upgraded"),
            F.col("downgrade_flag").alias("is_downgraded"),
            "auto_renew_flag",
        ),
        "fact_subscriptions",
    )


def build_fact_churn_events(
    events: DataFrame, dim_account: DataFrame, dim_reason: DataFrame, keys: KeyRegistry | None = None
) -> DataFrame:
    """Events of known accounts; a code the reasons do not list gets the unknown key.

    With ``keys``, known events keep the key of earlier loads.
    """
    reasons = F.broadcast(dim_reason.select("reason_code", "churn_reason_key"))  # six fixed rows
    with_account = lookup_key(events, dim_account, "account_id", "account_key")
    resolved = lookup_key(
        with_account, reasons, "reason_code", "churn_reason_key", how="left", default=UNKNOWN_REASON_KEY
    ).withColumn("churn_date_key", month_key(F.col("churn_date")))
    columns = [
        "churn_event_id", "account_key", "churn_date_key", "churn_reason_key", "refund_amount_usd",
        "is_reactivation", "preceding_upgrade_flag", "preceding_downgrade_flag",
    ]
    rows = resolved.select(*columns)
    if keys:
        keyed = keys.keyed(rows, "churn_events", "churn_event_id", "churn_event_key")
    else:
        keyed = with_surrogate_key(rows, "churn_event_key", [F.col("churn_event_id")])
    return as_typed(keyed, "fact_churn_events")


def per_feature(usage: DataFrame) -> DataFrame:
    """Usage per subscription, month and feature, in figures that add up.

    Days of a month are few, so the active ones are collected as bits of an
    integer: a plain partial aggregate.
    """
    day_bit = F.call_function("shiftleft", F.lit(1), F.day("usage_date") - 1)
    return usage.groupBy(
        fold(F.col("subscription_id")).alias("subscription_id"),
        month_key(F.col("usage_date")).alias("date_key"),
        fold(F.col("feature_name")).alias("_feature"),
    ).agg(
        F.bit_or(day_bit).alias("_days"),
        F.sum("usage_count").alias("_uses"),
        F.sum("usage_duration_secs").alias("_seconds"),
        F.count("usage_duration_secs").alias("_timed_rows"),
        F.sum("error_count").alias("_errors"),
        sum_if(F.col("is_beta_feature"), F.lit(1)).alias("_beta_rows"),
    )


def monthly_feature(usage: DataFrame) -> DataFrame:
    """Usage per subscription and month; ``subscription_id`` in comparison form.

    Features are counted by summing up per feature first, then per month; this
    spreads even a subscription that owns much of the table, and is a quarter
    faster than a distinct count beside the sums.
    """
    return (
        per_feature(usage)
        .groupBy("subscription_id", "date_key")
        .agg(
            F.coalesce(F.bit_count(F.bit_or("_days")), F.lit(0)).alias("active_days"),
            F.count("_feature").alias("feature_adoption_count"),
            F.sum("_uses").alias("total_usage_count"),
            F.sum("_seconds").alias("total_usage_duration_secs"),
            F.sum("_timed_rows").alias("_timed_rows"),
            F.sum("_errors").alias("total_error_count"),
            F.sum("_beta_rows").alias("beta_feature_usage_count"),
        )
        .withColumn("avg_usage_duration_secs", round_ratio("total_usage_duration_secs", "_timed_rows", 2))
        .drop("_timed_rows")
    )


def ticket_state(tickets: DataFrame) -> DataFrame:
    """Tickets per account and month of submission, in figures that add up; ``account_id`` in comparison form.

    A ticket counts as unresolved when it is open, or was closed after midnight
    at the start of the month's last day.
    """
    submitted, closed = F.col("submitted_at"), F.col("closed_at")
    unresolved = closed.isNull() | (closed > month_end(submitted).cast("timestamp_ntz"))
    hours = hours_between(submitted, closed)
    return tickets.groupBy(fold(F.col("account_id")).alias("account_id"), month_key(submitted).alias("date_key")).agg(
        F.count(F.lit(1)).alias("opened"),
        F.count_if(unresolved).alias("unresolved"),
        F.sum(hours).alias("hours"),
        F.count(hours).alias("closed"),
        F.sum("satisfaction_score").alias("score"),
        F.count("satisfaction_score").alias("scored"),
    )


def finish_tickets(state: DataFrame) -> DataFrame:
    """The ticket figures of a state; averages are NULL where nothing was counted."""
    return state.select(
        "account_id",
        "date_key",
        F.col("opened").alias("support_tickets_opened"),
        F.col("unresolved").alias("support_tickets_unresolved_eom"),
        round_ratio("hours", "closed", 2).alias("avg_resolution_hours"),
        round_ratio("score", "scored", 2).alias("avg_satisfaction_score"),
    )


def ticket_monthly(tickets: DataFrame) -> DataFrame:
    """Tickets per account and month of submission."""
    return finish_tickets(ticket_state(tickets))


def with_engagement_trend(monthly: DataFrame) -> DataFrame:
    """Change in active days against the previous month with usage, and low months so far."""
    days = F.col("active_days")
    return monthly.withColumns(
        {
            "mom_active_days_delta": delta_prev(days, "subscription_id", "date_key"),
            "consecutive_low_engagement_months": running_count(
                days < LOW_ENGAGEMENT_DAYS, "subscription_id", "date_key"
            ),
        }
    )


def owners(bridge: DataFrame) -> DataFrame:
    """Subscriptions of known accounts, ids in comparison form, with the keys and the flag a usage month carries."""
    return bridge.where("account_key IS NOT NULL").select(
        fold(F.col("subscription_id")).alias("subscription_id"),
        fold(F.col("account_id")).alias("account_id"),
        "subscription_key",
        "account_key",
        F.col("churn_flag").alias("is_churned"),
    )


def owned_months(usage: DataFrame, bridge: DataFrame) -> DataFrame:
    """Usage months of subscriptions of known accounts."""
    return monthly_feature(usage).join(owners(bridge), "subscription_id")


def usage_fact(months: DataFrame, tickets: DataFrame) -> DataFrame:
    """Fact rows from owned months with their trend and from the finished ticket figures."""
    combined = months.join(tickets, ["account_id", "date_key"], "left")
    # no rate without usage
    rate = round_ratio("total_error_count", "total_usage_count", 4)
    return as_typed(combined.withColumn("error_rate", rate), "fact_subscription_usage")


def build_fact_subscription_usage(usage: DataFrame, tickets: DataFrame, bridge: DataFrame) -> DataFrame:
    """Usage months of known subscriptions with the ticket figures of their account.

    Months without tickets keep NULL ticket figures. The join to the bridge and
    both windows need the same partitioning, by subscription id: one shuffle
    serves all three.
    """
    return usage_fact(with_engagement_trend(owned_months(usage, bridge)), ticket_monthly(tickets))


def months_within(months: DataFrame, tickets: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact rows of the owned months that ``calendar`` has.

    Others are left out before the windows, so a month that is refused takes no
    part in its neighbours' trend.
    """
    kept = months.join(calendar.select("date_key"), "date_key", "left_semi")
    return usage_fact(with_engagement_trend(kept), ticket_monthly(tickets))


def months_outside(months: DataFrame, tickets: DataFrame, calendar: DataFrame) -> DataFrame:
    """The owned months that ``calendar`` lacks, as fact rows without a trend."""
    months = months.join(calendar.select("date_key"), "date_key", "left_anti")
    none = {c: F.lit(None).cast("int") for c in ("mom_active_days_delta", "consecutive_low_engagement_months")}
    return usage_fact(months.withColumns(none), ticket_monthly(tickets))
