"""Revenue-loss analyses over the star tables, and the metrics derived from them.

Facts are reduced to the grain of a key before they meet a dimension on it, so
a join never moves more rows than there are keys, however busy one key is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import from_hundredths, hundredths, pct, round_ratio, safe_ratio
from ..operators import (
    active_by_month,
    by_segment,
    lead_over_next,
    measure_totals,
    ntile_scalable,
    profile_delta,
    rank_desc,
    sum_if,
)

Star = Mapping[str, DataFrame]

HIGH_VALUE_TILES = 4

# Measures of the behaviour profile and their three output names.
PROFILE = {
    "active_days": ("avg_active_days_churned", "avg_active_days_retained", "active_days_delta"),
    "feature_adoption_count": (
        "avg_feature_count_churned", "avg_feature_count_retained", "avg_feature_count_delta",
    ),
    "consecutive_low_engagement_months": (
        "avg_low_engagement_churned", "avg_low_engagement_retained", "avg_low_engagement_delta",
    ),
    "support_tickets_opened": (
        "avg_support_tickets_churned", "avg_support_tickets_retained", "avg_support_tickets_delta",
    ),
    "avg_satisfaction_score": (
        "avg_satisfaction_churned", "avg_satisfaction_retained", "avg_satisfaction_delta",
    ),
}


def paying(star: Star) -> Star:
    """The star without trials: facts of subscriptions that are none. Every analysis runs on it as on the whole.

    Churn events belong to accounts, so they stay.
    """
    kept = star["dim_subscription"].where("NOT is_trial").select("subscription_key")
    facts = {t: star[t].join(kept, "subscription_key", "left_semi") for t in ("fact_subscriptions", "fact_subscription_usage")}
    return {**{t: star[t] for t in star if t not in facts}, **facts}


def _revenue() -> list[Column]:
    """Churned and total MRR of the fact rows, in hundredths."""
    mrr = hundredths("mrr")
    return [sum_if(F.col("is_churned") == 1, mrr).alias("churned"), F.sum(mrr).alias("total")]


def _sums() -> list[Column]:
    return [F.sum("churned").alias("churned"), F.sum("total").alias("total")]


def _fact(star: Star, churned_only: bool) -> DataFrame:
    fact = star["fact_subscriptions"]
    return fact.where("is_churned = 1") if churned_only else fact


def account_revenue(star: Star, churned_only: bool = False) -> DataFrame:
    """``churned`` and ``total`` MRR per account, in hundredths."""
    return _fact(star, churned_only).groupBy("account_key").agg(*_revenue())


def account_segments(star: Star, keys: list[str], churned_only: bool = False) -> DataFrame:
    """``churned`` and ``total`` MRR by industry and account attributes ``keys``, in hundredths."""
    accounts = star["dim_account"].select("account_key", "industry", *keys)
    return by_segment(account_revenue(star, churned_only).join(accounts, "account_key"), ["industry"], keys, _sums())


def tier_segments(star: Star, churned_only: bool = False) -> DataFrame:
    """``churned`` and ``total`` MRR by industry, country and plan tier, in hundredths."""
    tiers = star["dim_subscription"].select("subscription_key", "plan_tier")
    per_account = (
        _fact(star, churned_only).join(tiers, "subscription_key").groupBy("account_key", "plan_tier").agg(*_revenue())
    )
    accounts = star["dim_account"].select("account_key", "industry", "country")
    return by_segment(per_account.join(accounts, "account_key"), ["industry"], ["country", "plan_tier"], _sums())


def _money(name: str, alias: str) -> Column:
    return from_hundredths(name).alias(alias)


CHURNED, TOTAL = ("churned", "churned_mrr"), ("total", "total_mrr")


def segment_revenue(star: Star) -> DataFrame:
    """Churned and total MRR by segment."""
    return tier_segments(star).select("industry", "country", "plan_tier", _money(*CHURNED), _money(*TOTAL))


def q1_churned_mrr(star: Star) -> DataFrame:
    """Churned MRR by segment, ranked."""
    return (
        tier_segments(star, churned_only=True)
        .select("industry", "country", "plan_tier", _money(*CHURNED))
        .withColumn("revenue_loss_rank", rank_desc(F.col("churned_mrr")))
        .orderBy(F.desc("churned_mrr"))
    )


def q2_churn_rate(star: Star) -> DataFrame:
    """Share of MRR lost by segment, ranked by the unrounded share."""
    return (
        segment_revenue(star)
        .withColumn("churn_rate", pct("churned_mrr", "total_mrr"))
        .withColumn("churn_rate_rank", rank_desc(safe_ratio("churned_mrr", "total_mrr")))
        .orderBy("churn_rate_rank")
    )


def q3_net_impact(star: Star) -> DataFrame:
    """Churned MRR less refunds by industry and country.

    Covers accounts with a churned subscription. Both facts are brought to
    account grain before they meet, so several subscriptions of one account
    cannot repeat its refunds.
    """
    refunds = (
        star["fact_churn_events"].groupBy("account_key").agg(F.sum(hundredths("refund_amount_usd")).alias("_r"))
    )
    per_account = (
        account_revenue(star, churned_only=True)
        .join(refunds, "account_key", "left")
        .join(star["dim_account"].select("account_key", "industry", "country"), "account_key")
    )
    sums = [F.sum("churned").alias("churned"), F.sum(F.coalesce("_r", F.lit(0))).alias("refunds")]
    net = F.col("churned_mrr") - F.col("total_refunds")
    return (
        by_segment(per_account, ["industry"], ["country"], sums)
        .select("industry", "country", _money(*CHURNED), _money("refunds", "total_refunds"))
        .withColumn("net_revenue_impact", F.round(net, 2))
        .withColumn("net_impact_rank", rank_desc(net))
        .orderBy(F.desc("net_revenue_impact"))
    )


def q31_industry(star: Star) -> DataFrame:
    """Churned MRR by industry."""
    return (
        account_segments(star, [], churned_only=True)
        .select("industry", _money(*CHURNED))
        .orderBy(F.desc("churned_mrr"))
    )


def _quartiles(star: Star) -> DataFrame:
    return ntile_scalable(
        account_revenue(star), HIGH_VALUE_TILES, [F.desc("total")], [F.asc("account_key")], "account_quartile"
    )


def account_quartiles(star: Star) -> DataFrame:
    """Accounts with their revenue and quartile by total MRR, 1 the highest; ties by account."""
    return _quartiles(star).select("account_key", _money(*CHURNED), _money(*TOTAL), "account_quartile")


def q4_high_value(star: Star) -> DataFrame:
    """Churn within the top MRR quartile by industry and entry tier, with the quartile's own rate."""
    top = (
        _quartiles(star)
        .where("account_quartile = 1")
        .join(star["dim_account"].select("account_key", "industry", "initial_plan_tier"), "account_key")
    )
    # the benchmark sums over the segment lines
    return (
        by_segment(top, ["industry"], ["initial_plan_tier"], _sums())
        .select("industry", "initial_plan_tier", _money(*CHURNED), _money(*TOTAL))
        .withColumn("segment_churn_rate", pct("churned_mrr", "total_mrr"))
        .withColumn("overall_churn_rate", pct("sum(churned_mrr) OVER ()", "sum(total_mrr) OVER ()"))
        .orderBy(F.desc("segment_churn_rate"))
    )


def q5_profile(star: Star) -> DataFrame:
    """Behaviour of churned against retained subscriptions by industry and plan tier.

    Averages run over subscription months, so each month weighs the same.
    """
    per_subscription = measure_totals(
        star["fact_subscription_usage"], ["subscription_key"], list(PROFILE), carry=["account_key", "is_churned"]
    )
    segmented = per_subscription.join(
        star["dim_subscription"].select("subscription_key", "plan_tier"), "subscription_key"
    ).join(star["dim_account"].select("account_key", "industry"), "account_key")
    return profile_delta(segmented, ["industry"], ["plan_tier"], PROFILE, "is_churned").orderBy(
        F.asc_nulls_first("active_days_delta")
    )


# --- metrics derived from the analyses ---


def rate_vs_median(star: Star) -> DataFrame:
    """Each segment's churn rate as a multiple of the median segment rate."""
    rates = tier_segments(star).select(
        "industry", "country", "plan_tier", pct("churned", "total").alias("churn_rate")
    )
    median = F.percentile("churn_rate", 0.5).over(W.partitionBy())  # over the segment lines
    # a median of values with two decimals has at most three
    return rates.withColumn("median_rate", median.cast("decimal(10,3)")).withColumn(
        "times_median", round_ratio("churn_rate", "median_rate", 2, scale=3)
    )


def zero_churn_segments(star: Star) -> DataFrame:
    """How many segments lost nothing, of how many."""
    rate = pct("churned", "total")
    return tier_segments(star).agg(
        F.count_if(rate == 0).alias("zero_churn_segments"), F.count(F.lit(1)).alias("segments")
    )


def topk_tier_mix(star: Star, k: int = 10) -> DataFrame:
    """Plan tiers among the k segments that lost most."""
    return (
        q1_churned_mrr(star)
        .where(F.col("revenue_loss_rank") <= k)
        .groupBy("plan_tier")
        .agg(F.count(F.lit(1)).alias("segments"))
    )


def leader_gap(star: Star) -> DataFrame:
    """The segment that lost most and its lead over the next one."""
    return (
        q1_churned_mrr(star)
        .withColumn("lead_over_next", lead_over_next(F.col("churned_mrr")))
        .where("revenue_loss_rank = 1")
    )


def refund_share(star: Star) -> DataFrame:
    """Refunds as a percentage of churned MRR by industry and country."""
    return q3_net_impact(star).select(
        "industry",
        "country",
        "churned_mrr",
        "total_refunds",
        pct("total_refunds", "churned_mrr").alias("refund_pct"),
    )


def segments_above_benchmark(star: Star) -> DataFrame:
    """How many high-value segments churn above the rate of the whole quartile."""
    above = F.col("segment_churn_rate") > F.col("overall_churn_rate")
    return q4_high_value(star).agg(
        F.count_if(above).alias("segments_above"),
        F.count(F.lit(1)).alias("segments"),
        F.max("overall_churn_rate").alias("overall_churn_rate"),
    )


def arr_by_segment(star: Star) -> DataFrame:
    """Annual from monthly recurring revenue by segment."""
    return segment_revenue(star).select(
        "industry", "country", "plan_tier", (F.col("total_mrr") * 12).alias("total_arr"),
        (F.col("churned_mrr") * 12).alias("churned_arr"),
    )


def concurrent_subscriptions(star: Star) -> DataFrame:
    """Active subscriptions per account and month, up to the last month of the calendar."""
    last_month = star["dim_date"].agg(F.max("month_start")).scalar()
    return active_by_month(
        star["fact_subscriptions"],
        ["account_key"],
        "start_date_key",
        "end_date_key",
        last_month,
        "active_subscriptions",
    )


def refunds_by_reason_category(star: Star) -> DataFrame:
    """Churn events and refunds by reason category."""
    per_reason = (
        star["fact_churn_events"]
        .groupBy("churn_reason_key")
        .agg(F.count(F.lit(1)).alias("_events"), F.sum(hundredths("refund_amount_usd")).alias("_refunds"))
    )
    return (
        per_reason.join(star["dim_churn_reason"], "churn_reason_key")
        .groupBy("reason_category")
        .agg(F.sum("_events").alias("churn_events"), F.sum("_refunds").alias("_refunds"))
        .select("reason_category", "churn_events", _money("_refunds", "total_refunds"))
    )


def start_cohorts(star: Star) -> DataFrame:
    """Subscriptions and revenue by the month they started in."""
    return (
        star["fact_subscriptions"]
        .groupBy("start_date_key")
        .agg(F.count(F.lit(1)).alias("subscriptions"), *_revenue())
        .select("start_date_key", "subscriptions", _money(*TOTAL), _money(*CHURNED),
                pct("churned", "total").alias("churn_rate"))
    )


def industry_mrr_share(star: Star) -> DataFrame:
    """Each industry's share of all MRR: a window over grouped lines."""
    return account_segments(star, []).select(
        "industry",
        _money(*TOTAL),
        pct("total", "sum(total) OVER ()").alias("mrr_share"),
    )


def industry_country_rank(star: Star) -> DataFrame:
    """Industry and country ranked by total MRR."""
    return account_segments(star, ["country"]).select(
        "industry", "country", _money(*TOTAL), rank_desc(F.col("total")).alias("mrr_rank")
    )
