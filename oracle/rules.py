"""The constraints each table must hold, written out for the checks.

They are stated here on their own, from the table definitions, so that a wrong
or missing rule of the library shows as a difference.
"""

from __future__ import annotations

_TIERS = "'Basic', 'Pro', 'Enterprise'"

# table -> rules one row can break, by name, in the order in which they are reported
NOT_NULL = {
    "accounts": "account_id account_name industry country signup_date plan_tier seats is_trial churn_flag",
    "subscriptions": "subscription_id account_id start_date plan_tier seats mrr_amount is_trial upgrade_flag "
    "downgrade_flag churn_flag billing_frequency auto_renew_flag",
    "churn_events": "churn_event_id account_id churn_date reason_code refund_amount_usd preceding_upgrade_flag "
    "preceding_downgrade_flag is_reactivation",
    "support_tickets": "ticket_id account_id submitted_at priority first_response_time_minutes escalation_flag",
    "feature_usage": "usage_id subscription_id usage_date feature_name usage_count usage_duration_secs error_count "
    "is_beta_feature",
    "dim_date": "date_key month_start month_number month_name quarter year is_current_month",
    "dim_account": "account_key account_id account_name",
    "dim_subscription": "subscription_key subscription_id is_trial",
    "dim_churn_reason": "churn_reason_key reason_code reason_label",
    "fact_subscriptions": "subscription_key account_key start_date_key mrr is_churned is_upgraded is_downgraded "
    "auto_renew_flag",
    "fact_churn_events": "churn_event_key churn_event_id account_key churn_date_key churn_reason_key refund_amount_usd "
    "is_reactivation preceding_upgrade_flag preceding_downgrade_flag",
    "fact_subscription_usage": "date_key account_key subscription_key is_churned",
}
CHECKS = {
    "accounts": {"country has 2 letters": "length(country) = 2", "seats positive": "seats > 0"},
    "subscriptions": {
        "seats positive": "seats > 0",
        "mrr not negative": "mrr_amount >= 0",
        "ends after start": "end_date IS NULL OR end_date >= start_date",
    },
    "churn_events": {"refund not negative": "refund_amount_usd >= 0"},
    "support_tickets": {
        "response not negative": "first_response_time_minutes >= 0",
        "satisfaction 1 to 5": "satisfaction_score >= 1 AND satisfaction_score <= 5",
        "closed after submitted": "closed_at IS NULL OR closed_at >= submitted_at",
    },
    "feature_usage": {
        "usage not negative": "usage_count >= 0",
        "duration not negative": "usage_duration_secs >= 0",
        "errors not negative": "error_count >= 0",
    },
}
DOMAINS = {
    "accounts": {
        "referral_source": "'organic', 'ads', 'event', 'partner', 'other'",
        "plan_tier": _TIERS,
    },
    "subscriptions": {"plan_tier": _TIERS, "billing_frequency": "'monthly', 'annual'"},
    "support_tickets": {"priority": "'low', 'medium', 'high', 'urgent'"},
    "dim_account": {"initial_plan_tier": _TIERS},
    "dim_subscription": {"plan_tier": _TIERS, "billing_frequency": "'monthly', 'annual'"},
}
LENGTHS = {
    "accounts": {"account_id": 50, "account_name": 100, "industry": 100, "country": 2},
    "subscriptions": {"subscription_id": 50, "account_id": 50},
    "churn_events": {"churn_event_id": 50, "account_id": 50, "reason_code": 50},
    "support_tickets": {"ticket_id": 50, "account_id": 50},
    "feature_usage": {"usage_id": 50, "subscription_id": 50, "feature_name": 50},
    "dim_date": {"month_name": 10},
    "dim_account": {"account_id": 50, "account_name": 100, "industry": 100, "country": 2},
    "dim_subscription": {"subscription_id": 50},
    "dim_churn_reason": {"reason_code": 50, "reason_label": 100, "reason_category": 50},
    "fact_churn_events": {"churn_event_id": 50},
}
# table -> keys, the primary one first
KEYS = {
    "accounts": ["account_id"],
    "subscriptions": ["subscription_id"],
    "churn_events": ["churn_event_id"],
    "support_tickets": ["ticket_id"],
    "feature_usage": ["usage_id"],
    "dim_date": ["date_key"],
    "dim_account": ["account_key", "account_id"],
    "dim_subscription": ["subscription_key", "subscription_id"],
    "dim_churn_reason": ["churn_reason_key", "reason_code"],
    "fact_subscriptions": ["subscription_key"],
    "fact_churn_events": ["churn_event_key", "churn_event_id"],
    "fact_subscription_usage": ["date_key account_key subscription_key"],
}
# table -> (column, parent), the parent's column being of the same name or its key
REFERENCES = {
    "subscriptions": [("account_id", "accounts", "account_id")],
    "churn_events": [("account_id", "accounts", "account_id")],
    "support_tickets": [("account_id", "accounts", "account_id")],
    "feature_usage": [("subscription_id", "subscriptions", "subscription_id")],
    "fact_subscriptions": [
        ("subscription_key", "dim_subscription", "subscription_key"),
        ("account_key", "dim_account", "account_key"),
        ("start_date_key", "dim_date", "date_key"),
        ("end_date_key", "dim_date", "date_key"),
    ],
    "fact_churn_events": [
        ("account_key", "dim_account", "account_key"),
        ("churn_date_key", "dim_date", "date_key"),
        ("churn_reason_key", "dim_churn_reason", "churn_reason_key"),
    ],
    "fact_subscription_usage": [
        ("date_key", "dim_date", "date_key"),
        ("account_key", "dim_account", "account_key"),
        ("subscription_key", "dim_subscription", "subscription_key"),
    ],
}
CLEAN_TABLES = ("accounts", "subscriptions", "churn_events", "support_tickets", "feature_usage")
STAR_TABLES = tuple(t for t in KEYS if t not in CLEAN_TABLES)


def domain_rules(table: str) -> dict[str, str]:
    return {f"{c} in domain": f"{c} IN ({values})" for c, values in DOMAINS.get(table, {}).items()}


def length_rules(table: str) -> dict[str, str]:
    return {f"{c} length": f"length({c}) <= {n}" for c, n in LENGTHS.get(table, {}).items()}


def row_rules(table: str) -> dict[str, str]:
    present = {f"{c} is set": f"{c} IS NOT NULL" for c in NOT_NULL[table].split()}
    return present | CHECKS.get(table, {}) | domain_rules(table) | length_rules(table)
