"""Fixed table layouts and constraints of the three layers.

Nothing is inferred from data. Constraints are plain SQL predicates; as in SQL,
a CHECK that evaluates to NULL passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Canonical spellings.
PLAN_TIERS = ("Basic", "Pro", "Enterprise")
REFERRAL_SOURCES = ("organic", "ads", "event", "partner", "other")
BILLING_FREQUENCIES = ("monthly", "annual")
PRIORITIES = ("low", "medium", "high", "urgent")

# Churn reasons. Key 1 stands for a missing or unmapped code.
UNKNOWN_REASON_KEY = 1
CHURN_REASONS = (
    (1, "unknown", "Unknown/Not Captured", None),
    (2, "pricing", "Pricing / Cost Concerns", "Commercial"),
    (3, "budget", "Budget Constraints", "Commercial"),
    (4, "competitor", "Moved to Competitor", "Commercial"),
    (5, "support", "Poor Support Experience", "Product & Experience"),
    (6, "features", "Missing Features", "Product & Experience"),
)

# Fixed value: a month with fewer active days counts as low engagement.
LOW_ENGAGEMENT_DAYS = 5

RAW_COLUMNS = {
    "accounts": (
        "account_id", "account_name", "industry", "country", "signup_date",
        "referral_source", "plan_tier", "seats", "is_trial", "churn_flag",
    ),
    "subscriptions": (
        "subscription_id", "account_id", "start_date", "end_date", "plan_tier", "seats", "mrr_amount",
        "is_trial", "upgrade_flag", "downgrade_flag", "churn_flag", "billing_frequency", "auto_renew_flag",
    ),
    "feature_usage": (
        "usage_id", "subscription_id", "usage_date", "feature_name", "usage_count",
        "usage_duration_secs", "error_count", "is_beta_feature",
    ),
    "churn_events": (
        "churn_event_id", "account_id", "churn_date", "reason_code", "refund_amount_usd",
        "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation", "feedback_text",
    ),
    "support_tickets": (
        "ticket_id", "account_id", "submitted_at", "closed_at", "priority",
        "first_response_time_minutes", "satisfaction_score", "escalation_flag",
    ),
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


@dataclass(frozen=True)
class Reference:
    """Each non-NULL ``column`` value must exist as ``parent_column`` of ``parent``."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Constraints:
    key: tuple[str, ...]
    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()

    def domain_rules(self) -> dict[str, str]:
        listed = {c: ", ".join(f"'{v}'" for v in values) for c, values in self.domains.items()}
        return {f"{c} in domain": f"{c} IN ({values})" for c, values in listed.items()}

    def length_rules(self) -> dict[str, str]:
        return {f"{c} length": f"char_length({c}) <= {n}" for c, n in self.lengths.items()}

    def row_rules(self) -> dict[str, str]:
        """Every constraint a single row can break, by name."""
        present = {f"{c} is set": f"{c} IS NOT NULL" for c in self.not_null}
        return present | self.checks | self.domain_rules() | self.length_rules()

    def key_rules(self) -> dict[str, tuple[str, ...]]:
        return {f"{' + '.join(cols)} unique": cols for cols in (self.key, *self.unique)}


# Listed so that every table follows the tables it refers to.
CLEAN = {
    "accounts": Constraints(
        key=("account_id",),
        not_null=(
            "account_id", "account_name", "industry", "country", "signup_date",
            "plan_tier", "seats", "is_trial", "churn_flag",
        ),
        checks={"country has 2 letters": "char_length(country) = 2", "seats positive": "seats > 0"},
        domains={"referral_source": REFERRAL_SOURCES, "plan_tier": PLAN_TIERS},
        # the dimension is narrower than the clean table for account_name
        lengths={"account_id": 50, "account_name": 100, "industry": 100, "country": 2},
    ),
    "subscriptions": Constraints(
        key=("subscription_id",),
        not_null=(
            "subscription_id", "account_id", "start_date", "plan_tier", "seats", "mrr_amount", "is_trial",
            "upgrade_flag", "downgrade_flag", "churn_flag", "billing_frequency", "auto_renew_flag",
        ),
        checks={
            "seats positive": "seats > 0",
            "mrr not negative": "mrr_amount >= 0",
            "ends after start": "end_date IS NULL OR end_date >= start_date",
        },
        domains={"plan_tier": PLAN_TIERS, "billing_frequency": BILLING_FREQUENCIES},
        lengths={"subscription_id": 50, "account_id": 50},
        references=(Reference("account_id", "accounts", "account_id"),),
    ),
    "churn_events": Constraints(
        key=("churn_event_id",),
        not_null=(
            "churn_event_id", "account_id", "churn_date", "reason_code", "refund_amount_usd",
            "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation",
        ),
        checks={"refund not negative": "refund_amount_usd >= 0"},
        lengths={"churn_event_id": 50, "account_id": 50, "reason_code": 50},
        references=(Reference("account_id", "accounts", "account_id"),),
    ),
    "support_tickets": Constraints(
        key=("ticket_id",),
        not_null=(
            "ticket_id", "account_id", "submitted_at", "priority",
            "first_response_time_minutes", "escalation_flag",
        ),
        checks={
            "response not negative": "first_response_time_minutes >= 0",
            "satisfaction 1 to 5": "satisfaction_score BETWEEN 1 AND 5",
            "closed after submitted": "closed_at IS NULL OR closed_at >= submitted_at",
        },
        domains={"priority": PRIORITIES},
        lengths={"ticket_id": 50, "account_id": 50},
        references=(Reference("account_id", "accounts", "account_id"),),
    ),
    "feature_usage": Constraints(
        key=("usage_id",),
        not_null=(
            "usage_id", "subscription_id", "usage_date", "feature_name", "usage_count",
            "usage_duration_secs", "error_count", "is_beta_feature",
        ),
        checks={
            "usage not negative": "usage_count >= 0",
            "duration not negative": "usage_duration_secs >= 0",
            "errors not negative": "error_count >= 0",
        },
        lengths={"usage_id": 50, "subscription_id": 50, "feature_name": 50},
        references=(Reference("subscription_id", "subscriptions", "subscription_id"),),
    ),
}

STAR = {
    "dim_date": Constraints(
        key=("date_key",),
        not_null=("date_key", "month_start", "month_number", "month_name", "quarter", "year", "is_current_month"),
        lengths={"month_name": 10},
    ),
    "dim_account": Constraints(
        key=("account_key",),
        unique=(("account_id",),),
        not_null=("account_key", "account_id", "account_name"),
        domains={"initial_plan_tier": PLAN_TIERS},
        lengths={"account_id": 50, "account_name": 100, "industry": 100, "country": 2},
    ),
    "dim_subscription": Constraints(
        key=("subscription_key",),
        unique=(("subscription_id",),),
        not_null=("subscription_key", "subscription_id", "is_trial"),
        domains={"plan_tier": PLAN_TIERS, "billing_frequency": BILLING_FREQUENCIES},
        lengths={"subscription_id": 50},
    ),
    "dim_churn_reason": Constraints(
        key=("churn_reason_key",),
        unique=(("reason_code",),),
        not_null=("churn_reason_key", "reason_code", "reason_label"),
        lengths={"reason_code": 50, "reason_label": 100, "reason_category": 50},
    ),
    "fact_subscriptions": Constraints(
        key=("subscription_key",),
        not_null=(
            "subscription_key", "account_key", "start_date_key", "mrr",
            "is_churned", "is_upgraded", "is_downgraded", "auto_renew_flag",
        ),
        references=(
            Reference("subscription_key", "dim_subscription", "subscription_key"),
            Reference("account_key", "dim_account", "account_key"),
            Reference("start_date_key", "dim_date", "date_key"),
            Reference("end_date_key", "dim_date", "date_key"),
        ),
    ),
    "fact_churn_events": Constraints(
        key=("churn_event_key",),
        unique=(("churn_event_id",),),
        not_null=(
            "churn_event_key", "churn_event_id", "account_key", "churn_date_key", "churn_reason_key",
            "refund_amount_usd", "is_reactivation", "preceding_upgrade_flag", "preceding_downgrade_flag",
        ),
        lengths={"churn_event_id": 50},
        references=(
            Reference("account_key", "dim_account", "account_key"),
            Reference("churn_date_key", "dim_date", "date_key"),
            Reference("churn_reason_key", "dim_churn_reason", "churn_reason_key"),
        ),
    ),
    "fact_subscription_usage": Constraints(
        key=("date_key", "account_key", "subscription_key"),
        not_null=("date_key", "account_key", "subscription_key", "is_churned"),
        references=(
            Reference("date_key", "dim_date", "date_key"),
            Reference("account_key", "dim_account", "account_key"),
            Reference("subscription_key", "dim_subscription", "subscription_key"),
        ),
    ),
}

LAYERS = {"raw": RAW_COLUMNS, "clean": CLEAN, "star": STAR}

# Column types of the star tables. Keys and sums are BIGINT: at large volumes
# they outgrow 32 bits.
STAR_TYPES = {
    "dim_date": {
        "date_key": "int", "month_start": "date", "month_number": "tinyint", "month_name": "string",
        "quarter": "tinyint", "year": "smallint", "is_current_month": "boolean",
    },
    "dim_account": {
        "account_key": "bigint", "account_id": "string", "account_name": "string",
        "industry": "string", "country": "string", "initial_plan_tier": "string",
    },
    "dim_subscription": {
        "subscription_key": "bigint", "subscription_id": "string", "plan_tier": "string",
        "seats": "int", "is_trial": "boolean", "billing_frequency": "string",
    },
    "dim_churn_reason": {
        "churn_reason_key": "int", "reason_code": "string", "reason_label": "string", "reason_category": "string",
    },
    "fact_subscriptions": {
        "subscription_key": "bigint", "account_key": "bigint", "start_date_key": "int", "end_date_key": "int",
        "mrr": "decimal(12,2)", "is_churned": "tinyint", "is_upgraded": "tinyint",
        "is_downgraded": "tinyint", "auto_renew_flag": "tinyint",
    },
    "fact_churn_events": {
        "churn_event_key": "bigint", "churn_event_id": "string", "account_key": "bigint",
        "churn_date_key": "int", "churn_reason_key": "int", "refund_amount_usd": "decimal(12,2)",
        "is_reactivation": "tinyint", "preceding_upgrade_flag": "tinyint", "preceding_downgrade_flag": "tinyint",
    },
    "fact_subscription_usage": {
        "date_key": "int", "account_key": "bigint", "subscription_key": "bigint",
        "active_days": "smallint", "feature_adoption_count": "int",
        "total_usage_count": "bigint", "total_usage_duration_secs": "bigint",
        "avg_usage_duration_secs": "decimal(12,2)", "total_error_count": "bigint",
        "beta_feature_usage_count": "bigint", "error_rate": "decimal(14,4)",
        "mom_active_days_delta": "smallint", "consecutive_low_engagement_months": "int",
        "support_tickets_opened": "bigint", "support_tickets_unresolved_eom": "bigint",
        "avg_resolution_hours": "decimal(10,2)", "avg_satisfaction_score": "decimal(4,2)",
        "is_churned": "tinyint",
    },
}
