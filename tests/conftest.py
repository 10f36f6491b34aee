from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidemark.schemas import RAW_COLUMNS, raw_schema  # noqa: E402
from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tidemark-tests",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    yield session
    session.stop()


DEFAULTS = {
    "accounts": {
        "account_id": "A-1", "account_name": "Acme", "industry": "Tech", "country": "US", "signup_date": "05/01/2023",
        "referral_source": "ads", "plan_tier": "Pro", "seats": "3", "is_trial": "False", "churn_flag": "False",
    },
    "subscriptions": {
        "subscription_id": "S-1", "account_id": "A-1", "start_date": "2023-01-09", "end_date": "", "plan_tier": "Pro",
        "seats": "3", "mrr_amount": "100.00", "is_trial": "False", "upgrade_flag": "False", "downgrade_flag": "False",
        "churn_flag": "False", "billing_frequency": "monthly", "auto_renew_flag": "True",
    },
    "feature_usage": {
        "usage_id": "U-1", "subscription_id": "S-1", "usage_date": "2023-02-01", "feature_name": "search",
        "usage_count": "4", "usage_duration_secs": "60", "error_count": "1", "is_beta_feature": "False",
    },
    "churn_events": {
        "churn_event_id": "C-1", "account_id": "A-1", "churn_date": "07/03/2023", "reason_code": "pricing",
        "refund_amount_usd": "10.00", "preceding_upgrade_flag": "False", "preceding_downgrade_flag": "False",
        "is_reactivation": "False", "feedback_text": "",
    },
    "support_tickets": {
        "ticket_id": "T-1", "account_id": "A-1", "submitted_at": "2023-02-03", "closed_at": "2023-02-03 05:30:00",
        "priority": "high", "first_response_time_minutes": "30", "satisfaction_score": "4.0",
        "escalation_flag": "False",
    },
}


@pytest.fixture(scope="session")
def raw(spark):
    """Raw frame of a table from rows that name only what matters."""

    def make(table: str, *rows: dict):
        values = [tuple({**DEFAULTS[table], **row}[c] for c in RAW_COLUMNS[table]) for row in rows]
        return spark.createDataFrame(values, raw_schema(table))

    return make


@pytest.fixture(scope="session")
def warehouse(spark, raw):
    """A warehouse over hand-made raw rows, e.g. ``warehouse(accounts=[{...}])``."""
    from tidemark.plans.warehouse import Warehouse

    def make(policy=None, buckets=None, known=None, **tables):
        frames = {t: raw(t, *tables.get(t, [])) for t in RAW_COLUMNS}
        return Warehouse(spark, frames, policy=policy, buckets=buckets, known=known)

    return make
