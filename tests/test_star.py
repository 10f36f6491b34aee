from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidemark.plans import facts


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_calendar_spans_starts_and_ends(warehouse):
    w = warehouse(
        subscriptions=[
            {"subscription_id": "S-1", "start_date": "2023-11-30", "end_date": "2024-01-01"},
            {"subscription_id": "S-2", "start_date": "2023-12-05"},
        ]
    )
    months = by(w.star["dim_date"], "date_key")
    assert sorted(months) == [202311, 202312, 202401]
    assert months[202311].asDict() == {
        "date_key": 202311, "month_start": dt.date(2023, 11, 1), "month_number": 11, "month_name": "November",
        "quarter": 4, "year": 2023, "is_current_month": False,
    }
    assert [m for m, r in months.items() if r["is_current_month"]] == [202401]


def test_calendar_without_any_end_date_runs_to_the_last_start(warehouse):
    w = warehouse(subscriptions=[{"start_date": "2023-01-31"}, {"subscription_id": "S-2", "start_date": "2023-03-01"}])
    assert sorted(by(w.star["dim_date"], "date_key")) == [202301, 202302, 202303]
    assert warehouse().star["dim_date"].collect() == []


def test_dimensions_and_fact_share_dense_keys(warehouse):
    w = warehouse(
        accounts=[{"account_id": "B"}, {"account_id": "A", "plan_tier": "basic"}],
        subscriptions=[
            {"subscription_id": "S-2", "account_id": "b", "mrr_amount": "12.5", "churn_flag": "true"},
            {"subscription_id": "S-1", "account_id": "A", "end_date": "2023-02-10"},
            {"subscription_id": "S-3", "account_id": "nobody"},
        ],
    )
    accounts = by(w.star["dim_account"], "account_id")
    assert {k: (r["account_key"], r["initial_plan_tier"]) for k, r in accounts.items()} == {
        "A": (1, "Basic"), "B": (2, "Pro"),
    }
    assert {k: r["subscription_key"] for k, r in by(w.star["dim_subscription"], "subscription_id").items()} == {
        "S-1": 1, "S-2": 2, "S-3": 3,
    }
    fact = by(w.star["fact_subscriptions"], "subscription_key")
    assert sorted(fact) == [1, 2]  # the subscription of an unknown account has no fact row
    assert (fact[1]["account_key"], fact[1]["end_date_key"], fact[1]["is_churned"]) == (1, 202302, 0)
    assert (fact[2]["account_key"], fact[2]["end_date_key"], fact[2]["is_churned"]) == (2, None, 1)
    assert fact[2]["mrr"] == Decimal("12.50")


def test_reasons_match_without_case_and_unmapped_codes_get_key_one(warehouse):
    w = warehouse(
        accounts=[{}],
        subscriptions=[{}],
        churn_events=[
            {"churn_event_id": "C-1", "reason_code": "Pricing"},
            {"churn_event_id": "C-2", "reason_code": "merger"},
            {"churn_event_id": "C-3", "reason_code": " features "},
            {"churn_event_id": "C-4", "account_id": "nobody"},
        ],
    )
    events = by(w.star["fact_churn_events"], "churn_event_id")
    assert {k: (r["churn_event_key"], r["churn_reason_key"], r["churn_date_key"]) for k, r in events.items()} == {
        "C-1": (1, 2, 202303), "C-2": (2, 1, 202303), "C-3": (3, 6, 202303),
    }


def test_monthly_usage(raw):
    from tidemark.plans import clean

    usage = clean.clean_feature_usage(
        raw("feature_usage",
            {"usage_id": "1", "usage_date": "2023-02-01", "feature_name": "search", "usage_duration_secs": "10"},
            {"usage_id": "2", "usage_date": "2023-02-01", "feature_name": "Search", "usage_duration_secs": "11",
             "is_beta_feature": "true"},
            {"usage_id": "3", "usage_date": "2023-02-28", "feature_name": "export", "usage_duration_secs": "13"},
            {"usage_id": "4", "usage_date": "2023-03-31", "subscription_id": "s-1"})
    )
    months = by(facts.monthly_feature(usage), "subscription_id", "date_key")
    feb, mar = months["s-1", 202302], months["s-1", 202303]
    assert (feb["active_days"], feb["feature_adoption_count"], feb["total_usage_count"]) == (2, 2, 12)
    assert (feb["avg_usage_duration_secs"], feb["beta_feature_usage_count"]) == (Decimal("11.33"), 1)
    assert (mar["active_days"], mar["feature_adoption_count"]) == (1, 1)


def test_ticket_on_the_last_day_counts_as_unresolved_after_midnight(raw):
    from tidemark.plans import clean

    tickets = clean.clean_support_tickets(
        raw("support_tickets",
            {"ticket_id": "1", "submitted_at": "2023-02-03", "closed_at": "2023-02-28 00:00:00", "satisfaction_score": "4.0"},
            {"ticket_id": "2", "submitted_at": "2023-02-03", "closed_at": "2023-02-28 10:00:00", "satisfaction_score": ""},
            {"ticket_id": "3", "submitted_at": "2023-02-03", "closed_at": "", "satisfaction_score": "5.0"},
            {"ticket_id": "4", "submitted_at": "2023-03-01", "closed_at": "", "satisfaction_score": ""})
    )
    months = by(facts.ticket_monthly(tickets), "date_key")
    feb, mar = months[202302], months[202303]
    assert (feb["support_tickets_opened"], feb["support_tickets_unresolved_eom"]) == (3, 2)
    assert (feb["avg_resolution_hours"], feb["avg_satisfaction_score"]) == (Decimal("605.00"), Decimal("4.50"))
    assert (mar["support_tickets_unresolved_eom"], mar["avg_resolution_hours"], mar["avg_satisfaction_score"]) == (
        1, None, None,
    )


def usage_days(subscription, month, days, **more):
    return [
        {"usage_id": f"{subscription}-{month}-{d}", "subscription_id": subscription, "usage_date": f"{month}-{d:02d}", **more}
        for d in range(1, days + 1)
    ]


def test_usage_fact_windows_and_ticket_months(warehouse):
    w = warehouse(
        accounts=[{}],
        subscriptions=[{"churn_flag": "true", "end_date": "2023-12-31"}, {"subscription_id": "S-2"}],
        feature_usage=[
            *usage_days("S-1", "2023-02", 3),
            *usage_days("S-1", "2023-05", 6),  # no usage in March and April
            *usage_days("S-1", "2023-06", 2),
            *usage_days("S-2", "2023-02", 1, usage_count=""),
            *usage_days("S-9", "2023-02", 1),  # unknown subscription
        ],
        support_tickets=[{"ticket_id": "1"}, {"ticket_id": "2"}, {"ticket_id": "3", "submitted_at": "2023-09-01"}],
    )
    fact = by(w.star["fact_subscription_usage"], "subscription_key", "date_key")
    assert sorted(fact) == [(1, 202302), (1, 202305), (1, 202306), (2, 202302)]
    trend = [
        (fact[1, m]["mom_active_days_delta"], fact[1, m]["consecutive_low_engagement_months"])
        for m in (202302, 202305, 202306)
    ]
    # the delta is against the previous month with usage; the count never resets
    assert trend == [(None, 1), (3, 1), (-4, 2)]
    # tickets belong to the account and show on each of its subscriptions
    assert [fact[k]["support_tickets_opened"] for k in sorted(fact)] == [2, None, None, 2]
    assert [fact[k]["is_churned"] for k in sorted(fact)] == [1, 1, 1, 0]
    assert fact[1, 202302]["error_rate"] == Decimal("0.2500")
    assert fact[2, 202302]["error_rate"] is None  # no usage to relate errors to


def test_known_keys_are_kept_on_a_later_load(spark, warehouse):
    from tidemark.operators import extend_surrogate_key

    first = warehouse(accounts=[{}], subscriptions=[{"subscription_id": "S-5"}])
    later = warehouse(accounts=[{}], subscriptions=[{"subscription_id": "S-5"}, {"subscription_id": "S-1"}])
    incoming = later.clean["subscriptions"].select(
        "subscription_id", "plan_tier", "seats", "is_trial", "billing_frequency"
    )
    dim = extend_surrogate_key(first.star["dim_subscription"], incoming, "subscription_key", "subscription_id")
    assert {r["subscription_id"]: r["subscription_key"] for r in dim.collect()} == {"S-5": 1, "S-1": 2}
    from tidemark.plans import dims

    bridge = dims.subscription_bridge(later.clean["subscriptions"], later.star["dim_account"], known=dim)
    fact = facts.build_fact_subscriptions(bridge)
    assert sorted(r["subscription_key"] for r in fact.collect()) == [1, 2]
