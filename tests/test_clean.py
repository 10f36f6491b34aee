from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidemark.plans import clean


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_account_text_is_trimmed_and_canonical(raw):
    (a,) = rows(
        clean.clean_accounts(
            raw("accounts", {"account_id": " A-1 ", "account_name": " Acme  Co ", "country": " us", "plan_tier": " PRO",
                             "referral_source": " Ads", "seats": " ", "churn_flag": "TRUE "})
        )
    )
    assert a == {
        "account_id": "A-1", "account_name": "Acme  Co", "industry": "Tech", "country": "US",
        "signup_date": dt.date(2023, 1, 5), "referral_source": "ads", "plan_tier": "Pro", "seats": 1,
        "is_trial": False, "churn_flag": True,
    }


def test_unknown_values_are_left_for_the_rules(raw):
    (a,) = rows(
        clean.clean_accounts(
            raw("accounts", {"plan_tier": "gold", "referral_source": "radio", "seats": "12.7", "signup_date": "31/02/2024",
                             "is_trial": None})
        )
    )
    assert (a["plan_tier"], a["referral_source"], a["seats"]) == (None, "radio", None)
    assert (a["signup_date"], a["is_trial"]) == (None, None)


def test_subscription_types(raw):
    (s,) = rows(
        clean.clean_subscriptions(
            raw("subscriptions", {"mrr_amount": " ", "billing_frequency": " ANNUAL", "end_date": "2024-1-5"})
        )
    )
    assert (s["mrr_amount"], s["billing_frequency"], s["end_date"]) == (Decimal("0.00"), "annual", dt.date(2024, 1, 5))


def test_tickets_default_priority_and_rounded_score(raw):
    got = rows(
        clean.clean_support_tickets(
            raw("support_tickets",
                {"ticket_id": "1", "priority": "p0", "satisfaction_score": "4.5", "first_response_time_minutes": ""},
                {"ticket_id": "2", "priority": None, "satisfaction_score": "", "closed_at": ""})
        )
    )
    one, two = sorted(got, key=lambda r: r["ticket_id"])
    assert (one["priority"], one["satisfaction_score"], one["first_response_time_minutes"]) == ("low", 5, 0)
    assert (one["submitted_at"], one["closed_at"]) == (dt.datetime(2023, 2, 3), dt.datetime(2023, 2, 3, 5, 30))
    assert (two["priority"], two["satisfaction_score"], two["closed_at"]) == ("low", None, None)


def test_usage_ids_that_differ_by_blanks_or_case_are_one(raw):
    got = rows(
        clean.clean_feature_usage(
            raw("feature_usage",
                {"usage_id": "U-1", "usage_date": "2023-02-01"},
                {"usage_id": " U-1 ", "usage_date": "2023-02-09"},
                {"usage_id": "u-1", "usage_date": "2023-02-03"},
                {"usage_id": "U-2", "usage_count": ""})
        )
    )
    assert {r["usage_id"]: (r["usage_date"].day, r["usage_count"]) for r in got} == {"U-1": (9, 4), "U-2": (1, 0)}


def test_usage_keeps_the_date_text_that_sorts_last(raw):
    """The order is that of the text: 2023-2-9 sorts after 2023-12-01."""
    (r,) = rows(
        clean.clean_feature_usage(raw("feature_usage", {"usage_date": "2023-12-01"}, {"usage_date": "2023-2-9"}))
    )
    assert r["usage_date"] == dt.date(2023, 2, 9)


def test_churn_events_keep_the_latest_date_and_break_ties_alike(raw):
    events = [
        {"churn_date": "09/03/2023", "refund_amount_usd": "9.00"},
        {"churn_date": "07/04/2023", "refund_amount_usd": "5.00"},
        {"churn_date": "07/04/2023", "refund_amount_usd": "1.00"},
        {"churn_date": "bad", "refund_amount_usd": "2.00"},
    ]
    for order in (events, events[::-1]):
        (r,) = rows(clean.clean_churn_events(raw("churn_events", *order).repartition(3)))
        assert (r["churn_date"], r["refund_amount_usd"]) == (dt.date(2023, 4, 7), Decimal("1.00"))


def test_empty_tables_clean_to_empty_tables(raw):
    for table, job in clean.CLEANERS.items():
        assert job(raw(table)).collect() == []
