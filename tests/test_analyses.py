from __future__ import annotations

import random
from decimal import Decimal
from functools import cache

import pytest

from tidemark.plans import analyses as a


@pytest.fixture(scope="module")
def small(warehouse):
    """Three accounts, hand-computed below."""
    return warehouse(
        accounts=[
            {"account_id": "A", "industry": "Tech", "country": "us"},
            {"account_id": "B", "industry": "tech ", "country": "US"},
            {"account_id": "C", "industry": "Retail", "country": "DE", "plan_tier": "Basic"},
        ],
        subscriptions=[
            {"subscription_id": "1", "account_id": "A", "mrr_amount": "100", "churn_flag": "True"},
            {"subscription_id": "2", "account_id": "A", "mrr_amount": "50", "churn_flag": "True"},
            {"subscription_id": "3", "account_id": "A", "mrr_amount": "300"},
            {"subscription_id": "4", "account_id": "B", "mrr_amount": "150"},
            {"subscription_id": "5", "account_id": "C", "mrr_amount": "0", "plan_tier": "Basic"},
            {"subscription_id": "6", "account_id": "C", "mrr_amount": "70", "end_date": "2023-03-15"},
        ],
        churn_events=[
            {"churn_event_id": "1", "account_id": "A", "refund_amount_usd": "10"},
            {"churn_event_id": "2", "account_id": "A", "refund_amount_usd": "5", "reason_code": "support"},
            {"churn_event_id": "3", "account_id": "C", "refund_amount_usd": "99", "reason_code": "odd"},
        ],
    ).star


def rows(df):
    return [tuple(r) for r in df.collect()]


def money(x):
    return Decimal(x).quantize(Decimal("0.01"))


def test_spellings_of_an_industry_are_one_segment(small):
    assert rows(a.q1_churned_mrr(small)) == [("Tech", "US", "Pro", money(150), 1)]


def test_rate_is_null_without_revenue_and_ranks_last(small):
    assert rows(a.q2_churn_rate(small)) == [
        ("Tech", "US", "Pro", money(150), money(600), money(25), 1),
        ("Retail", "DE", "Pro", money(0), money(70), money(0), 2),
        ("Retail", "DE", "Basic", money(0), money(0), None, 3),
    ]


def test_refunds_count_once_and_only_for_churned_accounts(small):
    assert rows(a.q3_net_impact(small)) == [("Tech", "US", money(150), money(15), money(135), 1)]
    assert rows(a.refund_share(small)) == [("Tech", "US", money(150), money(15), money(10))]
    assert rows(a.q31_industry(small)) == [("Tech", money(150))]


def test_top_quartile_and_its_benchmark(small):
    # three accounts in four tiles: one per tile, the largest first
    tiles = {r["account_key"]: r["account_quartile"] for r in a.account_quartiles(small).collect()}
    assert tiles == {1: 1, 2: 2, 3: 3}
    assert rows(a.q4_high_value(small)) == [("Tech", "Pro", money(150), money(450), money("33.33"), money("33.33"))]
    assert rows(a.segments_above_benchmark(small)) == [(0, 1, money("33.33"))]


def test_derived_metrics(small):
    assert rows(a.zero_churn_segments(small)) == [(1, 3)]
    assert rows(a.topk_tier_mix(small)) == [("Pro", 1)]
    assert rows(a.leader_gap(small)) == [("Tech", "US", "Pro", money(150), 1, None)]
    assert set(rows(a.arr_by_segment(small))) == {
        ("Tech", "US", "Pro", money(7200), money(1800)),
        ("Retail", "DE", "Pro", money(840), money(0)),
        ("Retail", "DE", "Basic", money(0), money(0)),
    }
    assert set(rows(a.refunds_by_reason_category(small))) == {
        ("Commercial", 1, money(10)), ("Product & Experience", 1, money(5)), (None, 1, money(99)),
    }
    assert rows(a.start_cohorts(small)) == [(202301, 6, money(670), money(150), money("22.39"))]
    times = {r["plan_tier"]: (r["median_rate"], r["times_median"]) for r in a.rate_vs_median(small).collect()
             if r["industry"] == "Tech"}
    assert times == {"Pro": (Decimal("12.500"), money(2))}
    assert set(rows(a.concurrent_subscriptions(small))) == {
        (k, m, n) for k, n in ((1, 3), (2, 1), (3, 2)) for m in (202301, 202302, 202303)
    }


@cache
def random_tables(seed):
    rng = random.Random(seed)
    accounts = [{"account_id": f"A{i}", "industry": rng.choice("xyz"), "country": rng.choice(["US", "DE"])} for i in range(20)]
    subscriptions = [
        {
            "subscription_id": f"S{i}",
            # one account holds a third of all subscriptions
            "account_id": "A0" if i % 3 == 0 else f"A{rng.randrange(20)}",
            "mrr_amount": f"{rng.randint(0, 999)}.{rng.randint(0, 99):02d}",
            "plan_tier": rng.choice(["Basic", "Pro", "Enterprise"]),
            "churn_flag": rng.choice(["True", "False"]),
        }
        for i in range(150)
    ]
    events = [
        {"churn_event_id": f"C{i}", "account_id": f"A{rng.randrange(20)}", "refund_amount_usd": f"{rng.randint(0, 50)}"}
        for i in range(40)
    ]
    return accounts, subscriptions, events


def test_totals_are_kept_from_fact_to_report(warehouse):
    accounts, subscriptions, events = random_tables(3)
    star = warehouse(accounts=accounts, subscriptions=subscriptions, churn_events=events).star
    churned = sum(Decimal(s["mrr_amount"]) for s in subscriptions if s["churn_flag"] == "True")
    for report in (a.q1_churned_mrr, a.q2_churn_rate, a.q3_net_impact, a.q31_industry):
        assert sum(r["churned_mrr"] for r in report(star).collect()) == churned
    lost = {s["account_id"] for s in subscriptions if s["churn_flag"] == "True"}
    refunds = sum(Decimal(e["refund_amount_usd"]) for e in events if e["account_id"] in lost)
    assert sum(r["total_refunds"] for r in a.q3_net_impact(star).collect()) == refunds


def test_profile_averages_subscription_months(warehouse):
    from test_star import usage_days

    star = warehouse(
        accounts=[{}],
        subscriptions=[{"churn_flag": "True"}, {"subscription_id": "S-2"}, {"subscription_id": "S-3", "plan_tier": "Basic"}],
        feature_usage=[
            *usage_days("S-1", "2023-02", 2),
            *usage_days("S-1", "2023-03", 3),
            *usage_days("S-1", "2023-04", 3),
            *usage_days("S-2", "2023-02", 9),
            *usage_days("S-3", "2023-02", 1),
        ],
        support_tickets=[{"ticket_id": "1", "satisfaction_score": "4.0"}],
    ).star
    report = {r["plan_tier"]: r for r in a.q5_profile(star).collect()}
    assert list(report) == ["Basic", "Pro"]  # an unknown delta comes first
    pro = report["Pro"]
    assert (pro["avg_active_days_churned"], pro["avg_active_days_retained"]) == (money("2.67"), money(9))
    assert pro["active_days_delta"] == money("-6.33")
    assert (pro["avg_low_engagement_churned"], pro["avg_low_engagement_retained"]) == (money(2), money(0))
    # months without tickets are skipped, not counted as zero
    assert (pro["avg_support_tickets_churned"], pro["avg_satisfaction_churned"]) == (money(1), money(4))
    assert (report["Basic"]["avg_active_days_churned"], report["Basic"]["active_days_delta"]) == (None, None)
