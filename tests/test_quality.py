from __future__ import annotations

import pytest

from tidemark.operators import quality
from tidemark.plans import clean, facts, validation
from tidemark.schemas import CLEAN, PLAN_TIERS, Constraints, Reference


def counts(df):
    return {r["rule"]: r["violations"] for r in df.collect() if r["violations"]}


def account_counts(raw, *rows):
    df = clean.clean_accounts(raw("accounts", *rows))
    return counts(quality.audit(df, CLEAN["accounts"], {}))


@pytest.mark.parametrize(
    ("row", "broken"),
    [
        ({}, {}),
        ({"account_id": None}, {"account_id is set": 1, "account_id unique": 1}),
        ({"signup_date": "31/02/2024"}, {"signup_date is set": 1}),
        ({"signup_date": "1/2/2024"}, {}),
        ({"seats": "0"}, {"seats positive": 1}),
        ({"seats": "-3"}, {"seats is set": 1}),
        ({"seats": "12.7"}, {"seats is set": 1}),
        ({"seats": "abc"}, {"seats is set": 1}),
        ({"is_trial": None}, {"is_trial is set": 1}),
        ({"plan_tier": "gold"}, {"plan_tier is set": 1}),
        ({"referral_source": "radio"}, {"referral_source in domain": 1}),
        ({"referral_source": ""}, {}),
        ({"country": "USA"}, {"country has 2 letters": 1, "country length": 1}),
        ({"account_name": "x" * 101}, {"account_name length": 1}),
    ],
)
def test_account_rules(raw, row, broken):
    assert account_counts(raw, {"account_id": "A-9"}, row) == broken


@pytest.mark.parametrize(
    ("row", "broken"),
    [
        ({}, {}),
        ({"end_date": "2023-01-08"}, {"ends after start": 1}),
        ({"end_date": "2023-01-09"}, {}),
        ({"mrr_amount": "-1"}, {"mrr not negative": 1}),
        ({"billing_frequency": "weekly"}, {"billing_frequency in domain": 1}),
        ({"account_id": "nobody"}, {"account_id in accounts": 1}),
        ({"account_id": "a-1"}, {}),
        ({"subscription_id": "s-9"}, {"subscription_id unique": 2}),
    ],
)
def test_subscription_rules(raw, row, broken):
    df = clean.clean_subscriptions(raw("subscriptions", {"subscription_id": "S-9"}, row))
    accounts = clean.clean_accounts(raw("accounts", {}))
    assert counts(quality.audit(df, CLEAN["subscriptions"], {"accounts": accounts})) == broken


@pytest.mark.parametrize(
    ("row", "broken"),
    [
        ({"satisfaction_score": "0.4"}, {"satisfaction 1 to 5": 1}),
        ({"satisfaction_score": "5.5"}, {"satisfaction 1 to 5": 1}),
        ({"satisfaction_score": "2.5"}, {}),
        ({"satisfaction_score": ""}, {}),
        ({"closed_at": "2023-02-02 23:59:59"}, {"closed after submitted": 1}),
        ({"first_response_time_minutes": "soon"}, {"first_response_time_minutes is set": 1}),
        ({"submitted_at": "2024-13-01"}, {"submitted_at is set": 1}),
    ],
)
def test_ticket_rules(raw, row, broken):
    df = clean.clean_support_tickets(raw("support_tickets", row))
    accounts = clean.clean_accounts(raw("accounts", {}))
    assert counts(quality.audit(df, CLEAN["support_tickets"], {"accounts": accounts})) == broken


def test_single_checks(spark, raw):
    df = spark.createDataFrame([("a", 1), ("A", 2), (None, 3), ("gold", None)], "k string, v int")
    assert {(r["k"], r["n_rows"]) for r in quality.check_unique(df, ["k"]).collect()} == {("a", 2), (None, 1)}
    assert counts(quality.check_not_null(df, ["k", "v"])) == {"k": 1, "v": 1}
    assert counts(quality.check_expr(df, "small", "v < 3")) == {"small": 1}  # NULL passes
    assert [tuple(r) for r in quality.check_domain(df, "k", ["a"]).collect()] == [("gold", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in quality.check_fk(df, parent, "k", "id").collect()] == [("gold", 1)]
    assert [tuple(r) for r in quality.check_count(df, 4).collect()] == [(4, 4, True)]
    assert [tuple(r) for r in quality.check_count(df, parent).collect()] == [(4, 1, False)]
    assert {tuple(r) for r in quality.row_counts({"x": df, "y": parent}).collect()} == {("x", 4), ("y", 1)}


def test_fail_policy_refuses_the_table(warehouse):
    w = warehouse("fail", accounts=[{}, {"account_id": "a-1", "seats": "0"}])
    with pytest.raises(quality.QualityError) as refused:
        w.clean["accounts"]
    assert refused.value.counts == {"account_id unique": 2, "seats positive": 1}
    with pytest.raises(ValueError, match="unknown policy"):
        warehouse("ignore", accounts=[{}]).clean["accounts"]


def test_quarantine_keeps_good_rows_and_hands_back_the_bad_whole(warehouse):
    w = warehouse(
        "quarantine",
        accounts=[{}, {"account_id": "A-2", "seats": "0", "country": "USA"}],
        subscriptions=[
            {},
            {"subscription_id": "S-2", "account_id": "A-2"},  # its account is in quarantine
            {"subscription_id": "S-3"},
            {"subscription_id": "s-3"},
        ],
        feature_usage=[
            {"usage_id": "U-1"},
            {"usage_id": "U-2", "usage_date": "2030-01-01"},  # outside the calendar
            {"usage_id": "U-3", "subscription_id": "S-3"},
        ],
        churn_events=[{}, {"churn_event_id": "C-2", "churn_date": "01/01/2030"}],
        support_tickets=[{}],
    )
    # the calendar must reach February and March
    w.raw["subscriptions"] = w.raw["subscriptions"].replace({"": "2023-03-31"}, subset=["end_date"])
    w.load_all()
    rejected = {
        key: {tuple(sorted(r["violations"])) for r in bad.collect()} for key, bad in w.rejected.items() if bad.count()
    }
    assert rejected == {
        ("clean", "accounts"): {("country has 2 letters", "country length", "seats positive")},
        ("clean", "subscriptions"): {("account_id in accounts",), ("subscription_id unique",)},
        ("clean", "feature_usage"): {("subscription_id in subscriptions",)},
        ("star", "fact_subscription_usage"): {("date_key in dim_date",)},
        ("star", "fact_churn_events"): {("churn_date_key in dim_date",)},
    }
    assert w.rejected["clean", "subscriptions"].count() == 3
    assert [r["subscription_id"] for r in w.clean["subscriptions"].collect()] == ["S-1"]
    assert [r["date_key"] for r in w.star["fact_subscription_usage"].collect()] == [202302]


def test_sanity_checks(warehouse):
    w = warehouse(
        accounts=[{}, {"account_id": "A-2"}],
        subscriptions=[
            {},
            {"subscription_id": "S-2", "account_id": "a-1", "start_date": "2023-01-31", "plan_tier": "gold"},
            {"subscription_id": "S-3", "start_date": "2023-02-01", "plan_tier": None},
        ],
    )
    assert [tuple(r) for r in validation.grain_check(w.clean).collect()] == [("a-1", "202301", 2)]
    assert [tuple(r) for r in validation.unknown_tiers(w.raw).collect()] == [("gold", "subscriptions")]
    assert [tuple(r) for r in validation.distinct_subscribers(w.clean).collect()] == [(1,)]
    assert [tuple(r) for r in validation.accounts_without_subscription(w.clean).collect()] == [("a-2",)]
    assert {tuple(r) for r in validation.clean_row_counts(w.clean).collect()} == {
        ("accounts", 2), ("subscriptions", 3), ("feature_usage", 0), ("churn_events", 0), ("support_tickets", 0),
    }
    assert all(r["agrees"] for r in validation.dim_counts(w.clean, w.star).collect())
    assert PLAN_TIERS == ("Basic", "Pro", "Enterprise")


def test_a_repeated_account_is_refused_by_default(spark, raw):
    from tidemark.plans.warehouse import Warehouse
    from tidemark.schemas import RAW_COLUMNS

    rows = {"accounts": [{}, {"account_id": "a-1"}], "subscriptions": [{"churn_flag": "True"}]}
    w = Warehouse(spark, {t: raw(t, *rows.get(t, [])) for t in RAW_COLUMNS})
    with pytest.raises(quality.QualityError, match="account_id unique: 2"):
        w.load_all()


def test_months_outside_the_calendar_take_no_part_in_the_trend(warehouse):
    w = warehouse(
        policy="quarantine",
        accounts=[{}],
        subscriptions=[{"start_date": "2023-02-01"}],
        feature_usage=[{"usage_id": "U-1", "usage_date": "2023-01-05"}, {"usage_id": "U-2", "usage_date": "2023-02-05"}],
    )
    (kept,) = w.star["fact_subscription_usage"].collect()
    assert (kept["date_key"], kept["mom_active_days_delta"], kept["consecutive_low_engagement_months"]) == (202302, None, 1)
    (bad,) = w.rejected["star", "fact_subscription_usage"].collect()
    assert (bad["date_key"], bad["active_days"], bad["violations"]) == (202301, 1, ["date_key in dim_date"])


def test_a_dropped_warehouse_leaves_nothing(spark, warehouse, tmp_path):
    w = warehouse(policy="quarantine", accounts=[{}], subscriptions=[{}])
    w.root = str(tmp_path / "own")
    w.load_all()
    assert (tmp_path / "own" / "star" / "dim_account").exists() and (tmp_path / "own" / "stage").exists()
    w.drop()
    assert not [p for p in (tmp_path / "own").rglob("*.parquet")]
    assert not spark.catalog.databaseExists(f"tidemark_star_{w.tag}")


def test_a_second_load_keeps_the_keys_of_the_first(warehouse):
    first = warehouse(accounts=[{"account_id": "A-5"}], subscriptions=[{"subscription_id": "S-5", "account_id": "A-5"}])
    ids = ("1", "5")
    second = warehouse(
        known=first,
        accounts=[{"account_id": f"A-{n}"} for n in ids],
        subscriptions=[{"subscription_id": f"S-{n}", "account_id": f"A-{n}"} for n in ids],
    )
    keys = {r["account_id"]: r["account_key"] for r in second.star["dim_account"].collect()}
    assert keys == {"A-5": 1, "A-1": 2}
    assert {r["subscription_id"]: r["subscription_key"] for r in second.star["dim_subscription"].collect()} == {"S-5": 1, "S-1": 2}
    assert sorted((r["account_key"], r["subscription_key"]) for r in second.star["fact_subscriptions"].collect()) == [(1, 1), (2, 2)]


def test_stored_types(warehouse):
    from tidemark.schemas import STAR_TYPES

    w = warehouse(accounts=[{}], subscriptions=[{}], feature_usage=[{}], churn_events=[{}], support_tickets=[{}])
    for table, types in STAR_TYPES.items():
        assert dict(w.star[table].dtypes) == types, table


def test_rows_stay_where_they_are_when_few_values_break_a_rule(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr("if(id = 7, 8, id) AS id", "if(id = 3, 'nobody', 'a') AS a").write.parquet(str(tmp_path / "child"))
    child, parent = spark.read.parquet(str(tmp_path / "child")), spark.createDataFrame([("a",)], "k string")
    c = Constraints(key=("id",), not_null=("id",), references=(Reference("a", "p", "k"),))
    tagged = quality.tag_violations(child, c, {"p": parent})
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    for few in (quality.FEW, 0):
        monkeypatch.setattr(quality, "FEW", few)
        tagged = quality.tag_violations(child, c, {"p": parent})
        broken = {(r["id"], *r["violations"]) for r in tagged.where("size(violations) > 0").collect()}
        assert broken == {(3, "a in p"), (8, "id unique")} and tagged.count() == 200


def test_many_values_are_not_broadcast_once_per_salt(spark, monkeypatch):
    """More than ``FEW`` values, in files that look small: a plan does not see that each comes 16 times."""
    child = spark.range(200).selectExpr("if(id = 7, 8, id) AS id", "if(id < 30, 'no-' || id, 'a') AS a")
    parent = spark.createDataFrame([("a",)], "k string")
    c = Constraints(key=("id",), not_null=("id",), references=(Reference("a", "p", "k"),))
    monkeypatch.setattr(quality, "FEW", 20)
    tagged = quality.tag_violations(child, c, {"p": parent})
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1  # one repeated id, 30 orphans
    broken = [tuple(r["violations"]) for r in tagged.where("size(violations) > 0").collect()]
    assert sorted(broken) == sorted([("a in p",)] * 28 + [("id unique", "a in p")] * 2)


def test_few_values_of_long_text_are_not_broadcast(spark):
    """Three orphans of 6 MB in all are sent to the rows, of 18 MB they are not."""
    parent = spark.createDataFrame([("a",)], "k string")
    c = Constraints(key=("id",), not_null=("id",), references=(Reference("a", "p", "k"),))
    for length, merges in ((2_000_000, 0), (6_000_000, 1)):
        child = spark.range(9).selectExpr("id", f"if(id < 3, id || repeat('x', {length}), 'a') AS a")
        tagged = quality.tag_violations(child, c, {"p": parent})
        assert tagged._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == merges
        assert [r["id"] for r in tagged.where("violations = array('a in p')").select("id").orderBy("id").collect()] == [0, 1, 2]


def test_a_warehouse_bounds_what_a_scan_task_reads(spark, warehouse):
    key = "spark.sql.files.maxPartitionBytes"
    try:
        for before, after in (("128MB", "16m"), ("1m", "1m")):
            spark.conf.set(key, before)
            warehouse()
            assert spark.conf.get(key) == after
    finally:
        spark.conf.unset(key)


def test_a_warehouse_bounds_what_is_broadcast_by_guess(spark, warehouse, tmp_path):
    key, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.range(800_000).selectExpr("'A-' || id AS account_id", "'x' AS country").write.parquet(str(tmp_path / "parent"))
    parent = spark.read.parquet(str(tmp_path / "parent"))
    assert 1 << 20 < int(parent.select("account_id")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 10 << 20
    child = spark.createDataFrame([("A-7",), ("nobody",)], "account_id string")
    try:
        for before, after, kept in (("8m", "128k", "8m"), ("100k", "100k", None), ("-1", "-1", None)):
            spark.conf.unset(measured)
            spark.conf.set(key, before)
            warehouse()
            assert (spark.conf.get(key), spark.conf.get(measured, None)) == (after, kept)
            orphans = quality.check_fk(child, parent, "account_id", "account_id")
            assert "BroadcastExchange" not in orphans._jdf.queryExecution().executedPlan().toString()
            assert [tuple(r) for r in orphans.collect()] == [("nobody", 1)]
    finally:
        spark.conf.unset(key)
        spark.conf.unset(measured)


def test_an_audit_shuffles_every_value_once(spark):
    child = spark.createDataFrame([(1, 1, "x"), (2, 1, "Y"), (2, 9, "z"), (None, None, "y")], "id int, a int, b string")
    numbers, texts = spark.createDataFrame([(1,), (2,)], "k bigint"), spark.createDataFrame([("y",), ("X",)], "k string")
    references = (Reference("a", "n", "k"), Reference("id", "n", "k"), Reference("b", "t", "k"))
    c = Constraints(key=("id",), unique=(("id", "a"),), not_null=("a",), references=references)
    found = quality.audit_tables({"t": (child, c)}, {"n": numbers, "t": texts})
    assert counts(found) == {"id unique": 3, "id + a unique": 1, "a is set": 1, "a in n": 1, "b in t": 1}
    assert {r["rule"] for r in found.collect()} > {"id in n"} and found.count() == 6
    plan = found.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(domain#") <= 2  # of values, then of their sums


def test_quarantine_counts_up_usage_months_once(warehouse, monkeypatch):
    seen = []
    of = facts.owned_months
    monkeypatch.setattr(facts, "owned_months", lambda *a: seen.append(of(*a)) or seen[-1])
    w = warehouse(
        policy="quarantine",
        accounts=[{}],
        subscriptions=[{"start_date": "2023-02-01"}],
        feature_usage=[{"usage_id": "U-1", "usage_date": "2023-01-05"}, {"usage_id": "U-2", "usage_date": "2023-02-05"}],
    )
    assert w.star["fact_subscription_usage"].count() == 1 and len(seen) == 1
    assert w.rejected["star", "fact_subscription_usage"].count() == 1
