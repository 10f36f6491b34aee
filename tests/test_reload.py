"""Second loads: month-wise reloading, stored keys, latest rows, mergeable states, versions, order, change history."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemark import order
from tidemark.operators import delta_calendar, quality, with_streak
from tidemark.plans import clean, dims, facts, states
from tidemark.plans.reload import MonthlyUsage
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import CLEAN, STAR, Constraints, Reference
from tidemark.session import materialize
from tidemark.sources import KeyRegistry, LatestRows, Versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def usage(n, sub, day, feature="search", count="4"):
    return {"usage_id": f"U-{n}", "subscription_id": sub, "usage_date": day, "feature_name": feature, "usage_count": count}


FIRST = {
    "accounts": [{}, {"account_id": "A-2"}],
    "subscriptions": [{}, {"subscription_id": "S-2", "account_id": "a-2"}, {"subscription_id": "S-3", "account_id": "A-2"}],
    "feature_usage": [
        usage(1, "S-1", "2023-01-05"), usage(2, "s-1", "2023-02-05"), usage(3, "S-1", "2023-04-01"), usage(4, "S-1", "2023-04-02", "export"),
        usage(5, "S-2", "2023-01-07"), usage(6, "S-2", "2023-03-07"), usage(7, "S-3", "2023-03-01"), usage(8, "S-9", "2023-03-01"),
    ],
    "support_tickets": [{"account_id": "A-1", "submitted_at": "2023-04-03"}, {"ticket_id": "T-2", "account_id": "A-2", "submitted_at": "2023-03-03"}],
}


def changed(**tables):
    return {**FIRST, **tables}


@pytest.fixture
def loaded(spark, raw, tmp_path):
    """Loads sets of extracts into one store and compares the fact with a full rebuild each time."""
    store, bridges = MonthlyUsage(spark, str(tmp_path / "monthly")), {}

    def load(tables, check=True):
        cleaned = {t: clean.CLEANERS[t](raw(t, *tables.get(t, []))) for t in FIRST}
        which = str([tables["accounts"], tables["subscriptions"]])
        if which not in bridges:
            bridges[which] = materialize(dims.subscription_bridge(cleaned["subscriptions"], dims.load_dim_account(cleaned["accounts"])), "b")
        sources = cleaned["feature_usage"], cleaned["support_tickets"], bridges[which]
        told = store.load(*sources)
        if check:
            got, want = store.fact(), facts.build_fact_subscription_usage(*sources)
            assert rows(got) == rows(want) and got.dtypes == want.dtypes
            assert rows(store.usage().select(cleaned["feature_usage"].columns)) == rows(cleaned["feature_usage"])
        return told

    load.store = store
    few = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.enabled": "false"}  # many small jobs
    before = {k: spark.conf.get(k) for k in few}
    for k, v in few.items():
        spark.conf.set(k, v)
    yield load
    for k, v in before.items():
        spark.conf.set(k, v)


def test_only_months_that_changed_are_read_and_replaced(loaded):
    assert loaded(FIRST) == {"read": [202301, 202302, 202303, 202304], "replaced": [202301, 202302, 202303, 202304]}
    assert loaded(FIRST) == {"read": [], "replaced": []}
    # a new row of S-2 in March: nothing of S-2 comes later
    more = changed(feature_usage=[*FIRST["feature_usage"], usage(9, "S-2", "2023-03-09")])
    assert loaded(more) == {"read": [202303], "replaced": [202303]}
    # another count on the same day: later months of S-1 stay as they are
    other = changed(feature_usage=[usage(2, "s-1", "2023-02-05", count="9") if r["usage_id"] == "U-2" else r for r in more["feature_usage"]])
    assert loaded(other) == {"read": [202302], "replaced": [202302]}
    # a second active day in February moves the change of S-1's next month, April
    day = changed(feature_usage=[*other["feature_usage"], usage(10, "S-1", "2023-02-06")])
    assert loaded(day) == {"read": [202302], "replaced": [202302, 202304]}
    # withdrawn: the only row of January of S-2
    gone = changed(feature_usage=[r for r in day["feature_usage"] if r["usage_id"] != "U-5"])
    assert loaded(gone) == {"read": [202301], "replaced": [202301, 202303]}


def test_months_can_come_and_go(loaded):
    loaded(FIRST)
    later = changed(feature_usage=[*FIRST["feature_usage"], usage(11, "S-2", "2023-07-01"), usage(12, "S-3", "2022-12-01")])
    assert loaded(later) == {"read": [202212, 202307], "replaced": [202212, 202303, 202307]}
    assert loaded(FIRST) == {"read": [202212, 202307], "replaced": [202212, 202303, 202307]}
    assert loaded(changed(feature_usage=[]))["replaced"] == [202301, 202302, 202303, 202304]


def test_owners_and_tickets_change_months_without_new_usage(loaded):
    loaded(FIRST)
    flagged = changed(subscriptions=[*FIRST["subscriptions"][:2], {**FIRST["subscriptions"][2], "churn_flag": "True"}])
    assert loaded(flagged) == {"read": [], "replaced": [202303]}
    ticket = {"ticket_id": "T-3", "account_id": "A-1", "submitted_at": "2023-02-03"}
    assert loaded({**flagged, "support_tickets": [*FIRST["support_tickets"], ticket]}) == {"read": [], "replaced": [202302]}


def test_other_months_files_are_not_opened(loaded):
    loaded(FIRST)
    scan = loaded.store.usage_of([202302])
    assert {re.search(r"date_key=(\d+)", f).group(1) for f in scan.inputFiles()} >= {"202302"}
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date_key.*202302", text)
    assert scan.select(F.input_file_name()).distinct().count() == 1


def test_a_load_that_broke_is_made_good_by_the_next(loaded, monkeypatch):
    from tidemark.plans import reload

    loaded(FIRST)
    day = changed(feature_usage=[*FIRST["feature_usage"], usage(10, "S-1", "2023-02-06")])
    calls, put = [], reload.replace_partitions

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:  # the fact is written, the states are not
            raise OSError("disk lost")
        put(*args)

    monkeypatch.setattr(reload, "replace_partitions", breaks)
    with pytest.raises(OSError, match="disk lost"):
        loaded(day)
    monkeypatch.setattr(reload, "replace_partitions", put)
    loaded(FIRST)  # back to the first extracts: what the broken load wrote goes
    loaded(day)


def test_usage_rows_are_written_once_a_load(loaded, monkeypatch):
    from tidemark.plans import reload

    put, replaced = reload.replace_partitions, []
    monkeypatch.setattr(reload, "replace_partitions", lambda rows, path, *rest: (replaced.append(path), put(rows, path, *rest)))
    versions = set()
    for tables in (FIRST, FIRST, changed(feature_usage=FIRST["feature_usage"][1:])):
        loaded(tables)
        files = loaded.store.usage().inputFiles()
        versions |= {re.search(r"/usage/([^/]*)/", f).group(1) for f in files}
    # the extract itself becomes the table; an unchanged one does not
    assert len(versions) == 2 and not [p for p in replaced if p.endswith("/usage")]
    text = loaded.store.usage_months().select("subscription_id", "active_days").collect()
    assert sorted(map(tuple, text)) == sorted([("s-1", 1), ("s-1", 2), ("s-2", 1), ("s-2", 1), ("s-3", 1), ("s-9", 1)])


def test_rows_without_a_date_are_refused(loaded):
    with pytest.raises(ValueError, match="without a date"):
        loaded(changed(feature_usage=[usage(1, "S-1", "soon")]))


# ---- keys --------------------------------------------------------------------


def test_keys_outlive_loads_and_repeats_change_nothing(spark, raw, tmp_path):
    keys = KeyRegistry(spark, str(tmp_path / "keys"))
    some = spark.createDataFrame([("b",), ("D",), (None,)], "id string")
    more = spark.createDataFrame([("a",), ("B",), ("d",), ("c",), ("c",)], "id string")
    assert rows(keys.register(some, "t", "id")) == [("b", 3), ("d", 2), (None, 1)]
    want = [("a", 4), ("b", 3), ("c", 5), ("d", 2), (None, 1)]
    for _ in range(2):
        assert rows(keys.register(more, "t", "id")) == want
        assert len(list((tmp_path / "keys" / "t").iterdir())) == 2
    assert rows(keys.keyed(more, "t", "id", "k")) == [("B", 3), ("a", 4), ("c", 5), ("c", 5), ("d", 2)]
    assert keys.known("other").count() == 0


def test_a_broken_batch_does_not_count(spark, tmp_path):
    keys = KeyRegistry(spark, str(tmp_path / "keys"))
    keys.register(spark.createDataFrame([("a",)], "id string"), "t", "id")
    broken = tmp_path / "keys" / "t" / "batch=1"
    spark.createDataFrame([("z", 77)], "id string, key bigint").write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert rows(keys.known("t")) == [("a", 1)]
    assert rows(keys.register(spark.createDataFrame([("b",)], "id string"), "t", "id")) == [("a", 1), ("b", 2)]


def test_a_warehouse_draws_all_its_keys_from_the_registry(spark, raw, tmp_path):
    keys = KeyRegistry(spark, str(tmp_path / "keys"))
    events = [{"churn_event_id": "C-5"}, {"churn_event_id": "C-7"}]

    def load(**tables):
        return Warehouse(spark, {t: raw(t, *tables.get(t, [])) for t in CLEAN}, policy="fail", keys=keys)

    def keyed(w):
        names = (("dim_account", "account"), ("dim_subscription", "subscription"), ("fact_churn_events", "churn_event"))
        return {n: dict(rows(w.star[t].select(f"{n}_id", f"{n}_key"))) for t, n in names}

    first = keyed(load(accounts=[{"account_id": "A-1"}], subscriptions=[{"subscription_id": "S-4", "end_date": "2023-12-01"}], churn_events=events))
    assert first == {"account": {"A-1": 1}, "subscription": {"S-4": 1}, "churn_event": {"C-5": 1, "C-7": 2}}
    second = {
        "accounts": [{"account_id": "A-0"}, {"account_id": "A-1"}],
        "subscriptions": [{"subscription_id": "S-4", "end_date": "2023-12-01"}, {"subscription_id": "S-1"}],
        "churn_events": [{"churn_event_id": "C-1"}, *events],
    }
    want = {"account": {"A-0": 2, "A-1": 1}, "subscription": {"S-1": 2, "S-4": 1}, "churn_event": {"C-1": 3, "C-5": 1, "C-7": 2}}
    assert keyed(load(**second)) == want == keyed(load(**second))


# ---- latest rows ----------------------------------------------------------------


def test_late_duplicates_touch_their_own_buckets(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, day int, v string").schema
    store = LatestRows(spark, str(tmp_path / "latest"), schema, "id", [F.col("day").desc_nulls_last()], 32)
    assert rows(store.rows()) == [] and store.merge(spark.createDataFrame([], schema)) == []
    store.merge(spark.createDataFrame([(f"k{n}", 5, "first") for n in range(200)], schema))
    late = spark.createDataFrame([("K7", 6, "late"), ("k7", 4, "old"), ("k8", 5, "a tie"), ("new", 1, "x"), (None, 2, "none")], schema)
    touched = store.merge(late)
    assert 1 < len(touched) <= 4
    text = store.stored_beside(touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket", text)
    opened = {r[0].rsplit("/", 2)[1] for r in store.stored_beside(touched).select(F.input_file_name()).distinct().collect()}
    assert opened == {f"bucket={b}" for b in touched}
    got = {r["id"]: (r["day"], r["v"]) for r in store.rows().collect()}
    assert len(got) == 202 and (got["K7"], got["k8"], got["new"], got[None]) == ((6, "late"), (5, "a tie"), (1, "x"), (2, "none"))
    before = rows(store.rows())
    assert store.merge(late) == touched and rows(store.rows()) == before


# ---- states ---------------------------------------------------------------------


def test_states_of_any_split_merge_to_the_whole(spark, raw):
    frame = clean.clean_feature_usage(
        raw("feature_usage", *[usage(n, f"S-{n % 3}", f"2023-0{1 + n % 2}-{1 + n % 9:02d}", f"F{n % 4}", str(n)) for n in range(60)],
            {"usage_id": "x", "feature_name": " ", "usage_count": "many", "usage_duration_secs": "x"})
    )
    whole = rows(facts.monthly_feature(frame).select("subscription_id", "date_key", "active_days", "feature_adoption_count",
        "total_usage_count", "total_usage_duration_secs", "total_error_count", "beta_feature_usage_count", "avg_usage_duration_secs"))
    parts = [states.usage_state(frame.where(F.pmod(F.xxhash64("usage_id"), F.lit(3)) == n)) for n in range(3)]
    assert rows(states.finish_usage(states.merge_usage(*parts))) == whole
    assert rows(states.finish_usage(states.merge_usage(states.merge_usage(*parts[:2]), parts[2]))) == whole
    assert rows(states.finish_usage(states.usage_state(frame))) == whole


# ---- windows ------------------------------------------------------------------------


def test_missing_months_break_streaks_and_calendar_changes(spark):
    months = [("s", 202311, 2), ("s", 202312, 3), ("s", 202401, 1), ("s", 202402, 9), ("s", 202403, 4), ("s", 202405, 4), ("s", 202406, 0), ("t", 202406, 1)]
    df = spark.createDataFrame(months, "id string, date_key int, days int")
    got = with_streak(df, "streak", F.col("days") < 5, "id", "date_key").withColumn("change", delta_calendar(F.col("days"), "id", "date_key"))
    assert [tuple(r)[1:] for r in sorted(got.collect())] == [
        (202311, 2, 1, None), (202312, 3, 2, 1), (202401, 1, 3, -2), (202402, 9, 0, 8), (202403, 4, 1, -5),
        (202405, 4, 1, None), (202406, 0, 2, -4), (202406, 1, 1, None),
    ]
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan  # one shuffle, no months spelled out


# ---- checks -------------------------------------------------------------------------


def test_checks_scan_each_table_once(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 7 AS a", "id % 3 AS b").write.parquet(str(tmp_path / "child"))
    child, parent = spark.read.parquet(str(tmp_path / "child")), spark.range(5).toDF("k")
    c = Constraints(key=("id",), not_null=("a",), checks={"b small": "b < 2"}, references=(Reference("a", "p", "k"), Reference("b", "p", "k")))
    found = quality.audit_tables({"t": (child, c)}, {"p": parent})
    assert {r["rule"]: r["violations"] for r in found.collect()} == {"a is set": 0, "b small": 16, "id unique": 0, "a in p": 14, "b in p": 0}
    assert found.select("*")._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_tagging_deals_a_hot_orphan_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'nobody', 'A-' || id) AS account_id")
        parent = spark.range(4000).selectExpr("'A-' || id AS account_id")
        c = Constraints(key=("id",), not_null=("id",), references=(Reference("account_id", "p", "account_id"),))
        tagged = quality.tag_violations(hot, c, {"p": parent})
        parts = tagged.where("size(violations) > 0").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in parts) == 1334
        assert max(r["count"] for r in parts) < 0.6 * 1334
        assert tagged.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


# ---- order and versions ---------------------------------------------------------------


def test_tables_load_after_what_they_need():
    graph = order.dependencies()
    place = {t: n for n, t in enumerate(order.load_order())}
    assert set(place) == set(CLEAN) | set(STAR)
    assert all(place[need] < place[t] for t, needs in graph.items() for need in needs)
    assert order.reset_order() == order.load_order()[::-1]
    assert order.dependents(["support_tickets"]) == ["support_tickets", "fact_subscription_usage"]
    assert set(order.dependents(["accounts"])) == set(CLEAN) | set(STAR) - {"dim_churn_reason"}
    with pytest.raises(ValueError, match="cycle"):
        order.load_order({"a": {"b"}, "b": {"a"}})


def test_refresh_loads_only_what_depends_on_a_changed_table(warehouse, raw):
    w = warehouse(**FIRST).load_all()
    kept = {t: w.star[t] for t in w.star}
    tickets = [*FIRST["support_tickets"], {"ticket_id": "T-9", "account_id": "A-1", "submitted_at": "2023-01-09"}]
    assert w.refresh({"support_tickets": raw("support_tickets", *tickets)}) == ["support_tickets", "fact_subscription_usage"]
    assert [t for t in kept if w.star[t] is not kept[t]] == ["fact_subscription_usage"]
    assert rows(w.star["fact_subscription_usage"]) == rows(warehouse(**changed(support_tickets=tickets)).star["fact_subscription_usage"])


def test_a_load_that_breaks_leaves_the_old_version_whole(spark, raw, tmp_path):
    versions = Versions(spark, str(tmp_path / "versions"))
    assert versions.current() is None
    with pytest.raises(ValueError, match="no version"):
        versions.read("star", "dim_account")

    def load(**tables):
        folder = versions.new()
        Warehouse(spark, {t: raw(t, *tables.get(t, [])) for t in CLEAN}, root=folder).load_all()
        versions.switch(folder)

    load(accounts=[{}])
    first = versions.current()
    with pytest.raises(quality.QualityError):  # the accounts are stored by then, the subscriptions are refused
        load(accounts=[{}, {"account_id": "A-2"}], subscriptions=[{"mrr_amount": "-1"}])
    assert versions.current() == first and versions.read("star", "dim_account").count() == 1
    load(accounts=[{}, {"account_id": "A-2"}])
    assert versions.read("star", "dim_account").count() == versions.read("clean", "accounts").count() == 2
    versions.clear()
    assert [p.name for p in (tmp_path / "versions").glob("version-*")] == [versions.current().rsplit("/", 1)[1]]
    with pytest.raises(ValueError, match="not a version"):
        versions.switch("/elsewhere")


# ---- calendar and history -------------------------------------------------------------


def test_a_calendar_grows_at_both_ends(warehouse):
    def subs(*starts):
        return warehouse(subscriptions=[{"subscription_id": f"S-{n}", "start_date": s} for n, s in enumerate(starts)])

    first = subs("2023-03-02", "2023-04-30").star["dim_date"]
    for starts in (("2023-01-01", "2023-06-15"), ("2023-03-02",), ("2023-04-02", "2023-05-02"), ("2022-12-31", "2023-04-01")):
        lo, hi = min("2023-03-02", *starts), max("2023-04-30", *starts)
        got = dims.build_dim_date(subs(*starts).clean["subscriptions"], first)
        assert rows(got) == rows(subs(lo, hi).star["dim_date"])
    nothing = warehouse().clean["subscriptions"]
    assert rows(dims.build_dim_date(nothing, first)) == rows(first)
    assert rows(dims.build_dim_date(subs("2023-03-02").clean["subscriptions"], dims.build_dim_date(nothing))) == rows(subs("2023-03-02").star["dim_date"])


def test_changes_of_known_accounts_are_recorded_once(warehouse):
    first = warehouse(accounts=[{}, {"account_id": "A-2", "industry": "Retail"}, {"account_id": "A-3"}])
    snapshot = first.star["dim_account"]
    now = warehouse(accounts=[{"account_id": "a-1", "account_name": "New"}, {"account_id": "A-2", "plan_tier": "Basic"}, {"account_id": "A-9"}])
    second = dims.account_changes(snapshot, now.clean["accounts"], "2024-01-01")
    day = dt.date(2024, 1, 1)
    assert rows(second) == [
        (1, "account_name", "Acme", "New", day), (2, "industry", "Retail", "Tech", day), (2, "initial_plan_tier", "Pro", "Basic", day),
    ]
    assert dims.account_changes(snapshot, now.clean["accounts"], "2024-02-01", second).count() == 0
    back = dims.account_changes(snapshot, first.clean["accounts"], "2024-03-01", second)
    assert rows(back.select("account_key", "old_value", "new_value")) == [(1, "New", "Acme"), (2, "Basic", "Pro"), (2, "Tech", "Retail")]
