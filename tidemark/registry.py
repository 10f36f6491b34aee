"""Named queries over the test tables of a folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import fold
from .operators import delta_calendar, lookup_key, quality, with_streak, with_surrogate_key
from .plans import analyses as a
from .plans import clean as c
from .plans import facts, states
from .plans import validation as v
from .plans.dims import account_changes, build_dim_date, load_dim_account
from .plans.reload import MonthlyUsage
from .plans.warehouse import Warehouse
from .schemas import CHURN_REASONS, CLEAN, LOW_ENGAGEMENT_DAYS, RAW_COLUMNS, STAR, UNKNOWN_REASON_KEY
from .sources import KeyRegistry, LatestRows, ingest_raw, land_raw, publish, read_raw, testtables

Query = Callable[[SparkSession, str], DataFrame]

_OPEN: dict[tuple[str, str, str], Warehouse] = {}

# Which rows a warehouse holds and what it does with rows that break a constraint. The plain
# rows break none; loads without a policy leave checking to the check queries.
KINDS = {"plain": (False, None), "damaged": (True, None), "quarantine": (True, "quarantine")}


def warehouse(spark: SparkSession, folder: str, kind: str = "plain") -> Warehouse:
    """The warehouse over ``folder``; its tables are stored once per application."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _OPEN:
        damaged, policy = KINDS[kind]
        _OPEN[key] = Warehouse(spark, testtables.RawTables(spark, folder, damaged), policy=policy)
        _OPEN[key].earlier = testtables.RawTables(spark, folder, earlier=True)
    return _OPEN[key]


def portable(df: DataFrame) -> DataFrame:
    """Values in types that every engine prints alike."""
    kinds = {T.DecimalType: "double", T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint",
             T.DateType: "string", T.TimestampNTZType: "string"}
    return df.select(
        *[F.col(f.name).cast(kinds.get(type(f.dataType), f.dataType)).alias(f.name) for f in df.schema.fields]
    )


def _land(table: str) -> Callable[[Warehouse], DataFrame]:
    """CSV round trip of a raw extract."""

    def run(w: Warehouse) -> DataFrame:
        path = f"{w.root}/landing/{table}"
        land_raw(w.raw[table], path)
        return read_raw(w.spark, table, path, breaks="escaped")

    return run


def _stored_twice(w: Warehouse) -> DataFrame:
    """A result written as Parquet and read back."""
    path = f"{w.root}/export/segment_revenue"
    publish(a.segment_revenue(w.star), path, "parquet")
    return w.spark.read.parquet(path)


def _published(w: Warehouse) -> DataFrame:
    """A result exported as one CSV file and read back."""
    path = f"{w.root}/export/net_impact"
    result = a.q3_net_impact(w.star)
    publish(result, path, "csv", single_file=True)
    return w.spark.read.schema(result.schema).option("header", True).csv(path)


def _repeated(typed: DataFrame, key: str, order: str) -> DataFrame:
    """Ids on several rows with the value kept for each: one pass and one shuffle."""
    grouped = typed.groupBy(fold(F.col(key)).alias("_match")).agg(
        F.max(F.struct(order, key)).alias("_kept"), F.count(F.lit(1)).alias("n_rows")
    )
    return grouped.where("n_rows > 1").select(f"_kept.{key}", f"_kept.{order}", "n_rows")


def _dedupe_usage(w: Warehouse) -> DataFrame:
    """Ids of usage rows repeated in the raw table, and the date text kept for each."""
    return _repeated(c.type_feature_usage(w.raw["feature_usage"]), "usage_id", "usage_date_text")


def _dedupe_churn(w: Warehouse) -> DataFrame:
    """Ids of churn events repeated in the raw table, and the date kept for each."""
    return _repeated(c.type_churn_events(w.raw["churn_events"]), "churn_event_id", "churn_date")


def _ingested(w: Warehouse) -> DataFrame:
    """Rows of each table after all five were landed as text and read back."""
    folder = f"{w.root}/extracts"
    for table in RAW_COLUMNS:
        land_raw(w.raw[table], f"{folder}/{table}")
    return quality.row_counts(ingest_raw(w.spark, folder, breaks="escaped"))


def _rejects(layer: str, table: str) -> Callable[[Warehouse], DataFrame]:
    """Rows a quarantine load kept apart, counted by the rules that they break."""

    def run(w: Warehouse) -> DataFrame:
        getattr(w, layer)[table]
        broken = F.array_join("violations", ", ")
        return w.rejected[layer, table].groupBy(broken.alias("violations")).agg(F.count(F.lit(1)).alias("n_rows"))

    return run


def _extended_accounts(w: Warehouse) -> DataFrame:
    """Account keys after a second load: half of the accounts first, then all; known accounts keep their keys."""
    accounts = w.clean["accounts"]
    first = load_dim_account(accounts.where("CAST(substr(account_id, 3) AS BIGINT) % 2 = 0"))
    return load_dim_account(accounts, first).select("account_key", "account_id")


def _scratch(w: Warehouse, name: str) -> str:
    """A folder of one run's own under the warehouse."""
    return f"{w.root}/{name}-{uuid.uuid4().hex[:12]}"


def _earlier(w: Warehouse) -> dict[str, DataFrame]:
    """Clean tables of the extracts that came before this warehouse's."""
    return {t: c.CLEANERS[t](w.earlier[t]) for t in testtables.EARLIER}


def _second_usage(w: Warehouse) -> DataFrame:
    """The usage fact after a load of earlier extracts and one of the present ones."""
    store, before = MonthlyUsage(w.spark, _scratch(w, "monthly")), _earlier(w)
    store.load(before["feature_usage"], before["support_tickets"], w.bridge())
    store.load(w.clean["feature_usage"], w.clean["support_tickets"], w.bridge())
    return store.fact()


def _extended_events(w: Warehouse) -> DataFrame:
    """Churn events whose keys come from a registry: half of them first, then all, then all again."""
    keys, events = KeyRegistry(w.spark, _scratch(w, "keys")), w.clean["churn_events"]
    for part in (events.where("CAST(substr(churn_event_id, 3) AS BIGINT) % 2 = 0"), events, events):
        fact = facts.build_fact_churn_events(part, w.star["dim_account"], w.star["dim_churn_reason"], keys)
    return fact


def _second_dedupe(w: Warehouse) -> DataFrame:
    """Latest churn events after two extracts, which hold the copies of an event in either order."""
    typed = c.type_churn_events(w.raw["churn_events"])
    latest = LatestRows(w.spark, _scratch(w, "latest"), typed.schema, "churn_event_id", [F.col("churn_date").desc_nulls_last()], 16)
    odd = F.coalesce(F.day("churn_date") % 2 == 1, F.lit(True))
    for part in (typed.where(odd), typed.where(~odd)):
        latest.merge(part)
    return latest.rows()


def _halves(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    first = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    return df.where(first), df.where(~first)


def _merged_rollups(w: Warehouse) -> DataFrame:
    """Usage months from the states of two halves of the usage rows."""
    parts = [states.usage_state(h) for h in _halves(w.clean["feature_usage"], "usage_id")]
    return states.finish_usage(states.merge_usage(*parts))


def _merged_tickets(w: Warehouse) -> DataFrame:
    """Ticket months from the states of two halves of the tickets."""
    parts = [facts.ticket_state(h) for h in _halves(w.clean["support_tickets"], "ticket_id")]
    return facts.finish_tickets(states.merge_tickets(*parts))


def _streaks(w: Warehouse) -> DataFrame:
    """Months in a row with low engagement."""
    months = facts.monthly_feature(w.clean["feature_usage"]).select("subscription_id", "date_key", "active_days")
    low = F.col("active_days") < LOW_ENGAGEMENT_DAYS
    return with_streak(months, "low_engagement_streak", low, "subscription_id", "date_key")


def _calendar_delta(w: Warehouse) -> DataFrame:
    """Change in active days against the calendar month before."""
    months = facts.monthly_feature(w.clean["feature_usage"])
    delta = delta_calendar(F.col("active_days"), "subscription_id", "date_key")
    return months.select("subscription_id", "date_key", "active_days", delta.alias("mom_active_days_delta"))


def _extended_calendar(w: Warehouse) -> DataFrame:
    """The calendar of subscriptions that started in 1998, extended for all of them."""
    subscriptions = w.clean["subscriptions"]
    return build_dim_date(subscriptions, build_dim_date(subscriptions.where("year(start_date) = 1998")))


def _account_changes(w: Warehouse) -> DataFrame:
    """What changed of known accounts, recorded by a second load; a third load adds nothing."""
    accounts = w.clean["accounts"]
    snapshot = load_dim_account(_earlier(w)["accounts"])
    second = account_changes(snapshot, accounts, "2001-12-01")
    return second.unionByName(account_changes(snapshot, accounts, "2002-01-01", second))


def _reason_usage(w: Warehouse) -> DataFrame:
    """The reason dimension with the number of events on each reason."""
    used = w.star["fact_churn_events"].groupBy("churn_reason_key").agg(F.count(F.lit(1)).alias("_n"))
    return (
        w.star["dim_churn_reason"]
        .join(used, "churn_reason_key", "left")
        .select("churn_reason_key", "reason_code", "reason_label", "reason_category",
                F.coalesce("_n", F.lit(0)).alias("churn_events"))
    )


def _ticket_keys(w: Warehouse) -> DataFrame:
    """Support tickets numbered densely by id."""
    return with_surrogate_key(w.clean["support_tickets"].select("ticket_id"), "ticket_key", [F.col("ticket_id")])


def _sentinel(w: Warehouse) -> DataFrame:
    """Reason key of every clean churn event; unmapped codes get the unknown key."""
    events = w.clean["churn_events"].select("churn_event_id", "reason_code")
    reasons = F.broadcast(w.star["dim_churn_reason"].select("reason_code", "churn_reason_key"))  # six fixed rows
    return lookup_key(events, reasons, "reason_code", "churn_reason_key", "left", UNKNOWN_REASON_KEY)


def _unmapped_reasons(w: Warehouse) -> DataFrame:
    """Reason codes no reason row covers, with their event counts."""
    known = [code for _, code, _, _ in CHURN_REASONS]
    return quality.check_domain(w.clean["churn_events"], "reason_code", known)


def _trend(column: str) -> Callable[[Warehouse], DataFrame]:
    def run(w: Warehouse) -> DataFrame:
        trend = facts.with_engagement_trend(facts.monthly_feature(w.clean["feature_usage"]))
        return trend.select("subscription_id", "date_key", "active_days", column)

    return run


def _table(layer: str, name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: getattr(w, layer)[name]


def _jobs() -> dict[str, Callable[[Warehouse], DataFrame]]:
    on_star = {
        "q1_churned_mrr": a.q1_churned_mrr,
        "q2_churn_rate": a.q2_churn_rate,
        "q3_net_impact": a.q3_net_impact,
        "q31_industry": a.q31_industry,
        "q4_high_value": a.q4_high_value,
        "q5_profile": a.q5_profile,
        "rate_vs_median": a.rate_vs_median,
        "refund_share": a.refund_share,
        "segments_above_benchmark": a.segments_above_benchmark,
        "zero_churn_segments": a.zero_churn_segments,
        "topk_tier_mix": a.topk_tier_mix,
        "leader_gap": a.leader_gap,
        "arr_by_segment": a.arr_by_segment,
        "concurrent_subscriptions": a.concurrent_subscriptions,
        "refunds_by_reason_category": a.refunds_by_reason_category,
        "start_cohorts": a.start_cohorts,
        "ntile_quartile": a.account_quartiles,
        "rank_segments": a.industry_country_rank,
        "window_over_aggregate": a.industry_mrr_share,
        "check_star": v.star_violations,
    }
    on_clean = {
        "check_not_null": v.not_null_violations,
        "check_expr": v.check_violations,
        "check_domain": v.domain_violations,
        "check_length": v.length_violations,
        "grain_check": v.grain_check,
        "row_counts": v.clean_row_counts,
        "distinct_subscribers": v.distinct_subscribers,
        "accounts_without_subscription": v.accounts_without_subscription,
    }
    jobs: dict[str, Callable[[Warehouse], DataFrame]] = {f"land_{t}": _land(t) for t in RAW_COLUMNS}
    jobs |= {f"clean_{t}": (lambda w, t=t: c.CLEANERS[t](w.raw[t])) for t in CLEAN}
    jobs |= {t: _table("star", t) for t in STAR if t != "dim_churn_reason"}
    jobs |= {name: (lambda w, f=f: f(w.star)) for name, f in on_star.items()}
    jobs |= {name: (lambda w, f=f: f(w.clean)) for name, f in on_clean.items()}
    jobs |= {
        "dedupe_usage": _dedupe_usage,
        "dedupe_churn": _dedupe_churn,
        "dim_churn_reason": _reason_usage,
        "surrogate_key_dense": _ticket_keys,
        "key_lookup_sentinel": _sentinel,
        "unmapped_reasons": _unmapped_reasons,
        "monthly_feature": lambda w: facts.monthly_feature(w.clean["feature_usage"]),
        "ticket_monthly": lambda w: facts.ticket_monthly(w.clean["support_tickets"]),
        "mom_delta": _trend("mom_active_days_delta"),
        "running_low_months": _trend("consecutive_low_engagement_months"),
        "check_pk": lambda w: v.key_violations(CLEAN, w.clean),
        "check_fk_clean": lambda w: v.reference_violations(CLEAN, w.clean),
        "check_fk_star": lambda w: v.reference_violations(STAR, w.star),
        "unknown_tiers": lambda w: v.unknown_tiers(w.raw),
        "dim_counts": lambda w: v.dim_counts(w.clean, w.star),
        "roundtrip_parquet": _stored_twice,
        "publish_csv": _published,
        "ingest_raw": _ingested,
        "dim_account_extended": _extended_accounts,
        "fact_subscription_usage_second_load": _second_usage,
        "fact_churn_events_extended": _extended_events,
        "dedupe_second_load": _second_dedupe,
        "rollups_merged": _merged_rollups,
        "ticket_rollups_merged": _merged_tickets,
        "low_engagement_streak": _streaks,
        "mom_delta_calendar": _calendar_delta,
        "dim_date_extended": _extended_calendar,
        "account_changes": _account_changes,
        "load_order": lambda w: v.load_report({**{t: w.clean[t] for t in w.clean}, **{t: w.star[t] for t in w.star}}),
        "reset_order": lambda w: v.load_report({t: w.star[t] for t in w.star}, reset=True),
    }
    jobs |= {f"{name}_paying": (lambda w, f=f: f(a.paying(w.star))) for name, f in on_star.items() if re.match(r"q[1-5]_", name)}
    return jobs


# Queries about what is wrong with the rows: they run over the damaged ones.
ON_DAMAGED = (
    "check_pk", "check_fk_clean", "check_fk_star", "check_not_null", "check_expr", "check_domain", "check_length",
    "check_star", "unknown_tiers", "accounts_without_subscription", "zero_churn_segments", "concurrent_subscriptions",
)


def _quarantined() -> dict[str, Callable[[Warehouse], DataFrame]]:
    jobs = {f"rejected_{t}": _rejects("clean", t) for t in CLEAN}
    return jobs | {f"rejected_{t}": _rejects("star", t) for t in ("fact_churn_events", "fact_subscription_usage")} | {
        "kept_usage_trend": lambda w: w.star["fact_subscription_usage"].select(
            "date_key", "subscription_key", "active_days", "mom_active_days_delta", "consecutive_low_engagement_months"
        ),
    }


def queries() -> dict[str, Query]:
    def registered(job: Callable[[Warehouse], DataFrame], kind: str) -> Query:
        return lambda spark, folder: portable(job(warehouse(spark, folder, kind)))

    plain = {n: registered(job, "damaged" if n in ON_DAMAGED else "plain") for n, job in _jobs().items()}
    return plain | {n: registered(job, "quarantine") for n, job in _quarantined().items()}
