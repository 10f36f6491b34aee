"""Each oracle is a final SELECT over common table expressions: raw rows, clean
rows, star tables. Ratios are computed on whole numbers, so they do not depend
on how an engine rounds doubles."""

from __future__ import annotations

import re

from tidemark.sources.testtables import DAMAGED_SQL, EARLIER_SQL, RAW_SQL, SOURCES

from . import rules as r

# Churn reasons.
CHURN_REASONS = (
    (1, "unknown", "Unknown/Not Captured", None),
    (2, "pricing", "Pricing / Cost Concerns", "Commercial"),
    (3, "budget", "Budget Constraints", "Commercial"),
    (4, "competitor", "Moved to Competitor", "Commercial"),
    (5, "support", "Poor Support Experience", "Product & Experience"),
    (6, "features", "Missing Features", "Product & Experience"),
)


def ratio(num: str, den: str, digits: int = 2) -> str:
    """num / den, whole numbers, halves away from zero."""
    scale = 10**digits
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign(({num})::HUGEINT) * "
        f"((2 * {scale} * abs(({num})::HUGEINT) + ({den})::HUGEINT) // (2 * ({den})::HUGEINT)) / {scale}.0 END)::DOUBLE"
    )


def money_pct(num: str, den: str) -> str:
    return ratio(f"({num}) * 10000", f"({den}) * 100")


# ---- common table expressions -------------------------------------------------

CTES: dict[str, str] = {f"raw_{t}": text.format(**{s: s for s in SOURCES}) for t, text in RAW_SQL.items()}


def _uint(c: str, default: int) -> str:
    return (
        f"CASE WHEN coalesce(trim({c}), '') = '' THEN {default} "
        f"WHEN regexp_full_match(trim({c}), '[0-9]+') THEN try_cast(trim({c}) AS INTEGER) END AS {c}"
    )


def _money(c: str) -> str:
    return (
        f"CASE WHEN coalesce(trim({c}), '') = '' THEN 0::DECIMAL(10,2) "
        f"ELSE try_cast(trim({c}) AS DECIMAL(10,2)) END AS {c}"
    )


def _flag(c: str) -> str:
    return f"lower(trim({c})) = 'true' AS {c}"


def _date(c: str, fmt: str) -> str:
    return f"try_strptime(nullif(trim({c}), ''), '{fmt}')::DATE AS {c}"


def _trim(c: str) -> str:
    return f"trim({c}) AS {c}"


_TIERS = "'basic': 'Basic', 'pro': 'Pro', 'enterprise': 'Enterprise'"
_TIER = f"MAP {{{_TIERS}}}[lower(trim(plan_tier))] AS plan_tier"


def _select(columns: list[str], source: str) -> str:
    return "SELECT " + ",\n  ".join(columns) + f"\nFROM {source}"


CTES["accounts"] = _select(
    [
        _trim("account_id"), _trim("account_name"), _trim("industry"), "upper(trim(country)) AS country",
        _date("signup_date", "%d/%m/%Y"),
        "CASE WHEN lower(trim(referral_source)) IN ('organic', 'ads', 'event', 'partner', 'other') "
        "THEN lower(trim(referral_source)) ELSE nullif(trim(referral_source), '') END AS referral_source",
        _TIER, _uint("seats", 1), _flag("is_trial"), _flag("churn_flag"),
    ],
    "raw_accounts",
)
CTES["subscriptions"] = _select(
    [
        _trim("subscription_id"), _trim("account_id"), _date("start_date", "%Y-%m-%d"), _date("end_date", "%Y-%m-%d"),
        _TIER, _uint("seats", 1), _money("mrr_amount"), _flag("is_trial"), _flag("upgrade_flag"),
        _flag("downgrade_flag"), _flag("churn_flag"), "lower(trim(billing_frequency)) AS billing_frequency",
        _flag("auto_renew_flag"),
    ],
    "raw_subscriptions",
)
CTES["churn_events_typed"] = _select(
    [
        _trim("churn_event_id"), _trim("account_id"), _date("churn_date", "%d/%m/%Y"),
        "nullif(trim(reason_code), '') AS reason_code", _money("refund_amount_usd"),
        _flag("preceding_upgrade_flag"), _flag("preceding_downgrade_flag"), _flag("is_reactivation"),
        "nullif(trim(feedback_text), '') AS feedback_text",
    ],
    "raw_churn_events",
)
CTES["churn_events"] = """
SELECT * EXCLUDE (row_num) FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(churn_event_id) ORDER BY churn_date DESC NULLS LAST,
    account_id NULLS FIRST, reason_code NULLS FIRST, refund_amount_usd NULLS FIRST,
    preceding_upgrade_flag NULLS FIRST, preceding_downgrade_flag NULLS FIRST, is_reactivation NULLS FIRST,
    feedback_text NULLS FIRST) AS row_num
  FROM churn_events_typed) AS t
WHERE row_num = 1"""
CTES["feature_usage_typed"] = _select(
    [
        _trim("usage_id"), _trim("subscription_id"), _date("usage_date", "%Y-%m-%d"), _trim("feature_name"),
        _uint("usage_count", 0), _uint("usage_duration_secs", 0), _uint("error_count", 0), _flag("is_beta_feature"),
        "usage_date AS usage_date_text",
    ],
    "raw_feature_usage AS r",
).replace("nullif(trim(usage_date)", "nullif(trim(r.usage_date)").replace(
    "usage_date AS usage_date_text", "r.usage_date AS usage_date_text"
)
CTES["feature_usage"] = """
SELECT * EXCLUDE (row_num, usage_date_text) FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(usage_id) ORDER BY usage_date_text DESC NULLS LAST,
    subscription_id NULLS FIRST, feature_name NULLS FIRST, usage_count NULLS FIRST,
    usage_duration_secs NULLS FIRST, error_count NULLS FIRST, is_beta_feature NULLS FIRST) AS row_num
  FROM feature_usage_typed) AS t
WHERE row_num = 1"""
CTES["support_tickets"] = _select(
    [
        _trim("ticket_id"), _trim("account_id"),
        "try_strptime(nullif(trim(submitted_at), ''), '%Y-%m-%d') AS submitted_at",
        "try_strptime(nullif(trim(closed_at), ''), '%Y-%m-%d %H:%M:%S') AS closed_at",
        "CASE WHEN lower(trim(priority)) IN ('medium', 'high', 'urgent') THEN lower(trim(priority)) ELSE 'low' END "
        "AS priority",
        _uint("first_response_time_minutes", 0),
        "round(try_cast(nullif(trim(satisfaction_score), '') AS DECIMAL(3,1)))::INTEGER AS satisfaction_score",
        _flag("escalation_flag"),
    ],
    "raw_support_tickets",
)

CTES["dim_date"] = """
SELECT (year(m) * 100 + month(m))::BIGINT AS date_key, m AS month_start, month(m)::BIGINT AS month_number,
  monthname(m) AS month_name, quarter(m)::BIGINT AS quarter, year(m)::BIGINT AS year, m = hi AS is_current_month
FROM (
  SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS m, hi::DATE AS hi
  FROM (SELECT date_trunc('month', min(start_date))::TIMESTAMP AS lo,
          date_trunc('month', greatest(coalesce(max(end_date), max(start_date)), max(start_date)))::TIMESTAMP AS hi
        FROM subscriptions) AS b) AS s"""
CTES["dim_account"] = """
SELECT row_number() OVER (ORDER BY account_id NULLS FIRST) AS account_key, account_id, account_name, industry, country,
  plan_tier AS initial_plan_tier
FROM accounts"""
CTES["keyed_subscriptions"] = "SELECT row_number() OVER (ORDER BY subscription_id NULLS FIRST) AS subscription_key, * FROM subscriptions"
CTES["dim_subscription"] = """
SELECT subscription_key, subscription_id, plan_tier, seats::BIGINT AS seats, is_trial, billing_frequency
FROM keyed_subscriptions"""
CTES["dim_churn_reason"] = "SELECT * FROM (VALUES {}) AS r(churn_reason_key, reason_code, reason_label, reason_category)".format(
    ", ".join(
        "({}, '{}', '{}', {})".format(k, code, label, f"'{cat}'" if cat else "NULL") for k, code, label, cat in CHURN_REASONS
    )
)
CTES["fact_subscriptions"] = """
SELECT s.subscription_key, a.account_key, (year(s.start_date) * 100 + month(s.start_date))::BIGINT AS start_date_key,
  (year(s.end_date) * 100 + month(s.end_date))::BIGINT AS end_date_key, s.mrr_amount AS mrr,
  s.churn_flag::BIGINT AS is_churned, s.upgrade_flag::BIGINT AS is_upgraded,
  s.downgrade_flag::BIGINT AS is_downgraded, s.auto_renew_flag::BIGINT AS auto_renew_flag
FROM keyed_subscriptions AS s
JOIN dim_account AS a ON lower(s.account_id) = lower(a.account_id)"""
CTES["fact_churn_events"] = """
SELECT row_number() OVER (ORDER BY e.churn_event_id NULLS FIRST) AS churn_event_key, e.churn_event_id, a.account_key,
  (year(e.churn_date) * 100 + month(e.churn_date))::BIGINT AS churn_date_key,
  coalesce(r.churn_reason_key, 1)::BIGINT AS churn_reason_key, e.refund_amount_usd,
  e.is_reactivation::BIGINT AS is_reactivation, e.preceding_upgrade_flag::BIGINT AS preceding_upgrade_flag,
  e.preceding_downgrade_flag::BIGINT AS preceding_downgrade_flag
FROM churn_events AS e
JOIN dim_account AS a ON lower(e.account_id) = lower(a.account_id)
LEFT JOIN dim_churn_reason AS r ON lower(e.reason_code) = lower(r.reason_code)"""
CTES["monthly_feature"] = f"""
SELECT lower(subscription_id) AS subscription_id, (year(usage_date) * 100 + month(usage_date))::BIGINT AS date_key,
  count(DISTINCT usage_date) AS active_days, count(DISTINCT lower(feature_name)) AS feature_adoption_count,
  sum(usage_count)::BIGINT AS total_usage_count, sum(usage_duration_secs)::BIGINT AS total_usage_duration_secs,
  {ratio("sum(usage_duration_secs)", "count(usage_duration_secs)")} AS avg_usage_duration_secs,
  sum(error_count)::BIGINT AS total_error_count,
  count(*) FILTER (WHERE is_beta_feature) AS beta_feature_usage_count
FROM feature_usage GROUP BY 1, 2"""
CTES["ticket_monthly"] = f"""
SELECT lower(account_id) AS account_id, (year(submitted_at) * 100 + month(submitted_at))::BIGINT AS date_key,
  count(*) AS support_tickets_opened,
  count(*) FILTER (WHERE closed_at IS NULL OR closed_at > last_day(submitted_at)::TIMESTAMP)
    AS support_tickets_unresolved_eom,
  {ratio("sum(datesub('hour', submitted_at, closed_at))", "count(closed_at)")} AS avg_resolution_hours,
  {ratio("sum(satisfaction_score)", "count(satisfaction_score)")} AS avg_satisfaction_score
FROM support_tickets GROUP BY 1, 2"""
CTES["fact_subscription_usage"] = f"""
SELECT m.date_key, a.account_key, s.subscription_key, m.active_days, m.feature_adoption_count, m.total_usage_count,
  m.total_usage_duration_secs, m.avg_usage_duration_secs, m.total_error_count, m.beta_feature_usage_count,
  CASE WHEN m.total_usage_count > 0 THEN {ratio("m.total_error_count", "m.total_usage_count", 4)} END AS error_rate,
  m.active_days - lag(m.active_days) OVER w AS mom_active_days_delta,
  count(*) FILTER (WHERE m.active_days < 5) OVER (w ROWS UNBOUNDED PRECEDING) AS consecutive_low_engagement_months,
  t.support_tickets_opened, t.support_tickets_unresolved_eom, t.avg_resolution_hours, t.avg_satisfaction_score,
  s.churn_flag::BIGINT AS is_churned
FROM monthly_feature AS m
JOIN keyed_subscriptions AS s ON m.subscription_id = lower(s.subscription_id)
JOIN dim_account AS a ON lower(s.account_id) = lower(a.account_id)
LEFT JOIN ticket_monthly AS t ON lower(s.account_id) = t.account_id AND m.date_key = t.date_key
WINDOW w AS (PARTITION BY m.subscription_id ORDER BY m.date_key)"""

# ---- analyses -----------------------------------------------------------------

_CHURNED = "coalesce(sum(f.mrr) FILTER (WHERE f.is_churned = 1), 0)"
CTES["segments"] = f"""
SELECT min(a.industry) AS industry, a.country, d.plan_tier, {_CHURNED} AS churned, sum(f.mrr) AS total,
  sum(f.is_churned) AS churned_rows
FROM fact_subscriptions AS f
JOIN dim_account AS a ON f.account_key = a.account_key
JOIN dim_subscription AS d ON f.subscription_key = d.subscription_key
GROUP BY lower(a.industry), a.country, d.plan_tier"""
CTES["q1"] = """
SELECT industry, country, plan_tier, churned::DOUBLE AS churned_mrr,
  rank() OVER (ORDER BY churned DESC) AS revenue_loss_rank
FROM segments WHERE churned_rows > 0"""
CTES["q2"] = f"""
SELECT industry, country, plan_tier, churned::DOUBLE AS churned_mrr, total::DOUBLE AS total_mrr,
  {money_pct("churned", "total")} AS churn_rate,
  rank() OVER (ORDER BY CASE WHEN total = 0 THEN NULL ELSE (churned * 100)::BIGINT::DOUBLE / (total * 100)::BIGINT END
    DESC NULLS LAST) AS churn_rate_rank
FROM segments"""
CTES["q3"] = """
SELECT industry, country, churned::DOUBLE AS churned_mrr, refunds::DOUBLE AS total_refunds,
  (churned - refunds)::DOUBLE AS net_revenue_impact, rank() OVER (ORDER BY churned - refunds DESC) AS net_impact_rank
FROM (
  SELECT min(a.industry) AS industry, a.country, sum(c.churned) AS churned, sum(coalesce(r.refunds, 0)) AS refunds
  FROM (SELECT account_key, sum(mrr) AS churned FROM fact_subscriptions WHERE is_churned = 1 GROUP BY 1) AS c
  LEFT JOIN (SELECT account_key, sum(refund_amount_usd) AS refunds FROM fact_churn_events GROUP BY 1) AS r
    ON c.account_key = r.account_key
  JOIN dim_account AS a ON c.account_key = a.account_key
  GROUP BY lower(a.industry), a.country) AS t"""
CTES["quartiles"] = f"""
SELECT account_key, churned, total, ntile(4) OVER (ORDER BY total DESC, account_key) AS quartile
FROM (SELECT account_key, {_CHURNED} AS churned, sum(mrr) AS total FROM fact_subscriptions AS f GROUP BY 1) AS t"""
CTES["q4"] = f"""
SELECT industry, initial_plan_tier, churned::DOUBLE AS churned_mrr, total::DOUBLE AS total_mrr,
  {money_pct("churned", "total")} AS segment_churn_rate,
  {money_pct("all_churned", "all_total")} AS overall_churn_rate
FROM (
  SELECT min(a.industry) AS industry, a.initial_plan_tier, sum(q.churned) AS churned, sum(q.total) AS total,
    sum(sum(q.churned)) OVER () AS all_churned, sum(sum(q.total)) OVER () AS all_total
  FROM quartiles AS q JOIN dim_account AS a ON q.account_key = a.account_key
  WHERE q.quartile = 1
  GROUP BY lower(a.industry), a.initial_plan_tier) AS t"""

# measure, output stem, hundredths of the measure
_PROFILE = [
    ("active_days", "active_days", "u.active_days * 100"),
    ("feature_adoption_count", "feature_count", "u.feature_adoption_count * 100"),
    ("consecutive_low_engagement_months", "low_engagement", "u.consecutive_low_engagement_months * 100"),
    ("support_tickets_opened", "support_tickets", "u.support_tickets_opened * 100"),
    ("avg_satisfaction_score", "satisfaction", "round(u.avg_satisfaction_score * 100)"),
]


def _profile() -> str:
    sums, out = [], []
    for i, (_, stem, value) in enumerate(_PROFILE):
        for side in (1, 0):
            only = f"FILTER (WHERE u.is_churned = {side})"
            sums.append(f"coalesce(sum(({value})::BIGINT) {only}, 0) AS s{i}{side}")
            sums.append(f"count({value}) {only} AS n{i}{side}")
        delta = "active_days_delta" if stem == "active_days" else f"avg_{stem}_delta"
        out += [
            f"{ratio(f's{i}1', f'n{i}1 * 100')} AS avg_{stem}_churned",
            f"{ratio(f's{i}0', f'n{i}0 * 100')} AS avg_{stem}_retained",
            f"{ratio(f's{i}1 * n{i}0 - s{i}0 * n{i}1', f'n{i}1 * n{i}0 * 100')} AS {delta}",
        ]
    return (
        "SELECT industry, plan_tier, " + ",\n  ".join(out) + "\nFROM (SELECT min(a.industry) AS industry, d.plan_tier, "
        + ",\n  ".join(sums)
        + """
  FROM fact_subscription_usage AS u
  JOIN dim_account AS a ON u.account_key = a.account_key
  JOIN dim_subscription AS d ON u.subscription_key = d.subscription_key
  GROUP BY lower(a.industry), d.plan_tier) AS t"""
    )


# ---- checks -------------------------------------------------------------------


_TEXT_KEYS = {"account_id", "subscription_id", "usage_id", "churn_event_id", "ticket_id", "reason_code"}


def _cmp(c: str) -> str:
    return f"lower({c})" if c in _TEXT_KEYS else c


def _at(alias: str, c: str) -> str:
    return f"lower({alias}.{c})" if c in _TEXT_KEYS else f"{alias}.{c}"


def _rules(tables: tuple, pick) -> str:
    parts = [
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE NOT coalesce({predicate}, true)) AS violations, "
        f"'{table}' AS table_name FROM {table}"
        for table in tables
        for rule, predicate in pick(table).items()
    ]
    return "\nUNION ALL\n".join(parts)


def _groups(table: str, key: str, source: str) -> str:
    """Values of a key on several rows, or incomplete, with their rows."""
    columns = key.split()
    shown = ", ".join(f"{_cmp(c)} AS {c}" for c in columns)
    missing = " OR ".join(f"bool_or({c} IS NULL)" for c in columns)
    return f"SELECT {shown}, count(*) AS n FROM {source} GROUP BY {', '.join(map(_cmp, columns))} HAVING count(*) > 1 OR {missing}"


def _keys(tables: tuple) -> str:
    parts = [
        f"SELECT '{' + '.join(key.split())} unique' AS rule, coalesce(sum(n), 0)::BIGINT AS violations, "
        f"'{table}' AS table_name FROM ({_groups(table, key, table)}) AS t"
        for table in tables
        for key in r.KEYS[table]
    ]
    return "\nUNION ALL\n".join(parts)


def _references(tables: tuple) -> str:
    parts = [
        f"SELECT '{column} in {parent}' AS rule, count(*) AS violations, '{table}' AS table_name FROM {table} AS c "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE {_at('p', own)} = {_at('c', column)})"
        for table in tables
        for column, parent, own in r.REFERENCES.get(table, [])
    ]
    return "\nUNION ALL\n".join(parts)


def _tagged(table: str, source: str) -> str:
    """All rows of ``source`` with the names of the rules they break, joined; parents hold accepted rows only."""
    failed = [f"CASE WHEN NOT coalesce({p}, true) THEN '{name}' END" for name, p in r.row_rules(table).items()]
    for key in r.KEYS[table]:
        same = " AND ".join(f"g.{c} IS NOT DISTINCT FROM {_at('s', c)}" for c in key.split())
        failed.append(
            f"CASE WHEN EXISTS (SELECT 1 FROM ({_groups(table, key, source)}) AS g WHERE {same}) "
            f"THEN '{' + '.join(key.split())} unique' END"
        )
    for column, parent, own in r.REFERENCES.get(table, []):
        known = f"SELECT {_cmp(own)} FROM {parent}"
        failed.append(
            f"CASE WHEN {column} IS NOT NULL AND {_cmp(column)} NOT IN ({known}) "
            f"THEN '{column} in {parent}' END"
        )
    return f"SELECT *, concat_ws(', ', {', '.join(failed)}) AS violations FROM {source} AS s"


# ---- final selects ------------------------------------------------------------

_DAY, _TIME, _INT, _NUM = "VARCHAR", "VARCHAR", "BIGINT", "DOUBLE"
_CASTS = {
    "accounts": {"signup_date": _DAY, "seats": _INT},
    "subscriptions": {"start_date": _DAY, "end_date": _DAY, "seats": _INT, "mrr_amount": _NUM},
    "churn_events": {"churn_date": _DAY, "refund_amount_usd": _NUM},
    "feature_usage": {"usage_date": _DAY, "usage_count": _INT, "usage_duration_secs": _INT, "error_count": _INT},
    "support_tickets": {
        "submitted_at": _TIME, "closed_at": _TIME, "first_response_time_minutes": _INT, "satisfaction_score": _INT,
    },
    "dim_date": {"month_start": _DAY},
    "fact_subscriptions": {"mrr": _NUM},
    "fact_churn_events": {"refund_amount_usd": _NUM},
}


def _whole(table: str) -> str:
    casts = ", ".join(f"{c}::{kind} AS {c}" for c, kind in _CASTS.get(table, {}).items())
    return f"SELECT * REPLACE ({casts}) FROM {table}" if casts else f"SELECT * FROM {table}"


_TREND = """
SELECT subscription_id, date_key, active_days, active_days - lag(active_days) OVER w AS mom_active_days_delta,
  count(*) FILTER (WHERE active_days < 5) OVER (w ROWS UNBOUNDED PRECEDING) AS consecutive_low_engagement_months
FROM monthly_feature WINDOW w AS (PARTITION BY subscription_id ORDER BY date_key)"""

FINALS: dict[str, str] = {f"land_{t}": f"SELECT * FROM raw_{t}" for t in RAW_SQL}
FINALS |= {f"clean_{t}": _whole(t) for t in r.CLEAN_TABLES}
FINALS |= {t: _whole(t) for t in r.STAR_TABLES if t != "dim_churn_reason"}
FINALS |= {
    "dedupe_usage": """
SELECT usage_id, usage_date_text, n_rows FROM (
  SELECT usage_id, usage_date_text, count(*) OVER (PARTITION BY lower(usage_id)) AS n_rows,
    row_number() OVER (PARTITION BY lower(usage_id) ORDER BY usage_date_text DESC NULLS LAST) AS row_num
  FROM feature_usage_typed) AS t
WHERE row_num = 1 AND n_rows > 1""",
    "dedupe_churn": """
SELECT churn_event_id, churn_date::VARCHAR AS churn_date, n_rows FROM (
  SELECT churn_event_id, churn_date, count(*) OVER (PARTITION BY lower(churn_event_id)) AS n_rows,
    row_number() OVER (PARTITION BY lower(churn_event_id) ORDER BY churn_date DESC NULLS LAST) AS row_num
  FROM churn_events_typed) AS t
WHERE row_num = 1 AND n_rows > 1""",
    "dim_churn_reason": """
SELECT r.churn_reason_key::BIGINT AS churn_reason_key, r.reason_code, r.reason_label, r.reason_category,
  count(f.churn_event_key) AS churn_events
FROM dim_churn_reason AS r LEFT JOIN fact_churn_events AS f ON r.churn_reason_key = f.churn_reason_key
GROUP BY ALL""",
    "surrogate_key_dense": """
SELECT row_number() OVER (ORDER BY ticket_id) AS ticket_key, ticket_id FROM support_tickets""",
    "key_lookup_sentinel": """
SELECT e.churn_event_id, e.reason_code, coalesce(r.churn_reason_key, 1)::BIGINT AS churn_reason_key
FROM churn_events AS e LEFT JOIN dim_churn_reason AS r ON lower(e.reason_code) = lower(r.reason_code)""",
    "unmapped_reasons": """
SELECT reason_code, count(*) AS n_rows FROM churn_events
WHERE lower(trim(reason_code)) NOT IN (SELECT reason_code FROM dim_churn_reason) GROUP BY 1""",
    "monthly_feature": "SELECT * FROM monthly_feature",
    "ticket_monthly": "SELECT * FROM ticket_monthly",
    "mom_delta": f"SELECT * EXCLUDE (consecutive_low_engagement_months) FROM ({_TREND}) AS t",
    "running_low_months": f"SELECT * EXCLUDE (mom_active_days_delta) FROM ({_TREND}) AS t",
    "q1_churned_mrr": "SELECT * FROM q1 ORDER BY churned_mrr DESC",
    "q2_churn_rate": "SELECT * FROM q2 ORDER BY churn_rate_rank",
    "q3_net_impact": "SELECT * FROM q3 ORDER BY net_revenue_impact DESC",
    "q31_industry": """
SELECT min(a.industry) AS industry, sum(f.mrr)::DOUBLE AS churned_mrr
FROM fact_subscriptions AS f JOIN dim_account AS a ON f.account_key = a.account_key
WHERE f.is_churned = 1 GROUP BY lower(a.industry) ORDER BY churned_mrr DESC""",
    "q4_high_value": "SELECT * FROM q4 ORDER BY segment_churn_rate DESC",
    "q5_profile": _profile() + " ORDER BY active_days_delta NULLS FIRST",
    "ntile_quartile": """
SELECT account_key, churned::DOUBLE AS churned_mrr, total::DOUBLE AS total_mrr, quartile AS account_quartile
FROM quartiles""",
    "rate_vs_median": f"""
SELECT industry, country, plan_tier, churn_rate, median_rate,
  {ratio("round(churn_rate * 1000)", "round(median_rate * 1000)")} AS times_median
FROM (SELECT *, round(median(round(churn_rate * 100)) OVER () * 10) / 1000.0 AS median_rate FROM q2) AS t""",
    "zero_churn_segments": """
SELECT count(*) FILTER (WHERE churn_rate = 0) AS zero_churn_segments, count(*) AS segments FROM q2""",
    "topk_tier_mix": "SELECT plan_tier, count(*) AS segments FROM q1 WHERE revenue_loss_rank <= 10 GROUP BY 1",
    "leader_gap": """
SELECT industry, country, plan_tier, churned::DOUBLE AS churned_mrr, rnk AS revenue_loss_rank,
  (churned - next)::DOUBLE AS lead_over_next
FROM (SELECT *, rank() OVER (ORDER BY churned DESC) AS rnk, lead(churned) OVER (ORDER BY churned DESC) AS next
      FROM segments WHERE churned_rows > 0) AS t
WHERE rnk = 1""",
    "refund_share": f"""
SELECT industry, country, churned_mrr, total_refunds,
  {ratio("round(total_refunds * 100) * 100", "round(churned_mrr * 100)")} AS refund_pct
FROM q3""",
    "segments_above_benchmark": """
SELECT count(*) FILTER (WHERE segment_churn_rate > overall_churn_rate) AS segments_above, count(*) AS segments,
  max(overall_churn_rate) AS overall_churn_rate
FROM q4""",
    "arr_by_segment": """
SELECT industry, country, plan_tier, (total * 12)::DOUBLE AS total_arr, (churned * 12)::DOUBLE AS churned_arr
FROM segments""",
    "concurrent_subscriptions": """
SELECT f.account_key, d.date_key, count(*) AS active_subscriptions
FROM fact_subscriptions AS f
JOIN dim_date AS d ON d.date_key >= f.start_date_key AND (f.end_date_key IS NULL OR d.date_key <= f.end_date_key)
GROUP BY 1, 2""",
    "refunds_by_reason_category": """
SELECT r.reason_category, count(*) AS churn_events, sum(f.refund_amount_usd)::DOUBLE AS total_refunds
FROM fact_churn_events AS f JOIN dim_churn_reason AS r ON f.churn_reason_key = r.churn_reason_key GROUP BY 1""",
    "start_cohorts": f"""
SELECT start_date_key, subscriptions, total::DOUBLE AS total_mrr, churned::DOUBLE AS churned_mrr,
  {money_pct("churned", "total")} AS churn_rate
FROM (SELECT start_date_key, count(*) AS subscriptions, sum(mrr) AS total, {_CHURNED} AS churned
      FROM fact_subscriptions AS f GROUP BY 1) AS t""",
    "rank_segments": """
SELECT industry, country, total::DOUBLE AS total_mrr, rank() OVER (ORDER BY total DESC) AS mrr_rank
FROM (SELECT min(industry) AS industry, country, sum(total) AS total FROM segments GROUP BY lower(industry), country)
  AS t""",
    "window_over_aggregate": f"""
SELECT industry, total::DOUBLE AS total_mrr, {money_pct("total", "all_total")} AS mrr_share
FROM (SELECT min(industry) AS industry, sum(total) AS total, sum(sum(total)) OVER () AS all_total
      FROM segments GROUP BY lower(industry)) AS t""",
    "roundtrip_parquet": """
SELECT industry, country, plan_tier, churned::DOUBLE AS churned_mrr, total::DOUBLE AS total_mrr FROM segments""",
    "publish_csv": "SELECT * FROM q3",
    "check_pk": _keys(r.CLEAN_TABLES),
    "check_fk_clean": _references(r.CLEAN_TABLES),
    "check_fk_star": _references(r.STAR_TABLES),
    "check_not_null": _rules(r.CLEAN_TABLES, lambda t: {c: f"{c} IS NOT NULL" for c in r.NOT_NULL[t].split()}),
    "check_expr": _rules(r.CLEAN_TABLES, lambda t: r.CHECKS.get(t, {})),
    "check_domain": _rules(r.CLEAN_TABLES, r.domain_rules),
    "check_length": _rules(r.CLEAN_TABLES, r.length_rules),
    "check_star": "\nUNION ALL\n".join([_rules(r.STAR_TABLES, r.row_rules), _keys(r.STAR_TABLES), _references(r.STAR_TABLES)]),
    "grain_check": """
SELECT lower(account_id) AS account_id, strftime(start_date, '%Y%m') AS month_key, count(*) AS row_count
FROM subscriptions GROUP BY 1, 2 HAVING count(*) > 1""",
    "unknown_tiers": "\nUNION ALL\n".join(
        f"SELECT DISTINCT plan_tier, '{t}' AS table_name FROM raw_{t} "
        "WHERE lower(trim(plan_tier)) NOT IN ('basic', 'pro', 'enterprise')"
        for t in ("accounts", "subscriptions")
    ),
    "row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in r.CLEAN_TABLES
    ),
    "distinct_subscribers": "SELECT count(DISTINCT lower(account_id)) AS accounts FROM subscriptions",
    "accounts_without_subscription": """
SELECT lower(account_id) AS account_id FROM accounts
WHERE NOT EXISTS (SELECT 1 FROM subscriptions AS s WHERE lower(s.account_id) = lower(accounts.account_id))""",
    "dim_counts": "\nUNION ALL\n".join(
        f"SELECT '{d}' AS table_name, f.n AS found, e.n AS expected, f.n = e.n AS agrees "
        f"FROM (SELECT count(*) AS n FROM {d}) AS f, (SELECT count(*) AS n FROM {s}) AS e"
        for d, s in (("dim_account", "accounts"), ("dim_subscription", "subscriptions"))
    ),
}


# Queries about what is wrong with the rows run over the damaged ones.
ON_DAMAGED = (
    "check_pk", "check_fk_clean", "check_fk_star", "check_not_null", "check_expr", "check_domain", "check_length",
    "check_star", "unknown_tiers", "accounts_without_subscription", "zero_churn_segments", "concurrent_subscriptions",
)
FINALS |= {
    "ingest_raw": "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}" for t in RAW_SQL),
    # accounts of even numbers were loaded first
    "dim_account_extended": """
SELECT row_number() OVER (ORDER BY CASE WHEN n % 2 = 0 THEN 0 ELSE 1 END, account_id) AS account_key, account_id
FROM (SELECT account_id, substr(account_id, 3)::BIGINT AS n FROM accounts) AS t""",
}
# ---- second loads: each must equal what one load of all rows gives ----

CTES["raw_earlier_accounts"] = EARLIER_SQL["accounts"].format(**{t: t for t in SOURCES})
CTES["earlier_accounts"] = CTES["accounts"].replace("raw_accounts", "raw_earlier_accounts")
_MONTH = "(date_key // 100) * 12 + date_key % 100"
# clean and star tables by the number of tables that must be there before them, one behind the other
_LEVELS = {
    "accounts": 0, "dim_churn_reason": 0, "subscriptions": 1, "churn_events": 1, "support_tickets": 1, "dim_account": 1,
    "feature_usage": 2, "dim_date": 2, "dim_subscription": 2, "fact_subscriptions": 3, "fact_churn_events": 3,
    "fact_subscription_usage": 3,
}


def _steps(tables: tuple, step) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {step(_LEVELS[t])}::BIGINT AS step FROM {t}" for t in tables
    )


_CHANGED = {"account_name": "account_name", "industry": "industry", "country": "country", "initial_plan_tier": "plan_tier"}
FINALS |= {
    "fact_subscription_usage_second_load": "SELECT * FROM fact_subscription_usage",
    # events of even numbers were loaded first
    "fact_churn_events_extended": """
SELECT * REPLACE (refund_amount_usd::DOUBLE AS refund_amount_usd, row_number() OVER (
  ORDER BY substr(churn_event_id, 3)::BIGINT % 2, churn_event_id) AS churn_event_key)
FROM fact_churn_events""",
    "dedupe_second_load": _whole("churn_events"),
    "rollups_merged": "SELECT * FROM monthly_feature",
    "ticket_rollups_merged": "SELECT * FROM ticket_monthly",
    "low_engagement_streak": f"""
SELECT subscription_id, date_key, active_days,
  CASE WHEN low THEN row_number() OVER (PARTITION BY subscription_id, low, m - place ORDER BY m) ELSE 0 END AS low_engagement_streak
FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id, low ORDER BY m) AS place
      FROM (SELECT *, {_MONTH} AS m, active_days < 5 AS low FROM monthly_feature) AS s) AS t""",
    "mom_delta_calendar": f"""
SELECT a.subscription_id, a.date_key, a.active_days, a.active_days - b.active_days AS mom_active_days_delta
FROM (SELECT *, {_MONTH} AS m FROM monthly_feature) AS a
LEFT JOIN (SELECT *, {_MONTH} AS m FROM monthly_feature) AS b ON a.subscription_id = b.subscription_id AND a.m = b.m + 1""",
    "dim_date_extended": _whole("dim_date"),
    "account_changes": "\nUNION ALL\n".join(
        f"SELECT e.account_key, '{a}' AS attribute, e.{c} AS old_value, n.{c} AS new_value, '2001-12-01' AS changed_on "
        "FROM (SELECT row_number() OVER (ORDER BY account_id) AS account_key, * FROM earlier_accounts) AS e "
        f"JOIN accounts AS n ON lower(e.account_id) = lower(n.account_id) WHERE e.{c} IS DISTINCT FROM n.{c}"
        for a, c in _CHANGED.items()
    ),
    "load_order": _steps(tuple(_LEVELS), lambda n: n),
    "reset_order": _steps(r.STAR_TABLES, lambda n: 3 - n),
}
# Over rows accepted by a quarantine load, and those it kept apart.
_QUARANTINE = {
    f"rejected_{t}": f"SELECT violations, count(*) AS n_rows FROM {t}_tagged WHERE violations <> '' GROUP BY 1"
    for t in (*r.CLEAN_TABLES, "fact_churn_events", "fact_subscription_usage")
} | {
    "kept_usage_trend": """
SELECT date_key, subscription_key, active_days, mom_active_days_delta, consecutive_low_engagement_months
FROM fact_subscription_usage"""
}

_DAMAGED_CTES = CTES | {f"raw_{t}": text.format(**{s: s for s in SOURCES}) for t, text in DAMAGED_SQL.items()}


def _accepted() -> dict[str, str]:
    """Every table twice: all its rows tagged, and under its own name those that break nothing."""
    ctes = dict(_DAMAGED_CTES)
    for t in (*r.CLEAN_TABLES, *r.STAR_TABLES):
        ctes[f"{t}_all"] = ctes[t]
        ctes[f"{t}_tagged"] = _tagged(t, f"{t}_all")
        ctes[t] = f"SELECT * EXCLUDE (violations) FROM {t}_tagged WHERE violations = ''"
    # months outside the calendar are refused before the trend is computed
    usage = ctes["fact_subscription_usage_all"]
    ctes["fact_subscription_usage_in"] = usage.replace(
        "WINDOW w", "WHERE m.date_key IN (SELECT date_key FROM dim_date)\nWINDOW w"
    )
    ctes["fact_subscription_usage"] = (
        "SELECT * EXCLUDE (violations) FROM (" + _tagged("fact_subscription_usage", "fact_subscription_usage_in") + ") AS t "
        "WHERE violations = ''"
    )
    return ctes


def _with_ctes(final: str, ctes: dict[str, str]) -> str:
    """Prefix the common table expressions a text needs, each after those it needs itself."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in ctes:
            if name not in order and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                need(ctes[name])
                if name not in order:
                    order.append(name)

    need(final)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({ctes[name].strip()})" if name.endswith(("_all", "_tagged")) else f"{name} AS ({ctes[name].strip()})" for name in order)
    return f"WITH {parts}\n{final.strip()}" if parts else final.strip()


def _paying() -> dict[str, str]:
    """Facts of subscriptions that are no trials."""
    only = "SELECT * FROM {0}_every WHERE subscription_key IN (SELECT subscription_key FROM dim_subscription WHERE NOT is_trial)"
    facts = ("fact_subscriptions", "fact_subscription_usage")
    return CTES | {f"{t}_every": CTES[t] for t in facts} | {t: only.format(t) for t in facts}


def oracle_sql() -> dict[str, str]:
    accepted = _accepted()
    plain = {n: _with_ctes(text, _DAMAGED_CTES if n in ON_DAMAGED else CTES) for n, text in FINALS.items()}
    paying = {f"{n}_paying": _with_ctes(text, _paying()) for n, text in FINALS.items() if re.match(r"q[1-5]_", n)}
    return plain | paying | {n: _with_ctes(text, accepted) for n, text in _QUARANTINE.items()}
