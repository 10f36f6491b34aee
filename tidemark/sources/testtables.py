"""The five raw tables derived from the generic test tables.

The texts use only SQL that Spark and DuckDB evaluate alike, so a check in
DuckDB starts from the very same rows. Odd casing, blanks and empty texts are
there on purpose: they give the cleaning something to do. ``{table}`` marks the
source tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

ACCOUNTS = """
SELECT
  'A-' || cast(c_custkey AS string) AS account_id,
  ' ' || c_name || ' ' AS account_name,
  c_mktsegment AS industry,
  CASE n_regionkey WHEN 0 THEN 'us' WHEN 1 THEN 'UK' WHEN 2 THEN ' DE' WHEN 3 THEN 'in ' ELSE 'AU' END AS country,
  substr(signup, 9, 2) || '/' || substr(signup, 6, 2) || '/' || substr(signup, 1, 4) AS signup_date,
  CASE c_custkey % 6 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' WHEN 2 THEN 'event' WHEN 3 THEN 'partner'
    WHEN 4 THEN 'other' ELSE '' END AS referral_source,
  CASE c_custkey % 3 WHEN 0 THEN 'basic' WHEN 1 THEN ' PRO' ELSE 'Enterprise' END AS plan_tier,
  CASE WHEN c_custkey % 40 = 0 THEN ' ' ELSE cast(c_custkey % 40 AS string) END AS seats,
  CASE WHEN c_custkey % 5 = 0 THEN 'True' ELSE 'False' END AS is_trial,
  CASE WHEN c_custkey % 9 = 0 THEN 'TRUE ' ELSE 'False' END AS churn_flag
FROM (
  SELECT *, cast((date '1993-01-01' + cast(c_custkey % 700 AS int)) AS string) AS signup
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
) AS c
"""

SUBSCRIPTIONS = """
SELECT
  'S-' || cast(o_orderkey AS string) AS subscription_id,
  'A-' || cast(o_custkey AS string) AS account_id,
  cast(cast(o_orderdate AS date) AS string) AS start_date,
  CASE WHEN o_orderstatus = 'F'
    THEN cast((cast(o_orderdate AS date) + cast(o_orderkey % 365 AS int)) AS string) ELSE '' END AS end_date,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'enterprise' WHEN '2' THEN 'Enterprise '
    WHEN '3' THEN 'Pro' ELSE 'BASIC' END AS plan_tier,
  CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE cast(o_orderkey % 40 AS string) END AS seats,
  CASE WHEN o_orderkey % 50 = 0 THEN ''
    ELSE cast(cast(o_totalprice AS decimal(10,2)) AS string) END AS mrr_amount,
  CASE WHEN o_orderkey % 8 = 0 THEN 'true' ELSE 'false' END AS is_trial,
  CASE WHEN o_orderkey % 10 = 1 THEN 'True' ELSE 'False' END AS upgrade_flag,
  CASE WHEN o_orderkey % 10 = 2 THEN 'True' ELSE 'False' END AS downgrade_flag,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS churn_flag,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Annual' ELSE ' monthly' END AS billing_frequency,
  CASE WHEN o_orderkey % 4 = 0 THEN 'False' ELSE 'True' END AS auto_renew_flag
FROM {orders}
"""

FEATURE_USAGE = """
SELECT
  'U-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS usage_id,
  'S-' || cast(l_suppkey AS string) AS subscription_id,
  cast(cast(l_shipdate AS date) AS string) AS usage_date,
  'feature_' || cast(l_partkey % 40 AS string) AS feature_name,
  CASE WHEN l_partkey % 97 = 0 THEN '' ELSE cast(cast(l_quantity AS int) AS string) END AS usage_count,
  cast(cast(floor(l_extendedprice) AS int) AS string) AS usage_duration_secs,
  cast((l_suppkey + l_partkey) % 5 AS string) AS error_count,
  CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS is_beta_feature
FROM {lineitem}
"""

# The urgent ones come twice, the copy one day earlier.
CHURN_EVENTS = """
SELECT
  'C-' || cast(o_orderkey AS string) AS churn_event_id,
  'A-' || cast(o_custkey AS string) AS account_id,
  substr(churned, 9, 2) || '/' || substr(churned, 6, 2) || '/' || substr(churned, 1, 4) AS churn_date,
  CASE o_orderkey % 7 WHEN 0 THEN 'pricing' WHEN 1 THEN 'budget' WHEN 2 THEN 'competitor' WHEN 3 THEN 'support'
    WHEN 4 THEN ' features' WHEN 5 THEN 'Pricing' ELSE 'merger' END AS reason_code,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE cast(o_orderkey % 900 AS string) || '.25' END AS refund_amount_usd,
  CASE WHEN o_orderkey % 10 = 4 THEN 'True' ELSE 'False' END AS preceding_upgrade_flag,
  CASE WHEN o_orderkey % 10 = 6 THEN 'True' ELSE 'False' END AS preceding_downgrade_flag,
  CASE WHEN o_orderkey % 8 = 0 THEN 'True' ELSE 'False' END AS is_reactivation,
  CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE 'note ' || cast(o_orderkey AS string) END AS feedback_text
FROM (
  SELECT *, cast((cast(o_orderdate AS date) + cast(o_orderkey % 365 AS int)) AS string) AS churned
  FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
  UNION ALL
  SELECT *, cast((cast(o_orderdate AS date) + cast(o_orderkey % 365 AS int) - 1) AS string) AS churned
  FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
) AS o
"""

SUPPORT_TICKETS = """
SELECT
  'T-' || cast(event_id AS string) AS ticket_id,
  'A-' || cast(o_custkey AS string) AS account_id,
  cast(submitted AS string) AS submitted_at,
  CASE WHEN event_type = 'error' THEN ''
    ELSE cast((submitted + cast(((event_id % 900) - (event_id % 900) % 24) / 24 AS int)) AS string) || ' '
      || lpad(cast((event_id % 900) % 24 AS string), 2, '0') || ':15:30' END AS closed_at,
  CASE event_type WHEN 'signup' THEN 'low' WHEN 'view' THEN 'medium' WHEN 'click' THEN ' High'
    WHEN 'purchase' THEN 'URGENT' ELSE 'p0' END AS priority,
  CASE WHEN event_id % 50 = 0 THEN '' ELSE cast(event_id % 500 AS string) END AS first_response_time_minutes,
  CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '1.0' WHEN 2 THEN '2.0' WHEN 3 THEN '3.0' WHEN 4 THEN '4.0'
    WHEN 5 THEN '4.5' ELSE '5.0' END AS satisfaction_score,
  CASE WHEN event_id % 11 = 0 THEN 'True' ELSE 'False' END AS escalation_flag
FROM (
  SELECT *, date '1995-01-01' + cast(event_id * 7 % 2400 AS int) AS submitted
  FROM {events} JOIN {orders} ON o_orderkey = user_id
) AS e
"""

RAW_SQL = {
    "accounts": ACCOUNTS,
    "subscriptions": SUBSCRIPTIONS,
    "feature_usage": FEATURE_USAGE,
    "churn_events": CHURN_EVENTS,
    "support_tickets": SUPPORT_TICKETS,
}
# Damage for the checks to find, at fixed numbers of each table's own ids.
DAMAGE = {
    "accounts": """
SELECT
  CASE WHEN k % 120 = 29 THEN 'a-' || cast(k + 1 AS string) WHEN k % 40 = 1 THEN NULL
    WHEN k % 40 = 4 THEN account_id || repeat('x', 60) ELSE account_id END AS account_id,
  CASE k % 40 WHEN 5 THEN NULL WHEN 6 THEN repeat('n', 120) ELSE account_name END AS account_name,
  CASE k % 40 WHEN 7 THEN NULL WHEN 8 THEN repeat('i', 120) ELSE industry END AS industry,
  CASE k % 40 WHEN 9 THEN NULL WHEN 10 THEN 'usa' ELSE country END AS country,
  CASE k % 40 WHEN 11 THEN '31/31/1993' ELSE signup_date END AS signup_date,
  CASE k % 40 WHEN 12 THEN 'friend' ELSE referral_source END AS referral_source,
  CASE k % 40 WHEN 13 THEN 'Gold' ELSE plan_tier END AS plan_tier,
  CASE k % 40 WHEN 14 THEN 'many' WHEN 15 THEN '0' ELSE seats END AS seats,
  CASE k % 40 WHEN 16 THEN NULL ELSE is_trial END AS is_trial,
  CASE k % 40 WHEN 17 THEN NULL ELSE churn_flag END AS churn_flag
FROM (SELECT *, cast(substr(account_id, 3) AS bigint) AS k FROM ({rows}) AS r) AS d
""",
    # every thirtieth account's subscriptions are its neighbour's, and there is no churn on the lowest tier
    "subscriptions": """
SELECT
  CASE k % 60 WHEN 1 THEN NULL WHEN 2 THEN 's-' || cast(k + 1 AS string)
    WHEN 4 THEN subscription_id || repeat('x', 60) ELSE subscription_id END AS subscription_id,
  CASE WHEN k % 60 = 5 THEN 'A-none' WHEN k % 60 = 6 THEN NULL WHEN k % 60 = 7 THEN repeat('a', 60)
    WHEN a % 30 = 0 THEN 'A-' || cast(a - 1 AS string) ELSE account_id END AS account_id,
  CASE k % 60 WHEN 8 THEN 'soon' ELSE start_date END AS start_date,
  CASE k % 60 WHEN 9 THEN '1980-01-01' ELSE end_date END AS end_date,
  CASE k % 60 WHEN 10 THEN 'Silver' ELSE plan_tier END AS plan_tier,
  CASE k % 60 WHEN 11 THEN '0' WHEN 12 THEN 'x' ELSE seats END AS seats,
  CASE k % 60 WHEN 13 THEN '-5.00' WHEN 14 THEN 'free' ELSE mrr_amount END AS mrr_amount,
  CASE k % 60 WHEN 15 THEN NULL ELSE is_trial END AS is_trial,
  CASE k % 60 WHEN 16 THEN NULL ELSE upgrade_flag END AS upgrade_flag,
  CASE k % 60 WHEN 17 THEN NULL ELSE downgrade_flag END AS downgrade_flag,
  CASE WHEN k % 60 = 18 THEN NULL WHEN plan_tier = 'BASIC' THEN 'False' ELSE churn_flag END AS churn_flag,
  CASE k % 60 WHEN 19 THEN 'weekly' WHEN 20 THEN NULL ELSE billing_frequency END AS billing_frequency,
  CASE k % 60 WHEN 21 THEN NULL ELSE auto_renew_flag END AS auto_renew_flag
FROM (SELECT *, cast(substr(subscription_id, 3) AS bigint) AS k, cast(substr(account_id, 3) AS bigint) AS a FROM ({rows}) AS r) AS d
""",
    "feature_usage": """
SELECT
  CASE k % 70 WHEN 1 THEN NULL WHEN 2 THEN usage_id || repeat('x', 60) ELSE usage_id END AS usage_id,
  CASE k % 70 WHEN 3 THEN 'S-none' WHEN 4 THEN NULL WHEN 5 THEN repeat('s', 60) ELSE subscription_id END AS subscription_id,
  CASE k % 70 WHEN 6 THEN 'soon' WHEN 7 THEN '1980-02-01' ELSE usage_date END AS usage_date,
  CASE k % 70 WHEN 8 THEN NULL WHEN 9 THEN repeat('f', 60) ELSE feature_name END AS feature_name,
  CASE k % 70 WHEN 10 THEN '-3' ELSE usage_count END AS usage_count,
  CASE k % 70 WHEN 11 THEN 'x' ELSE usage_duration_secs END AS usage_duration_secs,
  CASE k % 70 WHEN 12 THEN 'x' ELSE error_count END AS error_count,
  CASE k % 70 WHEN 13 THEN NULL ELSE is_beta_feature END AS is_beta_feature
FROM (SELECT *, cast(split_part(usage_id, '-', 2) AS bigint) AS k FROM ({rows}) AS r) AS d
""",
    "churn_events": """
SELECT
  CASE k % 70 WHEN 1 THEN NULL WHEN 2 THEN churn_event_id || repeat('x', 60) ELSE churn_event_id END AS churn_event_id,
  CASE k % 70 WHEN 3 THEN 'A-none' WHEN 4 THEN NULL WHEN 5 THEN repeat('a', 60) ELSE account_id END AS account_id,
  CASE k % 70 WHEN 6 THEN 'soon' WHEN 7 THEN '01/02/1980' ELSE churn_date END AS churn_date,
  CASE k % 70 WHEN 8 THEN '' WHEN 9 THEN repeat('r', 60) ELSE reason_code END AS reason_code,
  CASE k % 70 WHEN 10 THEN '-1.00' WHEN 11 THEN 'x' ELSE refund_amount_usd END AS refund_amount_usd,
  CASE k % 70 WHEN 12 THEN NULL ELSE preceding_upgrade_flag END AS preceding_upgrade_flag,
  CASE k % 70 WHEN 13 THEN NULL ELSE preceding_downgrade_flag END AS preceding_downgrade_flag,
  CASE k % 70 WHEN 14 THEN NULL ELSE is_reactivation END AS is_reactivation,
  feedback_text
FROM (SELECT *, cast(substr(churn_event_id, 3) AS bigint) AS k FROM ({rows}) AS r) AS d
""",
    "support_tickets": """
SELECT
  CASE k % 50 WHEN 1 THEN NULL WHEN 2 THEN 't-' || cast(k + 1 AS string)
    WHEN 4 THEN ticket_id || repeat('x', 60) ELSE ticket_id END AS ticket_id,
  CASE k % 50 WHEN 5 THEN 'A-none' WHEN 6 THEN NULL WHEN 7 THEN repeat('a', 60) ELSE account_id END AS account_id,
  CASE k % 50 WHEN 8 THEN 'soon' ELSE submitted_at END AS submitted_at,
  CASE k % 50 WHEN 9 THEN '1980-01-01 00:00:00' ELSE closed_at END AS closed_at,
  priority,
  CASE k % 50 WHEN 10 THEN '-4' ELSE first_response_time_minutes END AS first_response_time_minutes,
  CASE k % 50 WHEN 11 THEN '9.0' ELSE satisfaction_score END AS satisfaction_score,
  CASE k % 50 WHEN 12 THEN NULL ELSE escalation_flag END AS escalation_flag
FROM (SELECT *, cast(substr(ticket_id, 3) AS bigint) AS k FROM ({rows}) AS r) AS d
""",
}
DAMAGED_SQL = {t: DAMAGE[t].replace("{rows}", text) for t, text in RAW_SQL.items()}

# An earlier state of the same tables, for second loads: what was missing, what read otherwise, what was withdrawn later.
EARLIER = {
    "accounts": """
SELECT account_id, CASE WHEN k % 11 = 3 THEN 'Former ' || account_name ELSE account_name END AS account_name,
  CASE WHEN k % 7 = 2 THEN 'Retail' ELSE industry END AS industry, country, signup_date, referral_source,
  CASE WHEN k % 13 = 5 THEN 'pro' ELSE plan_tier END AS plan_tier, seats, is_trial, churn_flag
FROM (SELECT *, cast(substr(account_id, 3) AS bigint) AS k FROM ({rows}) AS r) AS d
""",
    # September 2001 and later had not come, June 2001 counted otherwise, half of March 2001 stood there twice
    "feature_usage": """
SELECT usage_id, subscription_id, usage_date, feature_name,
  CASE WHEN substr(usage_date, 1, 7) = '2001-06' THEN '1' ELSE usage_count END AS usage_count,
  usage_duration_secs, error_count, is_beta_feature
FROM ({rows}) AS r WHERE usage_date < '2001-09-01'
UNION ALL
SELECT usage_id || '-w' AS usage_id, subscription_id, usage_date, feature_name, usage_count,
  usage_duration_secs, error_count, is_beta_feature
FROM ({rows}) AS r WHERE usage_date >= '2001-03-01' AND usage_date < '2001-03-16'
""",
    "support_tickets": """
SELECT * FROM ({rows}) AS r WHERE substr(submitted_at, 1, 7) <> '2001-05'
""",
}
EARLIER_SQL = RAW_SQL | {t: text.replace("{rows}", RAW_SQL[t]) for t, text in EARLIER.items()}
SOURCES = ("customer", "nation", "orders", "lineitem", "events")


class RawTables(Mapping[str, DataFrame]):
    """Raw frames over the Parquet test tables of one folder.

    ``damaged``: with rows that break constraints; ``earlier``: as an extract before these would have been.
    """

    def __init__(self, spark: SparkSession, folder: str, damaged: bool = False, earlier: bool = False):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._texts = DAMAGED_SQL if damaged else EARLIER_SQL if earlier else RAW_SQL

    def __getitem__(self, table: str) -> DataFrame:
        text = self._texts[table]
        used = {
            s: self._spark.read.parquet(f"{self._folder}/{s}.parquet") for s in SOURCES if f"{{{s}}}" in text
        }
        return self._spark.sql(text, **used)

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SQL)

    def __len__(self) -> int:
        return len(RAW_SQL)
