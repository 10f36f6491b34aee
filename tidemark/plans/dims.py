"""Month calendar and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fold, month_key, month_start
from ..operators.keys import extend_surrogate_key, lookup_key, with_surrogate_key
from ..schemas import CHURN_REASONS, STAR_TYPES
from ..sources.keystore import KeyRegistry


def as_typed(df: DataFrame, table: str) -> DataFrame:
    """The columns of a star table in order and type. An overflow raises."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in STAR_TYPES[table].items()])


def month_spine(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every month from the earliest ``start`` to the latest ``start`` or ``end``.

    One aggregate over the data; ``last_month`` rides along on each row.
    """
    bounds = df.agg(
        month_start(F.min(start)).alias("_lo"),
        month_start(F.greatest(F.coalesce(F.max(end), F.max(start)), F.max(start))).alias("last_month"),
    )
    months = F.explode(F.expr("sequence(_lo, last_month, INTERVAL 1 MONTH)"))
    return bounds.where("_lo IS NOT NULL").select(months.alias("month_start"), "last_month")


def build_dim_date(subscriptions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Month calendar of the subscriptions.

    With ``known``, a calendar already loaded, its months stay, months before and
    after them are added, and the flag of the current month moves to the last of
    all. Both bounds are single values, so months are spelled out only where they
    are missing.
    """
    m = F.col("month_start")
    spine = month_spine(subscriptions, F.col("start_date"), F.col("end_date"))
    if known is not None:
        had = known.agg(F.min("month_start").alias("_first"), F.max("month_start").alias("_last"))
        bounds = spine.agg(F.min("month_start").alias("_lo"), F.max("last_month").alias("_hi")).join(had, how="cross").select(
            F.least("_lo", "_first").alias("_lo"), F.greatest("_hi", "_last").alias("last_month"), "_first", "_last"
        )  # one row on either side
        months = F.explode(F.expr("sequence(_lo, last_month, INTERVAL 1 MONTH)"))
        missing = F.col("_first").isNull() | (m < F.col("_first")) | (m > F.col("_last"))
        added = bounds.where("_lo IS NOT NULL").select(months.alias("month_start"), "last_month", "_first", "_last").where(missing)
        kept = known.select("month_start").join(bounds.select("last_month"), how="cross")
        spine = kept.unionByName(added.select("month_start", "last_month"))
    return as_typed(
        spine.select(
            month_key(m).alias("date_key"),
            m,
            F.month(m).alias("month_number"),
            F.date_format(m, "MMMM").alias("month_name"),
            F.quarter(m).alias("quarter"),
            F.year(m).alias("year"),
            (m == F.col("last_month")).alias("is_current_month"),
        ),
        "dim_date",
    )


def load_dim_account(accounts: DataFrame, known: DataFrame | None = None, keys: KeyRegistry | None = None) -> DataFrame:
    """Accounts with a dense key; the tier is the one at account entry.

    With ``known``, an already loaded dimension, its rows keep their keys and
    attributes and only new accounts are numbered, after them; what changed of
    known accounts is told by ``account_changes``. With ``keys``, numbers come
    from the registry.
    """
    attributes = accounts.select(
        "account_id", "account_name", "industry", "country", F.col("plan_tier").alias("initial_plan_tier")
    )
    if known is not None:
        fresh = attributes.join(known.select(fold(F.col("account_id")).alias("_known")), fold(F.col("account_id")) == F.col("_known"), "left_anti")
        if keys:
            keyed = known.unionByName(keys.keyed(fresh, "accounts", "account_id", "account_key"))
        else:
            keyed = extend_surrogate_key(known, attributes, "account_key", "account_id")
    elif keys:
        keyed = keys.keyed(attributes, "accounts", "account_id", "account_key")
    else:
        keyed = with_surrogate_key(attributes, "account_key", [F.col("account_id")])
    return as_typed(keyed, "dim_account")


CHANGING = {"account_name": "account_name", "industry": "industry", "country": "country", "initial_plan_tier": "plan_tier"}


def account_changes(dim_account: DataFrame, accounts: DataFrame, loaded_on: str, history: DataFrame | None = None) -> DataFrame:
    """``account_key, attribute, old_value, new_value, changed_on`` for what the accounts say differently now.

    The dimension keeps the snapshot of the account's first load; a difference is
    recorded as a row dated ``loaded_on``. ``history``, the rows recorded by earlier
    loads, says what each attribute stands at: the new value of its latest row. New
    accounts have no changes, and accounts that are missing now have none either.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in CHANGING]))
    snapshot = dim_account.select("account_key", fold(F.col("account_id")).alias("_id"), pairs.alias("p"))
    stands = snapshot.select("_id", "account_key", "p.attribute", F.col("p.value").alias("old_value"))
    if history is not None:
        latest = history.groupBy("account_key", "attribute").agg(F.max(F.struct("changed_on", "new_value")).alias("_latest"))
        stands = stands.join(latest, ["account_key", "attribute"], "left").withColumn(
            "old_value", F.when(F.col("_latest").isNull(), F.col("old_value")).otherwise(F.col("_latest.new_value"))
        )
    told = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(c).alias("value")) for a, c in CHANGING.items()]))
    now = accounts.select(fold(F.col("account_id")).alias("_id"), told.alias("p"))
    now = now.select("_id", "p.attribute", F.col("p.value").alias("new_value"))
    return (
        stands.join(now, ["_id", "attribute"])
        .where(~F.col("old_value").eqNullSafe(F.col("new_value")))
        .select("account_key", "attribute", "old_value", "new_value", F.lit(loaded_on).cast("date").alias("changed_on"))
    )


def subscription_bridge(
    subscriptions: DataFrame, dim_account: DataFrame, known: DataFrame | None = None, keys: KeyRegistry | None = None
) -> DataFrame:
    """Clean subscriptions with their own key and that of their account (NULL if unknown).

    Dimension, facts and usage roll-up are projections of or joins to this
    frame: keys are assigned in one shuffle and never looked up again. With
    ``known``, an already loaded dimension, its keys stay and new subscriptions
    are numbered after them; with ``keys``, numbers come from the registry.
    """
    owned = lookup_key(subscriptions, dim_account, "account_id", "account_key", how="left")
    if keys:
        return keys.keyed(owned, "subscriptions", "subscription_id", "subscription_key")
    if known is None:
        return with_surrogate_key(owned, "subscription_key", [F.col("subscription_id")])
    keys = extend_surrogate_key(
        known.select("subscription_id", "subscription_key"),
        subscriptions.select("subscription_id"),
        "subscription_key",
        "subscription_id",
    )
    return lookup_key(owned, keys, "subscription_id", "subscription_key")


def load_dim_subscription(bridge: DataFrame) -> DataFrame:
    return as_typed(bridge, "dim_subscription")


def reason_seed(spark: SparkSession) -> DataFrame:
    """The fixed reason rows as an inline table."""
    rows = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in CHURN_REASONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r({', '.join(STAR_TYPES['dim_churn_reason'])})")


def load_dim_churn_reason(spark: SparkSession) -> DataFrame:
    return as_typed(reason_seed(spark), "dim_churn_reason")
