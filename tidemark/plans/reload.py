"""Further loads of the usage fact: only months that changed are read and replaced.

Clean usage, its monthly figures and the fact are stored by month. A load writes its
usage extract by month once, as the version that counts when it is through, and compares
each month's rows with what the last load saw, by count and two order-free hashes.
Months with new, changed or withdrawn rows are touched: their figures are built from
their rows alone. A fact row also depends on earlier months of its subscription
(change and running count), on the month's tickets of its account and on the
subscription itself; months in which such rows change are replaced as well, from the
figures, not from usage rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import month_key
from ..schemas import LOW_ENGAGEMENT_DAYS, STAR_TYPES
from ..session import complete_folders, delete_folder, discard, folder_exists, materialize, replace_partitions
from ..sources.versions import Versions
from . import facts

MONTH = "date_key"
Marks = Mapping[int, tuple[int, int, int]]

_USAGE = (
    "usage_id string, subscription_id string, usage_date date, feature_name string, usage_count int, "
    f"usage_duration_secs int, error_count int, is_beta_feature boolean, {MONTH} int"
)
_FIGURES = (
    "subscription_id string, active_days int, feature_adoption_count bigint, total_usage_count bigint, "
    "total_usage_duration_secs bigint, total_error_count bigint, beta_feature_usage_count bigint, "
    f"avg_usage_duration_secs decimal(20,2), {MONTH} int"
)
_MARKS = f"source string, {MONTH} int, n bigint, total decimal(38,0), mixed bigint"
_OWNERS = "subscription_id string, account_id string, subscription_key bigint, account_key bigint, is_churned boolean"


def month_marks(rows: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Count, sum and exclusive or of row hashes of each month: one line per month, gathered by the driver."""
    columns = [c for c in rows.columns if c != MONTH]
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    # the sum of a hash in two halves: whole numbers of 64 bits hold them for some four billion rows
    marks = rows.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftright(one, 32)).alias("high"),
        F.sum(one.bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.bit_xor(two).alias("mixed"),
    )
    return {r[MONTH]: (r["n"], (r["high"] << 32) + r["low"], r["mixed"]) for r in marks.collect()}


def changed_months(before: Marks, after: Marks) -> set[int]:
    return {m for m in {*before, *after} if before.get(m) != after.get(m)}


class MonthlyUsage:
    """The usage fact under ``root``, able to take one whole set of extracts after another.

    ``load`` brings the fact to what a full rebuild over the given extracts would
    give. Before anything is replaced, the months in question lose their marks, so
    after a load that broke they count as touched until one succeeds; a repeated
    load changes nothing. Usage and tickets need dates, as their constraints say.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._extracts = Versions(spark, f"{self.root}/usage")

    # ---- stored tables

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: str, replaced_by_month: bool = True) -> DataFrame:
        """A stored table, empty before the first load. Tables that are replaced as a whole count when they are whole."""
        path = self._path(name)
        if not (folder_exists(self.spark, path) if replaced_by_month else complete_folders(self.spark, path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def usage(self) -> DataFrame:
        """Clean usage as of the last load."""
        return self._usage_rows().drop(MONTH)

    def fact(self) -> DataFrame:
        """The usage fact as of the last load."""
        columns = {c: kind for c, kind in STAR_TYPES["fact_subscription_usage"].items() if c != MONTH}
        schema = ", ".join(f"{c} {kind}" for c, kind in columns.items()) + f", {MONTH} int"
        return self._read("fact", schema).select(*STAR_TYPES["fact_subscription_usage"])

    def usage_of(self, months: Iterable[int]) -> DataFrame:
        """Clean usage rows of some months; other months' files are not opened."""
        return self._usage_rows().where(F.col(MONTH).isin(sorted(months)))

    def _usage_rows(self) -> DataFrame:
        folder = self._extracts.current()
        if folder is None:
            raise ValueError(f"nothing has been loaded into {self.root}")
        return self.spark.read.schema(_USAGE).parquet(folder)

    def usage_months(self) -> DataFrame:
        """Usage figures of every subscription and month, known accounts or not."""
        return self._read("usage_month", _FIGURES)

    def _marks(self) -> dict[str, dict[int, tuple[int, int, int]]]:
        """By source, what the last load saw of each month."""
        marks: dict[str, dict] = {"usage": {}, "tickets": {}}
        for source, month, *mark in self._read("month_marks", _MARKS, False).collect():
            marks[source][month] = (mark[0], int(mark[1]), mark[2])
        return marks

    def _mark(self, marks: Mapping[str, Marks]) -> None:
        rows = [(s, m, n, Decimal(total), mixed) for s, of in marks.items() for m, (n, total, mixed) in of.items()]
        self.spark.createDataFrame(rows, _MARKS).coalesce(1).write.mode("overwrite").parquet(self._path("month_marks"))

    # ---- loads

    def load(self, usage: DataFrame, tickets: DataFrame, bridge: DataFrame) -> dict[str, list[int]]:
        """Take whole clean extracts in; returns the months read again and the months replaced in the fact."""
        extract = self._by_month(usage)
        ticket_rows = materialize(facts.ticket_state(tickets), "ticket-state")
        owner_rows = materialize(facts.owners(bridge), "owners")
        seen = {"usage": month_marks(extract), "tickets": month_marks(ticket_rows)}
        if None in seen["usage"] or None in seen["tickets"]:
            raise ValueError("rows without a date cannot be stored by month")
        before = self._marks()
        touched = {name: changed_months(before[name], seen[name]) for name in seen}

        def of(rows: DataFrame, months: Iterable[int]) -> DataFrame:
            return rows.where(F.col(MONTH).isin(sorted(months)))

        fresh = materialize(facts.monthly_feature(of(extract, touched["usage"])), "usage-month")
        now = fresh.unionByName(self.usage_months().where(~F.col(MONTH).isin(sorted(touched["usage"]))))
        replaced = touched["usage"] | touched["tickets"]
        if not replaced >= set(seen["usage"]):  # a first load replaces all months there are
            replaced |= self._following(now, fresh, owner_rows, touched["usage"])
        if replaced:
            self._mark({name: {m: v for m, v in before[name].items() if m not in replaced} for name in seen})
            rows = materialize(self._fact_rows(now, owner_rows, of(ticket_rows, replaced), replaced), "usage-fact")
            replace_partitions(rows, self._path("fact"), MONTH, replaced)
            discard(rows)
            if touched["usage"]:
                replace_partitions(fresh, self._path("usage_month"), MONTH, touched["usage"])
        # months that are not touched hold the same rows in both versions
        if touched["usage"] or self._extracts.current() is None:
            self._extracts.switch(extract._folder)
        self._extracts.clear()
        owner_rows.write.mode("overwrite").parquet(self._path("owners"))
        if replaced:
            self._mark(seen)
        discard(ticket_rows, owner_rows, fresh)
        return {"read": sorted(touched["usage"]), "replaced": sorted(replaced)}

    def _by_month(self, usage: DataFrame) -> DataFrame:
        """The extract with its months, stored by month once: two passes read it, the second only some months."""
        path = self._extracts.new()
        rows = usage.withColumn(MONTH, month_key(F.col("usage_date"))).hint("rebalance", MONTH)
        rows.write.partitionBy(MONTH).parquet(path)
        stored = self.spark.read.schema(_USAGE).parquet(path)
        stored._folder = path
        return stored

    def _following(self, now: DataFrame, fresh: DataFrame, owners: DataFrame, touched: set[int]) -> set[int]:
        """Months in which a subscription has rows from its first changed month on, or any if its owner changed."""
        old = self.usage_months().where(F.col(MONTH).isin(sorted(touched)))
        old, new = (df.select("subscription_id", MONTH, F.col("active_days").alias(name)) for df, name in ((old, "_old"), (fresh, "_new")))
        moved = old.join(new, ["subscription_id", MONTH], "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
        first = moved.groupBy("subscription_id").agg(F.min(MONTH).alias("_from"))
        had = self._read("owners", _OWNERS, False)
        columns = [c for c in had.columns if c != "subscription_id"]
        both = had.select("subscription_id", F.struct(*columns).alias("_old")).join(
            owners.select("subscription_id", F.struct(*columns).alias("_new")), "subscription_id", "full"
        )
        other = both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("subscription_id", F.lit(0).alias("_from"))
        starts = first.unionByName(other).groupBy("subscription_id").agg(F.min("_from").alias("_from"))
        later = now.select("subscription_id", MONTH).join(starts, "subscription_id").where(F.col(MONTH) >= F.col("_from"))
        return {r[0] for r in later.select(MONTH).distinct().collect()}

    def _fact_rows(self, now: DataFrame, owners: DataFrame, ticket_rows: DataFrame, months: set[int]) -> DataFrame:
        """Fact rows of ``months``. Earlier ones enter by one line per subscription: its last active days, its low months."""
        start = min(months)
        days, low = F.col("active_days"), F.col("active_days") < LOW_ENGAGEMENT_DAYS
        known = now.select("subscription_id", MONTH, "active_days").where(F.col(MONTH) < start)
        past = known.groupBy("subscription_id").agg(
            F.max_by("active_days", MONTH).alias("_last"), F.count_if(low).alias("_low")
        )
        recent = now.where(F.col(MONTH) >= start).join(owners, "subscription_id")
        per_subscription = W.partitionBy("subscription_id").orderBy(MONTH)
        so_far = per_subscription.rowsBetween(W.unboundedPreceding, W.currentRow)
        trend = recent.join(past, "subscription_id", "left").withColumns(
            {
                "mom_active_days_delta": days - F.coalesce(F.lag(days).over(per_subscription), F.col("_last")),
                "consecutive_low_engagement_months": F.coalesce("_low", F.lit(0)) + F.count_if(low).over(so_far),
            }
        )
        wanted = trend.where(F.col(MONTH).isin(sorted(months))).drop("_last", "_low")
        return facts.usage_fact(wanted, facts.finish_tickets(ticket_rows))

    def drop(self) -> None:
        delete_folder(self.spark, self.root)
