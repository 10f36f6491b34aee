"""Sanity checks over stored tables. They read; nothing here drops or resets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import order
from ..functions import fold
from ..operators import quality
from ..schemas import CLEAN, PLAN_TIERS, STAR

Tables = Mapping[str, DataFrame]


def _per_table(layer: Mapping, tables: Tables, check) -> DataFrame:
    parts = [check(name, c, tables[name]).withColumn("table_name", F.lit(name)) for name, c in layer.items()]
    return reduce(DataFrame.unionByName, parts)


def grain_check(clean: Tables) -> DataFrame:
    """Accounts that started more than one subscription in a month."""
    return quality.check_grain(
        clean["subscriptions"],
        {"account_id": fold(F.col("account_id")), "month_key": F.date_format("start_date", "yyyyMM")},
    )


def unknown_tiers(raw: Tables) -> DataFrame:
    """Plan tiers of the raw accounts and subscriptions that cleaning does not recognise."""
    return _named(
        {t: quality.check_domain(raw[t], "plan_tier", PLAN_TIERS).select("plan_tier") for t in ("accounts", "subscriptions")}
    )


def _named(parts: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("table_name", F.lit(name)) for name, df in parts.items()])


def clean_row_counts(clean: Tables) -> DataFrame:
    return quality.row_counts({name: clean[name] for name in CLEAN})


def distinct_subscribers(clean: Tables) -> DataFrame:
    return clean["subscriptions"].agg(F.countDistinct(fold(F.col("account_id"))).alias("accounts"))


def accounts_without_subscription(clean: Tables) -> DataFrame:
    """Account ids, in comparison form, that no subscription refers to."""
    used = clean["subscriptions"].select(fold(F.col("account_id")).alias("account_id"))
    return clean["accounts"].select(fold(F.col("account_id")).alias("account_id")).join(used, "account_id", "left_anti")


def dim_counts(clean: Tables, star: Tables) -> DataFrame:
    """Each dimension must hold one row per clean row."""
    pairs = {"dim_account": "accounts", "dim_subscription": "subscriptions"}
    parts = [
        quality.check_count(star[dim], clean[source]).withColumn("table_name", F.lit(dim))
        for dim, source in pairs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _checked(layer: Mapping, tables: Tables) -> quality.Checked:
    return {name: (tables[name], c) for name, c in layer.items()}


def key_violations(layer: Mapping, tables: Tables) -> DataFrame:
    """Rows per table and key that break its uniqueness."""
    return quality.audit_tables(_checked(layer, tables), tables, rows=False, references=False)


def reference_violations(layer: Mapping, tables: Tables) -> DataFrame:
    """Rows per table and reference without a parent."""
    return quality.audit_tables(_checked(layer, tables), tables, rows=False, keys=False)


def not_null_violations(clean: Tables) -> DataFrame:
    return _per_table(CLEAN, clean, lambda _, c, df: quality.check_not_null(df, c.not_null))


def check_violations(clean: Tables) -> DataFrame:
    """Range and cross-column checks."""
    checked = {n: c for n, c in CLEAN.items() if c.checks}
    return _per_table(checked, clean, lambda _, c, df: quality.check_rules(df, c.checks))


def domain_violations(clean: Tables) -> DataFrame:
    checked = {n: c for n, c in CLEAN.items() if c.domains}
    return _per_table(checked, clean, lambda _, c, df: quality.check_rules(df, c.domain_rules()))


def length_violations(clean: Tables) -> DataFrame:
    return _per_table(CLEAN, clean, lambda _, c, df: quality.check_rules(df, c.length_rules()))


def star_violations(star: Tables) -> DataFrame:
    """Every broken or kept constraint of the star tables with its violation count."""
    return quality.audit_tables(_checked(STAR, star), star)


def load_report(tables: Mapping[str, DataFrame], reset: bool = False) -> DataFrame:
    """``step, table_name, row_count`` of tables as they are loaded, or dropped for a reset."""
    depth = order.levels()
    last = max(depth[t] for t in tables)
    steps = {t: (last - depth[t] if reset else depth[t]) for t in tables}
    step = F.element_at(F.create_map(*[F.lit(x) for t, n in steps.items() for x in (t, n)]), F.col("table_name"))
    return quality.row_counts(tables).withColumn("step", step)
