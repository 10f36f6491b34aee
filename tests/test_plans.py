"""Physical plans: what keeps the jobs spread out when tables are large or lopsided."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup_key
from tidemark.operators.quality import check_fk
from tidemark.plans import analyses, clean, facts


@contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def large(spark):
    """Join as if no side were small enough to broadcast."""
    with settings(spark, autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1):
        yield


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def full(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def star(warehouse):
    return warehouse(
        accounts=[{}, {"account_id": "A-2"}],
        subscriptions=[{}, {"subscription_id": "S-2", "churn_flag": "True"}],
        feature_usage=[{}],
        support_tickets=[{}],
        churn_events=[{}],
        buckets=4,
    )


@pytest.mark.parametrize("table", ["feature_usage", "churn_events"])
def test_duplicates_are_dropped_before_the_shuffle(raw, table):
    p = plan(clean.CLEANERS[table](raw(table, {})))
    assert re.search(r"WindowGroupLimit.*Final.*\n.*Sort.*\n.*Exchange.*\n.*WindowGroupLimit.*Partial", p), p


def test_cleaning_without_duplicates_never_shuffles(raw):
    for table in ("accounts", "subscriptions", "support_tickets"):
        assert "Exchange" not in plan(clean.CLEANERS[table](raw(table, {})))


def test_subscription_fact_and_dimension_join_without_a_shuffle(star, large):
    p = plan(analyses.segment_revenue(star.star))
    join = p[p.index("SortMergeJoin [subscription_key]") :]
    assert "Exchange" not in join[: join.index("dim_subscription")]
    assert join.count("Bucketed: true") == 2


def test_filters_and_columns_reach_the_scan(star):
    text = full(analyses.q1_churned_mrr(star.star))
    fact = text[text.index("fact_subscriptions") :]
    assert "EqualTo(is_churned,1)" in fact[: fact.index("ReadSchema")]
    read = re.search(r"ReadSchema: (.*)", fact).group(1)
    assert "start_date_key" not in read and "is_upgraded" not in read


def test_usage_months_share_one_partitioning_by_subscription(star, large):
    p = plan(facts.build_fact_subscription_usage(star.clean["feature_usage"], star.clean["support_tickets"], star.bridge()))
    window = p[p.index("Window [lag(active_days") :]
    assert "Exchange" not in window[: window.index("SortMergeJoin [subscription_id]")]
    assert "Expand" not in p
    # rows are spread by feature as well before they are summed up per month
    assert re.search(r"Exchange hashpartitioning\((_groupingexpression, ){3}\d+\)", p)


def test_account_sums_join_on_their_own_partitioning(star, large):
    p = plan(analyses.q3_net_impact(star.star))
    left_join = p[p.index("LeftOuter") :]
    before_sums = left_join[: left_join.index("HashAggregate(keys=[account_key]")]
    assert "Exchange" not in before_sums


def test_only_report_lines_meet_in_one_task(star, large):
    """A single-task exchange may carry grouped lines, partition sizes or one aggregate row."""
    jobs = [
        analyses.q1_churned_mrr, analyses.q2_churn_rate, analyses.q3_net_impact, analyses.q4_high_value,
        analyses.q5_profile, analyses.account_quartiles, analyses.concurrent_subscriptions,
    ]
    for job in jobs:
        lines = plan(job(star.star)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1 : i + 4])
                assert "Aggregate" in below, (job.__name__, below)


def test_a_stored_dimension_is_not_broadcast_for_its_small_files(spark, warehouse, tmp_path):
    """600,000 accounts in files that count as less than 10 MB: lookups by id and references by key shuffle them."""
    spark.range(600_000).selectExpr("id AS account_key", "'A-' || id AS account_id", "'x' AS country").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    months = spark.createDataFrame([("a-7", 7), ("a-8", 600_000)], "account_id string, account_key bigint")
    conf = {"autoBroadcastJoinThreshold": "10m", "adaptive__autoBroadcastJoinThreshold": "10m"}
    with settings(spark, **conf):
        # what a plan does by itself with such files
        assert "BroadcastExchange" in plan(check_fk(months, dim, "account_key", "account_key"))
        warehouse()
        orphans = check_fk(months, dim, "account_key", "account_key")
        keyed = lookup_key(months.drop("account_key"), dim, "account_id", "account_key", "left")
        assert "BroadcastExchange" not in plan(orphans) and "BroadcastExchange" not in plan(keyed)
        assert [tuple(r) for r in orphans.collect()] == [(600_000, 1)]
        assert sorted((r["account_id"], r["account_key"]) for r in keyed.collect()) == [("a-7", 7), ("a-8", 8)]


def test_a_hot_account_is_split_over_tasks(spark):
    """A third of the rows on one key: adaptive execution cuts its join partition in pieces."""
    with settings(
        spark,
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="64KB",
    ):
        rows = spark.range(120_000).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, "A-0").otherwise(F.concat(F.lit("A-"), F.col("id"))).alias("account_id"),
        ).repartition(8)
        dim = spark.range(120_000).select(
            F.col("id").alias("account_key"), F.concat(F.lit("a-"), F.col("id")).alias("account_id")
        )
        for how in ("inner", "left"):
            joined = lookup_key(rows, dim, "account_id", "account_key", how)
            assert joined.where("account_key = 0").count() == 40_000
            joined.write.format("noop").mode("overwrite").save()
            found = joined.collect()
            assert len(found) == 120_000
            assert "skew=true" in plan(joined)
