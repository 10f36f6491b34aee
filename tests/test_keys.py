from __future__ import annotations

import random
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import (
    active_by_month,
    extend_surrogate_key,
    latest_per_key,
    lookup_key,
    ntile_scalable,
    with_position,
    with_surrogate_key,
)
from tidemark.session import shared_dir


def tiles(n_rows: int, n_tiles: int) -> list[int]:
    """NTILE by its definition."""
    q, r = divmod(n_rows, n_tiles)
    return [t + 1 for t in range(n_tiles) for _ in range(q + (t < r))]


def check_ntile(spark, values, n):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    got = ntile_scalable(df, n, [F.desc_nulls_last("v")], [F.asc("id")], "t").collect()
    order = sorted(got, key=lambda r: (r["v"] is None, -(r["v"] or 0), r["id"]))
    assert [r["t"] for r in order] == tiles(len(values), n)


@pytest.mark.parametrize("n_rows", [1, 3, 4, 5, 1500])
@pytest.mark.parametrize("n", [4, 7])
def test_ntile_equals_the_window_function(spark, n_rows, n):
    rng = random.Random(n_rows)
    check_ntile(spark, [rng.choice([None, 0, 0, rng.randint(0, 300)]) for _ in range(n_rows)], n)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=40), st.integers(1, 6))
def test_ntile_property(spark, values, n):
    check_ntile(spark, values, n)


def test_ntile_against_spark_itself_with_a_value_on_most_rows(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("k"), F.when(F.col("id") < 15_000, F.lit(0)).otherwise(F.col("id")).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mine = ntile_scalable(df, 4, [F.desc("v")], [F.asc("k")], "t")
        plain = df.withColumn("p", F.ntile(4).over(W.orderBy(F.desc("v"), F.asc("k"))))
        assert mine.join(plain, ["k", "v"]).where("t <> p").count() == 0
        assert mine.count() == 20_000
        # the rows that share the value are spread over the sorting tasks
        newest = max(Path(shared_dir(spark), "stage").glob("position-*"), key=lambda p: p.stat().st_mtime_ns)
        written = spark.read.parquet(str(newest)).withColumn("file", F.input_file_name())
        assert written.where("v = 0").select("file").distinct().count() >= 5
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_positions_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "id string")
    assert with_position(df, "pos", [F.col("id")], total="n").collect() == []


def test_surrogate_keys_are_dense_ordered_and_repeatable(spark):
    ids = [f"S-{i}" for i in random.Random(1).sample(range(10_000), 3000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    runs = [
        [(r["k"], r["id"]) for r in with_surrogate_key(df.repartition(p), "k", [F.col("id")]).orderBy("k").collect()]
        for p in (2, 7)
    ]
    assert runs[0] == runs[1] == list(enumerate(sorted(ids), start=1))


def test_new_ids_are_numbered_after_the_known_ones(spark):
    known = spark.createDataFrame([(1, "m", "x"), (2, "p", "y")], "k bigint, id string, v string")
    incoming = spark.createDataFrame([("P", "new"), ("a", "u"), ("b", "w")], "id string, v string")
    got = {r["id"]: (r["k"], r["v"]) for r in extend_surrogate_key(known, incoming, "k", "id").collect()}
    assert got == {"m": (1, "x"), "p": (2, "y"), "a": (3, "u"), "b": (4, "w")}


def test_key_lookup_ignores_case_and_keeps_or_drops_the_unmatched(spark):
    dim = spark.createDataFrame([(2, "pricing"), (3, "budget")], "k int, code string")
    rows = spark.createDataFrame([(1, "Pricing"), (2, "merger"), (3, None)], "id int, code string")
    assert {r["id"]: r["k"] for r in lookup_key(rows, dim, "code", "k").collect()} == {1: 2}
    kept = lookup_key(rows, dim, "code", "k", how="left", default=1)
    assert {r["id"]: r["k"] for r in kept.collect()} == {1: 2, 2: 1, 3: 1}


def test_latest_per_key_cuts_ties_by_the_other_columns(spark):
    rows = [("a", "2", "x"), ("a", "2", "b"), ("a", "1", "a"), ("b", None, "q"), ("b", "1", "z")]
    df = spark.createDataFrame(rows, "k string, d string, v string")
    for parts in (1, 4):
        got = latest_per_key(df.repartition(parts), [F.col("k")], [F.desc_nulls_last("d")], [F.col("v")])
        assert {tuple(r) for r in got.collect()} == {("a", "2", "b"), ("b", "1", "z")}


def test_active_intervals_against_brute_force(spark):
    months = [y * 100 + m for y in (2023, 2024) for m in range(1, 13)]
    horizon = 202410
    rng = random.Random(5)
    rows = []
    for i in range(400):
        s = rng.randrange(20)
        # two thirds of the intervals belong to one key
        rows.append((0 if i % 3 else rng.randrange(5), months[s], rng.choice([None, months[rng.randrange(24)]])))
    # intervals that end before they start, or have no start, never open
    rows += [(9, 202301, None), (9, 202306, 202302), (9, None, None), (9, None, 202303)]
    expected: dict = {}
    for k, s, e in rows:
        for m in months:
            if s is not None and s <= m <= min(e or horizon, horizon):
                expected[k, m] = expected.get((k, m), 0) + 1
    df = spark.createDataFrame(rows, "k int, s int, e int")
    got = active_by_month(df, ["k"], "s", "e", F.lit("2024-10-01").cast("date"), "n").collect()
    assert {(r["k"], r["date_key"]): r["n"] for r in got} == expected
