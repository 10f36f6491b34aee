from __future__ import annotations

import pytest

from tidemark.plans.clean import clean_churn_events
from tidemark.schemas import RAW_COLUMNS
from tidemark.sources import ingest_raw, land_raw, publish, raw_rejects, read_raw, read_table, reset_layer, write_table


@pytest.mark.parametrize("table", sorted(RAW_COLUMNS))
def test_text_lands_as_it_is(spark, raw, tmp_path, table):
    """Quotes, blanks, backslashes and line breaks in any column of any table."""
    first, last = RAW_COLUMNS[table][0], RAW_COLUMNS[table][-1]
    df = raw(table, {first: "X-1", last: 'said "no",\nthen\r\nleft'}, {first: "X-2\\n", last: " C:\\new\\\n"}, {last: ""})
    land_raw(df, str(tmp_path / "x"))
    got = read_raw(spark, table, str(tmp_path / "x"), breaks="escaped")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    assert got.count() == 3 and raw_rejects(spark, table, str(tmp_path / "x"), breaks="escaped").count() == 0


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(RAW_COLUMNS["accounts"]) + '\nA-1,"Acme\nLtd",Tech,US,05/01/2023,ads,Pro,3,False,False\n')
    (row,) = read_raw(spark, "accounts", str(tmp_path / "a.csv")).collect()
    assert (row["account_id"], row["account_name"]) == ("A-1", "Acme\nLtd")


def test_columns_are_bound_by_name(spark, tmp_path):
    names = ["account_name", "account_id", "extra", *RAW_COLUMNS["accounts"][2:]]
    (tmp_path / "a.csv").write_text(",".join(names) + "\nAcme,A-1,?,Tech,US,05/01/2023,ads,Pro,3,False,False\n")
    (row,) = read_raw(spark, "accounts", str(tmp_path / "a.csv")).collect()
    assert (row["account_id"], row["account_name"], row["industry"]) == ("A-1", "Acme", "Tech")
    (tmp_path / "b.csv").write_text(",".join(names[1:]) + "\nA-1,?,Tech,US,05/01/2023,ads,Pro,3,False,False\n")
    with pytest.raises(ValueError, match="lacks account_name"):
        read_raw(spark, "accounts", str(tmp_path / "b.csv"))


@pytest.mark.parametrize("breaks", ["quoted", "escaped"])
def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path, breaks):
    good = "A-1,Acme,Tech,US,05/01/2023,ads,Pro,3,False,False"
    lines = [",".join(RAW_COLUMNS["accounts"]), good, "A-2,Short,Tech,US,05/01/2023,ads,Pro", good.replace("A-1", "A-3") + ",more"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    got = read_raw(spark, "accounts", str(tmp_path / "a.csv"), breaks)
    assert [r["account_id"] for r in got.collect()] == ["A-1"] and got.count() == 1
    rejects = raw_rejects(spark, "accounts", str(tmp_path / "a.csv"), breaks)
    assert sorted(r["record"] for r in rejects.collect()) == sorted(lines[2:]) and rejects.count() == 2


def test_an_empty_flag_is_false_and_an_empty_date_missing(spark, tmp_path):
    header = ",".join(RAW_COLUMNS["churn_events"])
    (tmp_path / "e.csv").write_text(f'{header}\nC-1,A-1,,pricing,,,true,,""\n')
    (row,) = clean_churn_events(read_raw(spark, "churn_events", str(tmp_path / "e.csv"))).collect()
    assert (row["churn_date"], row["preceding_upgrade_flag"], row["preceding_downgrade_flag"]) == (None, False, True)
    assert (row["refund_amount_usd"], row["feedback_text"]) == (0, None)


def test_a_folder_of_extracts(spark, raw, tmp_path):
    for table in RAW_COLUMNS:
        land_raw(raw(table, {}), str(tmp_path / table))
    frames = ingest_raw(spark, str(tmp_path), breaks="escaped")
    assert {t: df.count() for t, df in frames.items()} == dict.fromkeys(RAW_COLUMNS, 1)


def test_tables_append_overwrite_partition_and_reset(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 3 AS date_key")
    root = str(tmp_path)
    write_table(df, "star", "fact_subscription_usage", root, partition_by="date_key", tag="t")
    write_table(df, "star", "fact_subscription_usage", root, "append", partition_by="date_key", tag="t")
    table = read_table(spark, "star", "fact_subscription_usage", "t")
    assert table.count() == 20
    assert "PartitionFilters: [isnotnull(date_key" in table.where("date_key = 1")._jdf.queryExecution().toString()
    write_table(df, "star", "fact_subscription_usage", root, partition_by="date_key", tag="t")
    assert read_table(spark, "star", "fact_subscription_usage", "t").count() == 10
    reset_layer(spark, "star", "t")
    assert not spark.catalog.tableExists("tidemark_star_t.fact_subscription_usage")
    reset_layer(spark, "star", "never_created")
    with pytest.raises(ValueError, match="no table"):
        write_table(df, "star", "fact_subscription_usage", root, "append", partition_by="date_key", tag="t")


def test_a_cluster_without_a_shared_folder_is_refused():
    from tidemark import session

    class Unset:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    class Context:
        applicationId, master, _jsc = "elsewhere", "yarn", Unset()

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_results_publish_to_one_file_on_request(spark, tmp_path, fmt):
    df = spark.range(100).repartition(4)
    publish(df, str(tmp_path / "many"), fmt)
    publish(df, str(tmp_path / "one"), fmt, single_file=True)
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert spark.read.format(fmt).option("header", True).load(str(tmp_path / "one")).count() == 100
