from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.scratch import park, shared_folder
from tallyspark.sources import readers, writers

from .conftest import by


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_by_header_name(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        "status,order_id,total_amount,order_date,customer_id,note\n"
        "COMPLETED,o1,12.50,2023-01-12,c1,x\n"
        "COMPLETED,o2,abc,12/01/2023,c1,\n",
    )
    got = by(readers.orders(spark, path), "order_id")
    assert got["o1"] == {
        "order_id": "o1", "customer_id": "c1", "order_date": date(2023, 1, 12), "status": "COMPLETED",
        "total_amount": 12.5,
    }
    assert got["o2"]["order_date"] is None and got["o2"]["total_amount"] is None


def test_customer_and_revenue_csv(spark, tmp_path):
    people = write(
        tmp_path / "customers.csv",
        "customer_id,first_name,last_name,email,signup_date,country,segment\n"
        "c1,Ann,\"O'Neil, Jr\",a@x.org,2021-03-15,IE,Loyal\n",
    )
    row = readers.customers(spark, people).first()
    assert row.signup_date == date(2021, 3, 15) and row.last_name == "O'Neil, Jr"
    money = write(
        tmp_path / "revenue.csv",
        "date,segment,revenue_amount,transaction_count,avg_basket_size\n2023-11-01,New,18.5,2,9.25\n",
    )
    assert tuple(readers.segment_revenue(spark, money).first()) == (date(2023, 11, 1), "New", 18.5, 2, 9.25)


def test_daily_revenue_under_its_former_name(spark, frame, tmp_path):
    path = str(tmp_path / "d")
    frame("date date, segment_id string, daily_revenue double", (date(2024, 1, 1), "s", 5.0)).write.parquet(path)
    row = readers.daily_revenue(spark, path).first()
    assert row.revenue_daily == 5.0 and row.customer_count is None


def test_optional_table(spark, tmp_path):
    assert readers.optional_table(spark, None) is None
    assert readers.account_metadata(spark, str(tmp_path / "absent")) is None
    assert readers.contract_schedule(spark, str(tmp_path / "absent")) is None
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("this is not parquet")
    with pytest.raises(Exception):
        readers.optional_table(spark, str(broken)).count()
    with pytest.raises(AnalysisException):
        readers.read_table(spark, str(tmp_path / "absent"))


LEDGER = "billing_period string, v int"


@pytest.fixture
def ledger_table(monkeypatch):
    monkeypatch.setitem(writers.TABLES, "t", writers.Table(["v", "billing_period"], ["billing_period"]))
    return "t"


def test_overwrite_keeps_other_partitions(spark, frame, tmp_path, ledger_table):
    path = str(tmp_path / "t")
    writers.write_table(frame(LEDGER, ("2024-01", 1), ("2024-02", 2)), ledger_table, path)
    writers.write_table(frame(LEDGER, ("2024-02", 3)), ledger_table, path)
    writers.write_table(frame(LEDGER, ("2024-02", 3)), ledger_table, path)
    rows = readers.read_table(spark, path)
    assert {(r.billing_period, r.v) for r in rows.collect()} == {("2024-01", 1), ("2024-02", 3)}
    assert rows.count() == 2
    assert [r.v for r in readers.read_table(spark, path, periods=["2024-01"]).collect()] == [1]


def test_runs_are_isolated_and_repeatable(spark, frame, tmp_path, ledger_table):
    path = str(tmp_path / "t")
    for run, value in (("a", 1), ("b", 2), ("a", 3)):
        writers.write_table(frame(LEDGER, ("2024-01", value)), ledger_table, path, run_id=run)
    stored = {run: readers.read_table(spark, path, run_id=run).first().v for run in ("a", "b")}
    assert stored == {"a": 3, "b": 2}


def test_columns_are_a_contract(frame, tmp_path, ledger_table):
    short = frame("billing_period string", ("2024-01",))
    with pytest.raises(AnalysisException):
        writers.write_table(short, ledger_table, str(tmp_path / "t"))
    assert writers.project(short, ["v", "billing_period"], allow_missing=True).columns == ["billing_period"]


def test_period_filter_prunes_directories(spark, frame, tmp_path, ledger_table, capsys):
    path = str(tmp_path / "t")
    writers.write_table(frame(LEDGER, ("2024-01", 1), ("2024-02", 2)), ledger_table, path)
    readers.read_table(spark, path, periods=["2024-01"]).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [billing_period" in plan or "PartitionFilters: [isnotnull(billing_period" in plan


def test_writes_are_rebalanced_by_partition(spark, tmp_path, ledger_table, monkeypatch, capsys):
    df = spark.range(100).selectExpr("'2024-01' AS billing_period", "id AS v")
    df.hint("rebalance", *writers.TABLES[ledger_table].partition_by).explain()
    assert "REBALANCE_PARTITIONS_BY_COL" in capsys.readouterr().out
    path = str(tmp_path / "t")
    writers.write_table(df, ledger_table, path)
    assert readers.read_table(spark, path).count() == 100


def test_json_report(spark, frame, tmp_path):
    path = str(tmp_path / "j")
    writers.write_json(frame("a int, d date", (1, date(2024, 1, 1))), path)
    assert spark.read.json(path).first().d == "2024-01-01"


def test_park_cuts_lineage_and_keeps_pushdown(spark, capsys):
    parked = park(spark.range(100).withColumn("v", F.col("id") * 2))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert parked.inputFiles()[0].startswith("file:")
    parked.filter("v > 10").select("v").explain()
    plan = capsys.readouterr().out
    assert "Range" not in plan and "ReadSchema: struct<v:bigint>" in plan and "GreaterThan(v,10)" in plan
    assert parked.count() == 100


def test_snapshot_rerun_leaves_no_stale_partition(frame, spark, tmp_path, monkeypatch):
    monkeypatch.setitem(writers.TABLES, "snap", writers.Table(None, ["seg"], snapshot=True))
    path = str(tmp_path / "snap")
    writers.write_table(frame("id int, seg string", (1, "a"), (2, "b")), "snap", path)
    writers.write_table(frame("id int, seg string", (1, "b")), "snap", path)
    assert [(r.id, r.seg) for r in readers.read_table(spark, path).collect()] == [(1, "b")]


def test_a_run_is_chosen_and_a_rerun_replaces_it(frame, spark, tmp_path, monkeypatch):
    monkeypatch.setitem(writers.TABLES, "snap", writers.Table(None, ["seg"], snapshot=True))
    path = str(tmp_path / "runs")
    for run, seg in (("r1", "a"), ("r2", "a"), ("r1", "b")):
        writers.write_table(frame("id int, seg string", (1, seg)), "snap", path, run_id=run)
        assert [r.seg for r in readers.read_table(spark, path).collect()] == [seg]  # the last by commit
    assert [r.seg for r in readers.read_table(spark, path, run_id="r1").collect()] == ["b"]


def test_csv_files_with_other_header_order(spark, tmp_path):
    folder = tmp_path / "orders"
    folder.mkdir()
    (folder / "1.csv").write_text("order_id,customer_id,order_date,status,total_amount\no1,c1,2024-01-02,paid,5.0\n")
    (folder / "2.csv").write_text("customer_id,order_id,status,order_date,total_amount\nc2,o2,paid,2024-01-03,7.0\n")
    rows = sorted((r.order_id, r.customer_id, r.total_amount) for r in readers.orders(spark, str(folder)).collect())
    assert rows == [("o1", "c1", 5.0), ("o2", "c2", 7.0)]


@pytest.mark.parametrize("runs", [("2024-01", "2024-02"), ("001", "002")])
def test_run_names_that_look_like_dates_or_numbers(frame, spark, tmp_path, ledger_table, runs):
    path = str(tmp_path / "runs")
    for i, run in enumerate(runs):
        writers.write_table(frame(LEDGER, ("2024-01", i)), ledger_table, path, run_id=run)
    assert [r.v for r in readers.read_table(spark, path).collect()] == [1]
    assert [r.v for r in readers.read_table(spark, path, run_id=runs[0]).collect()] == [0]


def csv_folder(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for i in range(40):
        versions = [
            f"order_id,customer_id,order_date,status,total_amount\no{i},c,2024-01-02,paid,5.0\n\n",
            f"﻿order_id,total_amount,when,extra\no{i},7.5,2024-01-03,\"a, b\"\n",
            f"status,order_id,order_id\npaid,o{i},second\nstatus,order_id,order_id\n",
        ]
        (folder / f"{i:02d}.csv").write_text(versions[i % 3])
    (folder / "empty.csv").write_text("")
    return str(folder)


def test_schema_versions_of_many_files(spark, tmp_path):
    path = csv_folder(tmp_path)
    aliases = {"order_date": ["when"]}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv", "csv")
    got = by(readers.read_csv(spark, path, schemas.ORDERS, aliases), "order_id")
    jobs = len(tracker.getJobIdsForGroup("csv"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8 and len(got) == 40  # not one for each file
    assert got["o0"]["total_amount"] == 5.0 and got["o0"]["customer_id"] == "c"
    assert got["o1"] == {"order_id": "o1", "customer_id": None, "order_date": date(2024, 1, 3), "status": None, "total_amount": 7.5}
    assert got["o2"]["status"] == "paid" and got["o2"]["total_amount"] is None
    drift = {tuple(r.columns): r for r in readers.schema_versions(spark, path, schemas.ORDERS, aliases).collect()}
    assert sum(r.files for r in drift.values()) == 40 and len(drift) == 3
    changed = drift["order_id", "total_amount", "when", "extra"]
    assert (changed.missing, changed.unknown, changed.renamed) == (["customer_id", "status"], ["extra"], ["when"])


def test_last_run_is_the_last_written(spark, frame, tmp_path):
    import time

    for run in ("run-10", "run-9", "run-2"):
        frame("v int", (1,)).coalesce(1).write.parquet(str(tmp_path / f"run_id={run}"))
        time.sleep(1.1)
    frame("v int", (1,)).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "run_id=run-9"))
    assert readers.last_run(spark.read.parquet(str(tmp_path))) == "run-9"
