from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators import quality

from .conftest import by

TARGET = schemas.schema("id bigint, day date, revenue_daily double, note string")
ALIASES = {"revenue_daily": ("daily_revenue",)}


def test_conform_renames_casts_and_fills(frame):
    old = frame(
        "day string, daily_revenue string, id string, extra string",
        ("2024-01-02", "1.5", "7", "x"), ("02.01.2024", "n/a", "seven", "x"), (None, None, None, None),
    )
    got = quality.conform(old, TARGET, ALIASES)
    assert got.schema == TARGET or got.dtypes == [(f.name, f.dataType.simpleString()) for f in TARGET]
    assert [tuple(r) for r in got.collect()] == [
        (7, date(2024, 1, 2), 1.5, None), (None, None, None, None), (None, None, None, None),
    ]


def test_conform_prefers_the_current_name(frame):
    both = frame("revenue_daily double, daily_revenue double", (1.0, 2.0), (None, 3.0))
    assert [r.revenue_daily for r in quality.conform(both, TARGET, ALIASES).collect()] == [1.0, 3.0]


def test_versions_merge(frame):
    a = frame("id bigint, daily_revenue double", (1, 1.0))
    b = frame("revenue_daily string, id string, day date", ("2.0", "2", date(2024, 1, 1)))
    got = by(quality.merge_versions([a, b], TARGET, ALIASES), "id")
    assert got[1]["revenue_daily"] == 1.0 and got[2]["day"] == date(2024, 1, 1)


def test_quarantine_names_every_failed_rule(frame):
    df = frame(
        "id string, event_ts string, value string",
        ("1", "2024-01-01", "5"), (None, None, "5"), ("2", "2024-01-01", "x"), (None, "2024-01-01", "x"),
    )
    rules = {**quality.present("id", "event_ts"), **quality.unreadable(df, schemas.schema("value double"))}
    good, bad = quality.split_valid(df, rules)
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted(r.failed_rules for r in bad.collect()) == [
        ["id_present", "event_ts_present"], ["id_present", "value_readable"], ["value_readable"],
    ]
    assert good.columns == df.columns
    assert tuple(quality.ingest_counts(df, rules).first()) == (4, 1, 3)


def test_undecided_rule_counts_as_failed(frame):
    df = frame("v int", (1,), (None,), (-1,))
    good, bad = quality.split_valid(df, {"positive": F.col("v") > 0})
    assert good.count() == 1 and bad.count() == 2


def test_empty_input(frame):
    df = frame("id string, event_ts string", ("1", "x")).limit(0)
    rules = quality.present("id", "event_ts")
    good, bad = quality.split_valid(df, rules)
    assert good.count() == bad.count() == 0
    assert tuple(quality.ingest_counts(df, rules).first()) == (0, 0, 0)
    assert tuple(quality.key_metrics(df).first()) == (0, 0)
    assert quality.canary(df, ["id"]).first().row_count == 0


def test_key_metrics_and_metric_rows(frame):
    one = quality.key_metrics(frame("id string", ("1",), (None,)))
    got = by(quality.metric_rows(one, "r1", "load"), "metric")
    assert got["total_rows"] == {"run_id": "r1", "job": "load", "metric": "total_rows", "value": 2.0}
    assert got["null_key_rows"]["value"] == 1.0


def test_counts_can_be_stamped(frame):
    df = frame("id string", ("1",))
    moment = datetime(2024, 1, 1, 12)
    assert quality.stamped(quality.key_metrics(df), moment).first().ts == moment
    assert quality.stamped(quality.key_metrics(df)).first().ts is not None


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_canary_sees_changes_but_not_order(spark, algorithm):
    df = spark.range(1000).select("id", F.hash("id").cast("string").alias("v"))
    cols = ["id", "v"]
    compare = lambda other: quality.compare_canaries(df, other, cols, algorithm).first()
    assert compare(df.repartition(7).orderBy(F.desc("id"))).matches
    assert not compare(df.filter("id <> 5")).matches
    changed = df.withColumn("v", F.when(F.col("id") == 5, "other").otherwise(F.col("v")))
    row = compare(changed)
    assert row.source_row_count == row.output_row_count and not row.matches


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_row_hash_tells_null_and_columns_apart(frame, algorithm):
    df = frame("a string, b string", ("x", None), (None, "x"), ("", "x"), ("x", ""), (None, None), ("", ""))
    assert df.select(quality.row_hash(["a", "b"], algorithm)).distinct().count() == 6


def test_manifest_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    listed = quality.manifest(table, ["id"])
    assert listed.count() == 3
    assert listed.agg(F.sum("row_count")).first()[0] == 100
    assert quality.check_manifest(listed, quality.manifest(table, ["id"])).count() == 0
    assert quality.check_manifest(
        listed.unionByName(listed.limit(1).withColumn("path", F.lit("gone"))), listed
    ).first().status == "missing"


def test_manifest_differences(frame):
    listed = frame("path string, row_count bigint, c int", ("a", 1, 1), ("b", 2, 2), ("c", 3, 3), ("d", 4, 4))
    there = frame("path string, row_count bigint, c int", ("a", 1, 1), ("b", 3, 2), ("c", 3, 4), ("e", 4, 4))
    as_manifest = lambda df: df.select("path", "row_count", F.col("c").cast("decimal(30,0)").alias("checksum"))
    got = by(quality.check_manifest(as_manifest(listed), as_manifest(there)), "path")
    assert {p: r["status"] for p, r in got.items()} == {
        "b": "changed", "c": "changed", "d": "missing", "e": "unlisted",
    }


@pytest.fixture
def skewed(spark):
    """95 % of the rows under one key."""
    return spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 20 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        (F.col("id") % 10 / 4).alias("amount"),
    )


def test_skew_report(skewed):
    rows = quality.skew_report(skewed, "key", limit=3, threshold=0.3).collect()
    assert len(rows) == 3
    assert (rows[0].key, rows[0].row_count, rows[0].share, rows[0].is_skewed) == ("hot", 1900, 0.95, True)
    assert not rows[1].is_skewed


def test_salting_balances_partitions(skewed):
    sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes(skewed.repartition(8, "key"))) >= 1900
    salted = quality.salted_repartition(skewed, "key", "id", 64, 8)
    assert max(sizes(salted)) < 600
    assert salted.count() == 2000
    assert quality.salted_repartition(skewed, "key", "id", 64).count() == 2000


def test_salted_totals_equal_plain_totals(skewed):
    plain = skewed.groupBy("key").agg(
        F.count("*").alias("row_count"), F.countDistinct("id").alias("distinct_count"),
        F.sum("amount").alias("total_amount"),
    )
    salted = quality.salted_totals(skewed, "key", "id", "amount", salts=8)
    assert by(salted, "key") == by(plain, "key")


def test_check(caplog):
    assert quality.check({"n": 1}, {"fine": True})
    with pytest.raises(quality.GateFailed, match="share"):
        quality.check({"n": 1}, {"fine": True, "share": False})
    assert quality.check({"n": 1}, {"share": False}, on_fail="warn") is False
    assert "share" in caplog.text
    with pytest.raises(ValueError):
        quality.check({}, {}, on_fail="ignore")


def test_observed_metrics_come_with_the_action(spark):
    df, seen = quality.observed(spark.range(10), "t", [F.count("*").alias("n"), F.max("id").alias("m")])
    assert df.count() == 10
    assert seen.get == {"n": 10, "m": 9}
    rows = by(quality.record_metrics(spark, seen.get, "r1", "load"), "metric")
    assert rows["n"] == {"run_id": "r1", "job": "load", "metric": "n", "value": 10.0}
