import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from tallyspark.operators import alerts, ranks, segment

from .conftest import by


def rows(seed, n=400):
    rng = random.Random(seed)
    groups = ["hot"] * 5 + ["a", "b", None]
    return [(rng.choice(groups), rng.choice([None, *range(12)]), i) for i in range(n)]


@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_as_the_window_gives_it(spark, frame, descending):
    df = frame("g string, v int, id int", *rows(1)).repartition(5)
    order = F.col("v").desc() if descending else F.col("v").asc()
    want = df.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(order)))
    found = ranks.dense_ranks(df, ["g"], "v", descending=descending)
    assert found.dtypes == want.dtypes
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_row_numbers_over_slices(spark, frame):
    df = frame("g string, v int, id int", *rows(2)).repartition(3)
    order = [F.col("v").asc_nulls_first(), F.col("id")]
    want = df.withColumn("row_number", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    found = ranks.row_numbers(df, ["g"], order)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert ranks.row_numbers(df.where("false"), ["g"], order).count() == 0


def test_a_day_with_many_segments_fills_many_tasks(spark):
    days = spark.range(4000).selectExpr("concat('s', id) segment_id", "date'2024-01-01' date", "cast(id % 1000 as double) segment_revenue_total")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = segment.revenue_rank(days)
        assert found.agg(F.max("revenue_rank")).first()[0] == 1000
        tasks = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 2000


def test_share_of_a_day(frame):
    df = frame("segment_id string, date date, segment_revenue_total double",
               ("a", date(2024, 1, 1), 1.0), ("b", date(2024, 1, 1), 2.0), ("a", date(2024, 1, 2), 0.0), ("a", None, 4.0))
    got = by(segment.contribution_pct(df), "segment_id", "date")
    assert got["a", date(2024, 1, 1)]["revenue_contribution_pct"] == 33.33
    assert got["a", date(2024, 1, 2)]["revenue_contribution_pct"] is None and got["a", None]["revenue_contribution_pct"] == 100.0


SCORED = "segment_id string, date date, revenue_daily double, revenue_7d_avg double, revenue_zscore double, anomaly_severity string, anomaly_description string"


def test_payloads_of_bounded_size(frame):
    start = date(2024, 1, 1)
    scored = [("big", start + timedelta(i % 50), 1.5 * i, 2.0, 3.0, "P1_CRITICAL", f"d{i}") for i in range(103)]
    scored += [("big", start, 1.0, 1.0, 0.0, "NORMAL", None), ("calm", start, 1.0, 1.0, 0.0, "NORMAL", None)]
    scored += [("even", start, 1.0, 1.0, 9.0, "P2_WARNING", "x")] * 10
    df = frame(SCORED, *scored).repartition(4)
    got = by(alerts.alert_payload_chunks(df, "2024-02-01", most=10), "segment_id", "chunk")
    assert {k for k in got if k[0] == "big"} == {("big", i) for i in range(1, 12)} and ("calm", 1) in got
    assert {s: (r["chunks"], r["anomaly_count"]) for (s, _), r in got.items()} == {"big": (11, 103), "calm": (1, 0), "even": (1, 10)}
    listed = []
    for i in range(1, 12):
        payload = json.loads(got["big", i]["payload"])
        assert (payload["chunk"], payload["chunks"]) == (i, 11) and 0 < len(payload["anomalies"]) <= 10
        listed += payload["anomalies"]
    assert sorted(e["description"] for e in listed) == sorted(f"d{i}" for i in range(103))
    assert [e["date"] for e in listed] == sorted(e["date"] for e in listed)
    assert json.loads(got["calm", 1]["payload"])["anomalies"] == []
    whole = by(alerts.alert_payloads(df, "2024-02-01"), "segment_id")["even"]
    one = json.loads(got["even", 1]["payload"])
    assert json.loads(whole["payload"]) == {k: v for k, v in one.items() if k not in ("chunk", "chunks")}
