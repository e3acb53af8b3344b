from datetime import date, datetime, timedelta
from statistics import mean, stdev

import pytest

from tallyspark.operators import segment

from .conftest import by

DAILY = "date date, segment_id string, revenue_daily double, customer_count bigint, avg_order_value double"
START = date(2024, 1, 1)


def series(values, name="s", step=1):
    return [
        (START + timedelta(days=i * step), name, None if v is None else float(v), 1, 1.0)
        for i, v in enumerate(values)
    ]


def values_of(df, column):
    return [r[column] for r in df.orderBy("date").collect()]


def test_rolling_rows_match_python(frame):
    data = [100 + (i * 37) % 41 for i in range(40)]
    rows = by(segment.rolling_stats(frame(DAILY, *series(data))), "date")
    for i in range(40):
        row = rows[START + timedelta(days=i)]
        week, month = data[max(0, i - 6): i + 1], data[max(0, i - 29): i + 1]
        assert row["revenue_7d_avg"] == pytest.approx(mean(week))
        assert row["revenue_30d_avg"] == pytest.approx(mean(month))
        if i:
            assert row["revenue_7d_std"] == pytest.approx(stdev(week))
            assert row["revenue_30d_std"] == pytest.approx(stdev(month))
            assert row["revenue_bollinger_upper"] == pytest.approx(mean(month) + 2 * stdev(month))
            assert row["revenue_bollinger_lower"] == pytest.approx(mean(month) - 2 * stdev(month))
        else:
            assert row["revenue_7d_std"] is None and row["revenue_bollinger_upper"] is None


def test_rows_and_calendar_frames_differ_on_gaps(frame):
    weekly = frame(DAILY, *series([10, 20, 30], step=7))
    assert values_of(segment.rolling_stats(weekly), "revenue_7d_avg") == [10, 15, 20]
    assert values_of(segment.rolling_stats(weekly, "calendar"), "revenue_7d_avg") == [10, 20, 30]
    with pytest.raises(ValueError):
        segment.rolling_stats(weekly, "days")


def test_segments_do_not_mix(frame):
    df = frame(DAILY, *series([1, 1], "a"), *series([9, 9], "b"))
    got = by(segment.rolling_week(df), "segment_id", "date")
    assert got["a", START + timedelta(1)]["revenue_7d_total"] == 2.0
    assert got["b", START + timedelta(1)]["revenue_7d_total"] == 18.0


def test_daily_series_collapses_duplicates(frame):
    df = frame(DAILY, *series([1.5]), *series([2.5]), *series([7], "t"))
    got = by(segment.daily_series(df), "segment_id", "date")
    assert got["s", START]["revenue_daily"] == 4.0 and got["s", START]["customer_count"] == 2
    assert len(got) == 2


def test_zscore_of_constant_and_first_rows_is_zero(frame):
    stats = segment.rolling_stats(frame(DAILY, *series([5, 5, 5])))
    assert values_of(segment.revenue_zscore(stats), "revenue_zscore") == [0.0, 0.0, 0.0]


def test_zscore_of_missing_revenue_is_null(frame):
    stats = segment.rolling_stats(frame(DAILY, *series([5, 6, None])))
    assert values_of(segment.revenue_zscore(stats), "revenue_zscore")[2] is None


def test_week_over_week_is_seven_rows(frame):
    df = segment.week_over_week(frame(DAILY, *series([0, 8, 0, 0, 0, 0, 0, 4, 6, None])))
    assert values_of(df, "revenue_lag_7d")[6:] == [None, 0.0, 8.0, 0.0]
    assert values_of(df, "revenue_wow_pct_change")[6:] == [None, None, -25.0, None]


def test_spikes(frame):
    df = segment.flag_spikes(segment.rolling_week(frame(DAILY, *series([0, 0, None, 1, 1, 1, 1, 90]))))
    assert values_of(df, "is_spike") == [False, False, False, True, False, False, False, True]
    ratios = values_of(df, "spike_ratio")
    assert ratios[0] is None and ratios[2] is None  # zero average, missing revenue
    assert ratios[3] == pytest.approx(3.0)


def test_totals(frame):
    df = segment.flag_spikes(segment.rolling_week(frame(DAILY, *series([1, 1, 1, 1, 1, 1, 50]), *series([2], "t"))))
    got = by(segment.segment_totals(df), "segment_id")
    assert got["s"]["total_revenue"] == 56.0 and got["s"]["record_count"] == 7
    assert got["s"]["spike_count"] == 1 and got["t"]["spike_count"] == 0


def test_segment_days_join_and_filter(frame):
    df = frame(DAILY, *series([1, 2, 3]), *series([5, 5, 9]), *series([4], "t"))
    meta = frame("segment_id string, tier string", ("s", "gold"))
    got = by(segment.segment_days(df, meta, "2024-01-02"), "segment_id", "date")
    assert set(got) == {("s", date(2024, 1, 2)), ("s", date(2024, 1, 3))}
    last = got["s", date(2024, 1, 3)]
    assert (last["segment_revenue_total"], last["segment_revenue_avg"]) == (12.0, 6.0)
    assert (last["segment_revenue_peak"], last["transaction_count"], last["tier"]) == (9.0, 2, "gold")
    everything = by(segment.segment_days(df, meta), "segment_id", "date")
    assert everything["t", START]["tier"] is None
    assert "tier" not in segment.segment_days(df).columns


def test_rank_is_dense_and_share_sums_to_hundred(frame):
    days = frame(
        "segment_id string, date date, segment_revenue_total double",
        ("a", START, 50.0), ("b", START, 50.0), ("c", START, 25.0), ("d", START, 0.0),
        ("a", date(2024, 1, 2), 0.0),
    )
    ranked = by(segment.revenue_rank(days), "segment_id", "date")
    assert [ranked[k, START]["revenue_rank"] for k in "abcd"] == [1, 1, 2, 3]
    shares = by(segment.contribution_pct(days), "segment_id", "date")
    assert [shares[k, START]["revenue_contribution_pct"] for k in "abcd"] == [40.0, 40.0, 20.0, 0.0]
    assert shares["a", date(2024, 1, 2)]["revenue_contribution_pct"] is None


SCORED = (
    "segment_id string, date date, revenue_daily double, revenue_7d_avg double,"
    " revenue_30d_avg double, revenue_zscore double"
)


@pytest.mark.parametrize(
    "revenue, average, z, ratio, severity",
    [
        (10.0, 10.0, 3.5, 1.0, "P1_CRITICAL"),
        (10.0, 10.0, -3.5, 1.0, "P1_CRITICAL"),
        (10.0, 10.0, 3.4999, 1.0, "P2_WARNING"),
        (10.0, 10.0, 2.0, 1.0, "P2_WARNING"),
        (10.0, 10.0, 1.9999, 1.0, "NORMAL"),
        (25.0, 10.0, 0.0, 2.5, "P2_WARNING"),
        (24.9, 10.0, 0.0, 2.49, "NORMAL"),
        (25.0, 0.0, 0.0, 1.0, "NORMAL"),
        (25.0, None, 0.0, 1.0, "NORMAL"),
        (25.0, 10.0, None, 2.5, "P2_WARNING"),
        (5.0, 10.0, None, 0.5, "NORMAL"),
    ],
)
def test_threshold_edges(frame, revenue, average, z, ratio, severity):
    row = segment.threshold_scores(frame(SCORED, ("s", START, revenue, average, average, z))).first()
    assert row.spike_ratio == pytest.approx(ratio) and row.anomaly_severity == severity


def test_thresholds_are_parameters(frame):
    df = frame(SCORED, ("s", START, 15.0, 10.0, 10.0, 2.4))
    assert segment.threshold_scores(df, z_threshold=2.5).first().anomaly_severity == "NORMAL"
    assert segment.threshold_scores(df, 2.5, multiplier=1.5).first().anomaly_severity == "P2_WARNING"


def test_description(frame):
    df = segment.threshold_scores(
        frame(
            SCORED,
            ("s", START, 1234.5, 400.126, 1.0, 3.456),
            ("t", START, 1.0, 1.0, 1.0, 0.0),
            ("u", START, 9.0, 1.0, 1.0, None),
        )
    )
    got = by(df, "segment_id")
    assert got["s"]["anomaly_description"] == (
        "Segment s recorded revenue=1234.5 vs 7d_avg=400.13 (z=3.46)"
    )
    assert got["t"]["anomaly_description"] is None
    assert got["u"]["anomaly_severity"] == "P2_WARNING" and got["u"]["anomaly_description"] is None
    assert {r.segment_id for r in segment.anomalies_only(df).collect()} == {"s", "u"}
    assert len(segment.anomalies_only(df).columns) == 9


def test_rate_and_summary(frame):
    df = segment.threshold_scores(
        frame(SCORED, ("s", START, 9.0, 9.0, 9.0, 4.0), ("s", date(2024, 1, 2), 3.0, 3.0, 3.0, 0.0),
              ("s", date(2024, 1, 3), 3.0, 3.0, 3.0, 0.0), ("t", START, 1.0, 1.0, 1.0, 0.0))
    )
    got = by(segment.anomaly_rate(df), "segment_id")
    assert (got["s"]["total_days"], got["s"]["anomaly_days"], got["s"]["anomaly_rate_pct"]) == (3, 1, 33.33)
    assert got["s"]["avg_revenue"] == 5.0 and got["t"]["stddev_revenue"] is None
    row = segment.summary_stats(df).first()
    assert tuple(row) == (16.0, 4.0, 9.0, 1.0, 2, 1)
    assert segment.summary_stats(df, datetime(2024, 3, 1)).first().generated_at == datetime(2024, 3, 1)


def test_report(frame):
    base = frame(DAILY, *series([10, 20]))
    scored = segment.threshold_scores(segment.revenue_zscore(segment.rolling_stats(base)))
    report = segment.performance_report(scored, "2024-02-01", day="2024-01-02")
    row = report.first()
    assert report.count() == 1
    assert (row.report_date, row.date, row.revenue_daily) == (date(2024, 2, 1), date(2024, 1, 2), 20.0)
    short = segment.performance_report(scored.drop("customer_count"), "2024-02-01", allow_missing=True)
    assert "customer_count" not in short.columns and short.count() == 2
    with pytest.raises(Exception, match="customer_count"):
        segment.performance_report(scored.drop("customer_count"), "2024-02-01")
