from datetime import date, datetime, timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import alerts, anomaly

from .conftest import by

SERIES = "date date, segment string, revenue_amount double, transaction_count int, avg_basket_size double"
START = date(2024, 1, 1)


def series(values, name="s"):
    return [(START + timedelta(days=i), name, v if v is None else float(v), 2, 5.0) for i, v in enumerate(values)]


def quiet(n=45):
    return [100 + (i * 7) % 5 for i in range(n)]


def test_plausible_rows_only(frame):
    df = frame(SERIES, *series([1, -1, None, 0]), (None, "s", 5.0, 1, 1.0))
    assert sorted(r.revenue_amount for r in anomaly.plausible_revenue(df).collect()) == [0.0, 1.0]


def test_daily_series_collapses_only_duplicates(frame):
    df = frame(SERIES, *series([1.25, 7]), (START, "s", 2.5, 3, 7.0), (START, "t", None, None, None))
    got = by(anomaly.daily_series(df), "segment", "date")
    assert tuple(got["s", START].values())[2:] == (3.75, 5, 6.0)
    assert tuple(got["s", START + timedelta(1)].values())[2:] == (7.0, 2, 5.0)
    assert got["t", START]["revenue_amount"] is None


def test_windows_match_python(frame):
    data = [100 + (i * 37) % 41 for i in range(40)]
    rows = by(anomaly.rolling_windows(frame(SERIES, *series(data))), "row_num")
    assert sorted(rows) == list(range(1, 41))
    for n in (2, 7, 8, 30, 31, 40):
        week, month = data[max(0, n - 7): n], data[max(0, n - 30): n]
        assert rows[n]["ma_7d"] == round(mean(week), 4)
        assert rows[n]["std_30d"] == pytest.approx(stdev(month), abs=1e-4)
        assert (rows[n]["min_7d"], rows[n]["max_30d"]) == (min(week), max(month))
        assert rows[n]["prev_day_revenue"] == data[n - 2]
        assert rows[n]["pct_change_1d"] == pytest.approx((data[n - 1] / data[n - 2] - 1) * 100, abs=1e-4)
        assert rows[n]["tx_count_7d_avg"] == 2.0 and rows[n]["basket_7d_avg"] == 5.0
    assert rows[1]["std_7d"] is None and rows[1]["pct_change_1d"] is None


def test_change_from_zero_uses_one_as_base(frame):
    rows = by(anomaly.rolling_windows(frame(SERIES, *series([0, 3]))), "row_num")
    assert rows[2]["pct_change_1d"] == 300.0


def test_lookback_takes_effect(frame):
    rows = by(anomaly.rolling_windows(frame(SERIES, *series(range(20))), lookback=10), "row_num")
    assert rows[20]["ma_30d"] == 14.5


def test_first_row_is_undecided_and_constant_series_is_calm(frame):
    rows = by(anomaly.score(anomaly.rolling_windows(frame(SERIES, *series([5, 5, 5])))), "row_num")
    assert rows[1]["zscore_30d"] == 0.0 and rows[1]["is_zscore_anomaly"] is False
    assert rows[1]["is_bollinger_breach"] is None and rows[1]["is_anomaly"] is None
    assert rows[3]["zscore_30d"] == 0.0 and rows[3]["is_anomaly"] is False


def test_planted_spike_and_dip(frame):
    data = quiet()
    data[33], data[40] = 0, 400
    scored = anomaly.score(anomaly.rolling_windows(frame(SERIES, *series(data))))
    found = by(anomaly.alerts(scored), "date")
    dip, spike = found[START + timedelta(33)], found[START + timedelta(40)]
    assert spike["anomaly_direction"] == "SPIKE" and spike["severity_band"] == "CRITICAL"
    assert spike["severity_score"] == 10.0
    assert dip["anomaly_direction"] == "DIP"
    assert spike["revenue_deviation_abs"] == pytest.approx(400 - spike["ma_30d"], abs=1e-4)
    assert spike["reference_revenue_usd"] == 400.0
    assert START not in found


FLAGS = (
    "zscore_30d double, pct_change_1d double, is_zscore_anomaly boolean, is_bollinger_breach boolean"
)


@pytest.mark.parametrize(
    "z, pct, far, outside, expected",
    [
        (None, 50.0, True, True, 0.0),
        (2.5, None, False, None, 4.0),
        (-2.5, 20.0, False, True, 4.0),
        (1.0, 25.0, False, False, 2.1),  # 1.6 + 0.5
        (1.0, -60.0, False, False, 3.6),  # momentum capped at 2
        (9.0, 0.0, True, False, 6.0),  # base capped at 6
        (9.0, 0.0, True, True, 8.0),
        (9.0, 99.0, True, True, 10.0),
        (9.0, 99.0, True, None, 8.0),
    ],
)
def test_severity(frame, z, pct, far, outside, expected):
    df = frame(FLAGS, (z, pct, far, outside))
    assert anomaly.with_severity(df).first().severity_score == expected


def test_severity_threshold_is_a_parameter(frame):
    df = frame(FLAGS, (2.0, None, False, False))
    assert anomaly.with_severity(df, z_threshold=4.0).first().severity_score == 2.0


def test_alerts_carry_metrics_of_their_segment(frame):
    data = quiet()
    data[40] = 400
    scored = anomaly.score(anomaly.rolling_windows(frame(SERIES, *series(data, "Loyal"), *series(data, "Odd"))))
    rfm = frame(
        "customer_id string, rfm_segment string, monetary_value double, rfm_composite double,"
        " churn_risk_score double",
        ("a", "Loyal", 10.0, 4.0, 1.0), ("b", "Loyal", 30.0, 3.5, 2.0), ("c", "New", 1.0, 1.0, 4.0),
    )
    metrics = anomaly.segment_metrics(rfm)
    loyal = by(metrics, "segment")["Loyal"]
    assert loyal["segment_customer_count"] == 2 and loyal["segment_avg_monetary"] == 20.0
    assert loyal["segment_total_monetary"] == 40.0 and loyal["segment_avg_rfm"] == 3.75
    stamp = datetime(2024, 3, 1)
    found = by(anomaly.alerts(scored, metrics, stamp), "segment", "date")
    day = START + timedelta(40)
    assert found["Loyal", day]["segment_customer_count"] == 2
    assert found["Odd", day]["segment_customer_count"] is None
    assert found["Odd", day]["alert_generated_at"] == stamp


def test_summary_rate_and_route(frame):
    found = frame(
        "severity_band string, anomaly_direction string, severity_score double, revenue_deviation_pct double",
        ("LOW", "DIP", 1.0, -10.0), ("LOW", "DIP", 2.0, -20.0), ("HIGH", "SPIKE", 6.0, 50.0),
    )
    rows = anomaly.alert_summary(found).collect()
    assert [(r.severity_band, r.alert_count, r.avg_severity) for r in rows] == [("HIGH", 1, 6.0), ("LOW", 2, 1.5)]
    assert alerts.escalation_route(found).first().alert_type == "NONE"
    many = found.unionAll(found)
    assert alerts.escalation_route(many).first().alert_type == "HIGH_VOLUME_ANOMALY"
    critical = found.withColumn("severity_band", F.lit("CRITICAL"))
    assert alerts.escalation_route(critical).first().alert_type == "CRITICAL_REVENUE_ANOMALY"

    flags = frame("is_anomaly boolean", (True,), (False,), (None,))
    rate = anomaly.alert_rate(flags, 0.3).first()
    assert (rate.total_rows, rate.anomaly_rows, rate.exceeds_limit) == (3, 1, True)
    empty = anomaly.alert_rate(flags.limit(0)).first()
    assert (empty.anomaly_rate, empty.exceeds_limit) == (0.0, False)
