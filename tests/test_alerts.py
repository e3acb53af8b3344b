import json
from datetime import date

from tallyspark.operators import alerts

from .conftest import by

SCORED = (
    "segment_id string, date date, revenue_daily double, revenue_7d_avg double, revenue_zscore double,"
    " anomaly_severity string, anomaly_description string"
)


def test_payload(frame):
    df = frame(
        SCORED,
        ("s", date(2024, 1, 3), 30.0, 10.005, 3.6, "P1_CRITICAL", 'say "hi"'),
        ("s", date(2024, 1, 1), 12_345_678.9, 10.0, None, "P2_WARNING", None),
        ("s", date(2024, 1, 2), 1.0, 1.0, 0.0, "NORMAL", None),
        ("t", date(2024, 1, 1), 1.0, 1.0, 0.0, "NORMAL", None),
    )
    got = by(alerts.alert_payloads(df, "2024-02-01"), "segment_id")
    s, t = json.loads(got["s"]["payload"]), json.loads(got["t"]["payload"])
    assert s["schema_version"] == "v2" and s["report_date"] == "2024-02-01" and s["segment_id"] == "s"
    assert s["metrics"] == {"revenue_daily": 4115236.63, "total_revenue": 12345709.9, "anomaly_count": 2}
    assert [a["date"] for a in s["anomalies"]] == ["2024-01-01", "2024-01-03"]
    assert s["anomalies"][0] == {
        "segment_id": "s", "date": "2024-01-01", "revenue_actual": 12345678.9, "revenue_expected": 10.0,
        "zscore": None, "severity": "P2_WARNING", "description": None,
    }
    assert s["anomalies"][1]["description"] == 'say "hi"' and s["anomalies"][1]["revenue_expected"] == 10.01
    assert t["anomalies"] == [] and t["metrics"]["anomaly_count"] == 0


def test_failure_signals(frame):
    log = frame(
        "job_id string, run_id string, timestamp string, error_signature string, log_excerpt string,"
        " artifacts array<string>, code_paths array<string>, config map<string,string>",
        ("j", "r", "t", "sig", "text", ["a.log"], None, None),
        ("k", "r", "t", "sig", None, None, ["m.py"], {"retries": "2"}),
    )
    got = by(alerts.failure_signals(log), "job_id")
    assert got["j"]["artifacts"] == ["a.log"] and got["j"]["code_paths"] == [] and got["j"]["config"] == {}
    k = json.loads(got["k"]["payload"])
    assert k["platform"] == "aws" and k["config"] == {"retries": "2"} and k["log_excerpt"] is None
    assert by(alerts.failure_signals(log, "onprem"), "job_id")["j"]["platform"] == "onprem"
