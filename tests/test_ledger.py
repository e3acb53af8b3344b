from datetime import datetime

import pytest

from tallyspark.operators import ledger
from tallyspark.schemas import ACCOUNT_METADATA, BILLING_EVENTS, LEDGER_COLUMNS

from .conftest import by


def at(text):
    return datetime.fromisoformat(text)


def event(n, sub, kind, ts, before, after, account="A", created=None, trial=False):
    return (
        str(n), sub, account, kind, None if ts is None else at(ts), before, after, "p", "monthly", "US",
        at(created or ts or "2024-01-01"), trial,
    )


@pytest.fixture
def events(frame):
    return lambda *rows: frame(BILLING_EVENTS, *rows)


def run(df):
    return ledger.movement_type(ledger.period_net(ledger.one_per_day(ledger.mrr_delta(df))))


def test_valid_events(events):
    ok = event(1, "s", "pause", "2024-01-01", 0, 0)
    df = events(
        ok,
        event(2, "s", "usage", "2024-01-01", 0, 0),
        event(3, "s", "upgrade", None, 0, 0),
        event(4, "s", "upgrade", "2024-01-01", 0, 0, trial=True),
        event(5, "s", "upgrade", "2024-01-01", 0, 0, trial=None),
        event(6, "s", None, "2024-01-01", 0, 0),
    )
    assert [r.event_id for r in ledger.valid_events(df).collect()] == ["1"]


def test_trial_flag_as_text(frame):
    df = frame(
        "event_id string, event_type string, subscription_id string, event_ts timestamp, is_trial string",
        *[(f, "upgrade", "s", at("2024-01-01"), f) for f in ("false", "true", "unknown", None)],
    )
    assert [r.event_id for r in ledger.valid_events(df).collect()] == ["false"]


def test_first_paid_date_as_date(events, frame):
    meta = frame(
        "account_id string, account_tier string, csm_owner string, industry_vertical string,"
        " geo_region string, first_paid_date date",
        ("A", "gold", "kim", "retail", "EU", at("2023-07-09").date()),
    )
    df = events(event(1, "s", "upgrade", "2024-01-05", 0, 5))
    assert ledger.mrr_ledger(df, meta).first().cohort_month == "2023-07"


def test_first_or_last_mutation_of_a_day(events):
    df = events(
        event(3, "s", "upgrade", "2024-01-01 09:00", 0, 1, created="2024-01-01 12:00"),
        event(2, "s", "upgrade", "2024-01-01 18:00", 0, 2, created="2024-01-01 11:00"),
        event(1, "s", "upgrade", "2024-01-01 20:00", 0, 3, created="2024-01-01 12:00"),
        event(4, "s", "upgrade", "2024-01-02 01:00", 0, 4),
        event(5, "t", "upgrade", "2024-01-01 01:00", 0, 5),
    )
    assert {r.event_id for r in ledger.one_per_day(df).collect()} == {"2", "4", "5"}
    assert {r.event_id for r in ledger.one_per_day(df, "last").collect()} == {"3", "4", "5"}
    with pytest.raises(ValueError):
        ledger.one_per_day(df, "any")


def test_ties_on_created_at_go_by_event_id(events):
    df = events(*[event(n, "s", "upgrade", "2024-01-01 09:00", 0, n) for n in (2, 1, 3)])
    assert ledger.one_per_day(df).first().event_id == "1"


def test_missing_amounts_count_as_zero(events):
    row = ledger.mrr_delta(events(event(1, "s", "upgrade", "2024-02-03", None, 500))).first()
    assert (row.mrr_before_safe, row.mrr_after_safe, row.mrr_delta_cents) == (0, 500, 500)
    assert row.billing_period == "2024-02"
    row = ledger.mrr_delta(events(event(1, "s", "cancellation", "2024-02-03", 500, None))).first()
    assert row.mrr_delta_cents == -500


def test_period_takes_last_event_and_net_change(events):
    df = events(
        event(1, "s", "new_subscription", "2024-01-02", 0, 1000),
        event(2, "s", "upgrade", "2024-01-20", 1000, 1599),
        event(3, "s", "downgrade", "2024-02-01", 1599, 1000),
    )
    got = by(run(df), "subscription_id", "billing_period")
    jan, feb = got["s", "2024-01"], got["s", "2024-02"]
    assert (jan["event_id"], jan["net_new_mrr_cents"], jan["net_new_mrr_dollars"]) == ("2", 1599, 15.99)
    assert jan["closing_mrr_dollars"] == 15.99
    assert jan["movement_type"] == "expansion"  # the last event names the net of the month
    assert feb["movement_type"] == "contraction" and feb["net_new_mrr_dollars"] == -5.99


@pytest.mark.parametrize(
    "kind, before, after, expected",
    [
        ("new_subscription", 0, 5, "new_business"),
        ("reactivation", 0, 5, "reactivated"),
        ("upgrade", 1, 5, "expansion"),
        ("upgrade", 5, 5, "neutral"),
        ("upgrade", 5, 1, "neutral"),
        ("plan_change", 1, 5, "expansion"),
        ("plan_change", 5, 1, "contraction"),
        ("plan_change", 5, 5, "neutral"),
        ("downgrade", 5, 1, "contraction"),
        ("downgrade", 1, 5, "neutral"),
        ("cancellation", 5, 0, "churned"),
        ("cancellation", 0, 0, "churned"),
        ("pause", 5, 0, "neutral"),
    ],
)
def test_movement_type(events, kind, before, after, expected):
    df = events(event(1, "s", kind, "2024-01-01", before, after))
    assert run(df).first().movement_type == expected


def test_metadata_is_optional(events, frame):
    df = events(event(1, "s", "upgrade", "2024-01-05", 0, 5), event(2, "u", "upgrade", "2024-01-05", 0, 5, "B"))
    bare = ledger.mrr_ledger(df)
    assert bare.columns == LEDGER_COLUMNS
    assert all(r.geo_region is None and r.cohort_month == "2024-01" for r in bare.collect())

    meta = frame(ACCOUNT_METADATA, ("A", "gold", "kim", "retail", "EU", "2023-07-09"))
    got = by(ledger.mrr_ledger(df, meta), "account_id")
    assert (got["A"]["geo_region"], got["A"]["cohort_month"]) == ("EU", "2023-07")
    assert (got["B"]["geo_region"], got["B"]["cohort_month"]) == (None, "2024-01")


def test_cohort_month_is_the_first_valid_event_of_the_account(events, frame):
    df = events(
        event(1, "s", "upgrade", "2024-03-05", 0, 5),
        event(2, "t", "upgrade", "2024-02-05", 0, 5),
        event(3, "t", "upgrade", "2023-01-05", 0, 5, trial=True),
    )
    meta = frame(ACCOUNT_METADATA, ("A", "gold", "kim", "retail", "EU", "not a date"))
    assert {r.cohort_month for r in ledger.mrr_ledger(df, meta).collect()} == {"2024-02"}


def test_hot_subscription_reaches_the_shuffle_reduced(spark, capsys):
    df = spark.range(100).selectExpr(
        "id AS event_id", "id % 3 AS subscription_id",
        "timestamp_seconds(id * 9000) AS event_ts", "timestamp_seconds(id * 9000) AS created_at",
    )
    ledger.one_per_day(df).explain()
    plan = capsys.readouterr().out
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
