from datetime import date

import pytest

from tallyspark.operators import allocation
from tallyspark.schemas import CONTRACT_SCHEDULE

from .conftest import by

LEDGER = (
    "subscription_id string, billing_period string, billing_interval string, closing_mrr_dollars double"
)


def expanded(df):
    return allocation.expand_months(allocation.monthly_allocation(allocation.contract_months(df)))


@pytest.mark.parametrize(
    "interval, months",
    [("monthly", 1), ("Quarterly", 3), ("ANNUAL", 12), ("biennial", 24), ("weekly", 1), (None, 1)],
)
def test_duration_and_expansion(frame, interval, months):
    df = frame(LEDGER, ("s", "2023-11", interval, 120.0))
    assert allocation.contract_months(df).first().contract_duration_months == months
    periods = sorted(r.allocated_period for r in expanded(df).collect())
    assert len(periods) == months and periods[0] == "2023-11"
    if months == 3:
        assert periods == ["2023-11", "2023-12", "2024-01"]
    if months == 24:
        assert periods[-1] == "2025-10"


def test_rounding_to_cents(frame):
    df = frame(LEDGER, ("s", "2024-01", "quarterly", 100.0), ("t", "2024-01", "quarterly", 0.0))
    got = by(allocation.rounding_difference(allocation.monthly_allocation(allocation.contract_months(df))), "subscription_id")
    assert got["s"]["allocated_mrr_cents_per_month"] == 3333
    assert got["s"]["allocated_mrr_dollars_per_month"] == 33.33
    assert got["s"]["allocation_rounding_diff"] == -0.01
    assert got["t"]["allocation_rounding_diff"] == 0.0


def test_both_rounding_checks_agree_and_stay_within_half_a_cent_per_month(spark):
    from pyspark.sql import functions as F

    names = F.array(*[F.lit(x) for x in ("monthly", "quarterly", "annual", "biennial")])
    df = spark.range(500).select(
        F.concat(F.lit("s"), "id").alias("subscription_id"),
        F.lit("2024-01").alias("billing_period"),
        names[(F.col("id") % 4).cast("int")].alias("billing_interval"),
        (F.pmod(F.hash("id"), F.lit(99999)) / 100).alias("closing_mrr_dollars"),
    )
    allocated = allocation.monthly_allocation(allocation.contract_months(df))
    early = allocation.expand_months(allocation.rounding_difference(allocated))
    late = allocation.reconcile_expanded(allocation.expand_months(allocated))
    cols = ["subscription_id", "allocated_period", "sum_allocated_mrr", "allocation_rounding_diff"]
    assert early.select(cols).exceptAll(late.select(cols)).count() == 0
    half_cents = F.col("contract_duration_months") * 0.005 + 1e-9
    assert early.filter(F.abs("allocation_rounding_diff") > half_cents).count() == 0


def test_deferred_balance(frame):
    df = frame(LEDGER, ("s", "2024-01", "quarterly", 90.0))
    recurring = by(allocation.deferred_balance(expanded(df)), "months_elapsed")
    assert [recurring[i]["recognised_revenue_dollars"] for i in range(3)] == [30.0, 60.0, 90.0]
    assert [recurring[i]["recognised_in_period_dollars"] for i in range(3)] == [30.0, 30.0, 30.0]
    assert [recurring[i]["deferred_revenue_balance_dollars"] for i in range(3)] == [240.0, 210.0, 180.0]
    upfront = by(allocation.deferred_balance(expanded(df), "upfront"), "months_elapsed")
    assert [upfront[i]["deferred_revenue_balance_dollars"] for i in range(3)] == [60.0, 30.0, 0.0]
    with pytest.raises(ValueError):
        allocation.deferred_balance(expanded(df), "cash")


def test_deferred_never_negative_and_null_stays_null(frame):
    df = frame(LEDGER, ("s", "2024-01", "quarterly", 0.05), ("t", "2024-01", "monthly", None))
    got = by(allocation.deferred_balance(expanded(df), "upfront"), "subscription_id", "months_elapsed")
    assert got["s", 2]["deferred_revenue_balance_dollars"] == 0.0  # 3 x 2 cents recognised of 5
    assert got["t", 0]["deferred_revenue_balance_dollars"] is None


def test_status_by_period(frame):
    df = frame("allocated_period string", ("2024-05",), ("2024-06",), ("2024-07",))
    for as_of in ("2024-06-30", date(2024, 6, 1)):
        got = by(allocation.recognition_status(df, as_of), "allocated_period")
        assert [got[p]["recognition_status"] for p in sorted(got)] == ["recognised", "current", "future"]


def test_status_beyond_contract(frame):
    df = frame(
        "allocated_period string, contract_end date",
        ("2024-05", date(2024, 5, 1)), ("2024-06", date(2024, 5, 31)), ("2024-07", None),
    )
    got = by(allocation.recognition_status(df, "2024-06-15"), "allocated_period")
    assert [got[p]["recognition_status"] for p in sorted(got)] == ["recognised", "beyond_contract", "future"]


def test_duplicate_contracts_do_not_fan_out(frame):
    schedule = frame(
        CONTRACT_SCHEDULE,
        ("s", date(2023, 1, 1), date(2023, 12, 31), 100, "annual", "N"),
        ("s", date(2024, 1, 1), date(2024, 12, 31), 200, "annual", "Y"),
        ("s", date(2023, 6, 1), None, 300, "annual", "N"),
    )
    df = frame(LEDGER, ("s", "2024-01", "annual", 10.0), ("t", "2024-01", "annual", 10.0))
    got = by(allocation.contract_terms(df, schedule), "subscription_id")
    assert (got["s"]["contract_arr_cents"], got["s"]["auto_renew"]) == (200, "Y")
    assert got["t"]["contract_arr_cents"] is None
    whole = allocation.allocate_revenue(df, "2024-03-01", schedule)
    assert whole.count() == 24
    assert {"contract_arr_cents", "auto_renew", "recognition_status"} <= set(whole.columns)


def test_allocation_without_schedule_never_shuffles(spark, capsys):
    df = spark.range(100).selectExpr(
        "id AS subscription_id", "'2024-01' AS billing_period", "'annual' AS billing_interval",
        "id * 1.5D AS closing_mrr_dollars",
    )
    allocation.allocate_revenue(df, "2024-03-01").explain()
    plan = capsys.readouterr().out
    assert "Generate explode" in plan and "Exchange" not in plan


SCHEDULE = (
    "subscription_id string, contract_start date, contract_end date, contract_arr_cents bigint,"
    " billing_interval string, auto_renew string"
)


def test_each_month_has_the_contract_in_force(frame):
    """Two contracts with a gap: the months between them are beyond the first."""
    ledger = frame(
        "subscription_id string, billing_period string, billing_interval string, closing_mrr_dollars double, v int",
        ("s", "2023-05", "annual", 12.0, 1), ("s", "2022-11", "monthly", 5.0, 2), ("s", "2024-03", "monthly", 5.0, 3),
        ("none", "2023-05", "monthly", 5.0, 4), ("open", "2023-05", "quarterly", 3.0, 5),
    )
    schedule = frame(
        SCHEDULE,
        ("s", date(2023, 1, 1), date(2023, 6, 30), 100, "annual", "N"),
        ("s", date(2024, 1, 1), date(2024, 2, 28), 300, "annual", "Y"),
        ("s", date(2024, 1, 15), date(2024, 12, 31), 250, "annual", "N"),  # the later of two in one month
        ("s", date(2026, 1, 1), None, 999, "annual", "N"),
        ("open", None, None, 7, "monthly", "N"), ("open", date(2023, 7, 1), date(2023, 7, 31), 8, "monthly", "Y"),
        ("other", date(2023, 1, 1), None, 1, "monthly", "N"), (None, date(2023, 1, 1), None, 1, "monthly", "N"),
    )
    got = by(allocation.allocate_revenue(ledger, "2023-09-10", schedule), "subscription_id", "billing_period", "allocated_period")
    assert len(got) == 12 + 1 + 1 + 1 + 3 and {r["v"] for r in got.values()} == {1, 2, 3, 4, 5}
    status = {p: (r["contract_arr_cents"], r["recognition_status"]) for (s, b, p), r in got.items() if b == "2023-05" and s == "s"}
    assert status["2023-05"] == status["2023-06"] == (100, "recognised")
    assert {status[f"2023-{m:02d}"] for m in range(7, 13)} == {(100, "beyond_contract")}
    assert {status[f"2024-{m:02d}"] for m in range(1, 5)} == {(250, "future")}
    assert got["s", "2022-11", "2022-11"]["contract_arr_cents"] is None  # before the first contract
    assert got["s", "2022-11", "2022-11"]["recognition_status"] == "recognised"
    assert got["s", "2024-03", "2024-03"]["contract_end"] == date(2024, 12, 31)
    assert got["none", "2023-05", "2023-05"]["recognition_status"] == "recognised"
    assert [got["open", "2023-05", f"2023-0{m}"]["contract_arr_cents"] for m in (5, 6, 7)] == [7, 7, 8]


def test_a_contract_that_ends_before_the_billing_month(frame):
    ledger = frame("subscription_id string, billing_period string, billing_interval string, closing_mrr_dollars double",
                   ("s", "2023-05", "monthly", 12.0))
    schedule = frame(SCHEDULE, ("s", date(2022, 1, 1), date(2022, 12, 31), 100, "annual", "N"))
    row = allocation.allocate_revenue(ledger, "2023-09-10", schedule).first()
    assert row.recognition_status == "beyond_contract" and row.contract_end_period == "2022-12"
