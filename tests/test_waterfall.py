import pytest

from tallyspark.operators import waterfall

from .conftest import by

LEDGER = (
    "subscription_id string, billing_period string, movement_type string,"
    " net_new_mrr_dollars double, closing_mrr_dollars double"
)
METRICS = (
    "billing_period string, nrr_point_in_time double, grr_point_in_time double,"
    " nrr_rolling_12m double, total_beginning_arr_dollars double"
)
CHAINED = [
    ("s", "2024-01", "new_business", 10.0, 10.0),
    ("t", "2024-01", "new_business", 20.0, 20.0),
    ("s", "2024-02", "expansion", 5.5, 15.5),
    ("t", "2024-03", "contraction", -8.0, 12.0),
    ("s", "2024-04", "churned", -15.5, 0.0),
    ("t", "2024-05", "neutral", 3.0, 15.0),
    ("s", "2024-06", "reactivated", 4.0, 4.0),
]


@pytest.fixture
def chained(frame):
    return frame(LEDGER, *CHAINED)


def built(df):
    joined = waterfall.opening_arr(df).join(waterfall.components(df), "billing_period", "full")
    return waterfall.closing_arr(joined)


def test_active_basis_carries_silent_subscriptions(chained):
    got = by(waterfall.opening_arr(chained), "billing_period")
    assert [got[p]["total_closing_mrr"] for p in sorted(got)] == [30.0, 35.5, 27.5, 12.0, 15.0, 19.0]
    assert [got[p]["opening_arr"] for p in sorted(got)] == [None, 360.0, 426.0, 330.0, 144.0, 180.0]


def test_events_basis_sums_the_period(chained):
    got = by(waterfall.opening_arr(chained, "events"), "billing_period")
    assert [got[p]["total_closing_mrr"] for p in sorted(got)] == [30.0, 15.5, 12.0, 0.0, 15.0, 4.0]
    with pytest.raises(ValueError):
        waterfall.opening_arr(chained, "cash")


def test_components_cover_every_movement(chained):
    got = by(waterfall.components(chained), "billing_period")
    assert got["2024-01"]["new_business_arr"] == 360.0 and got["2024-01"]["churn_arr"] == 0.0
    assert got["2024-01"]["churn_mrr"] is None
    assert got["2024-04"]["churn_arr"] == -186.0
    assert got["2024-05"]["neutral_arr"] == 36.0
    assert got["2024-06"]["reactivation_arr"] == 48.0


def test_movements_plus_neutral_explain_the_change(chained):
    for row in built(chained).filter("opening_arr IS NOT NULL").collect():
        assert row.waterfall_closing_arr + row.neutral_arr == pytest.approx(row.total_closing_arr)


def test_reconciliation(chained, frame):
    assert [r.billing_period for r in waterfall.mismatches(built(chained)).collect()] == ["2024-05"]
    with pytest.raises(ValueError, match="1 period.*2024-05.*20.00%"):
        waterfall.require_reconciled(built(chained))
    clean = frame(LEDGER, *[r for r in CHAINED if r[2] != "neutral"])
    waterfall.require_reconciled(built(clean))
    waterfall.require_reconciled(built(chained), tolerance=0.25)


def test_reconciliation_edges(frame):
    df = frame(
        "billing_period string, opening_arr double, waterfall_closing_arr double, total_closing_arr double",
        ("1", None, 1.0, 2.0), ("2", 1.0, 5.0, 0.0), ("3", 1.0, 0.0, 0.0), ("4", 1.0, 101.0, 100.0),
        ("5", 1.0, 102.0, 100.0), ("6", 1.0, -50.0, -100.0), ("7", 1.0, None, 3.0),
    )
    got = by(waterfall.mismatches(df), "billing_period")
    assert {p: r["pct_delta"] for p, r in got.items()} == {"2": 1.0, "5": 0.02, "6": 0.5}
    assert [r.billing_period for r in waterfall.mismatches(df, limit=2).collect()] == ["2", "6"]


def test_blended_nrr(frame):
    df = frame(
        METRICS, ("2024-01", 1.2, 0.9, None, 100.0), ("2024-01", 0.8, 1.0, 1.1, 300.0),
        ("2024-02", None, None, None, 0.0),
    )
    got = by(waterfall.blended_nrr(df), "billing_period")
    assert got["2024-01"]["blended_nrr"] == 0.9
    assert got["2024-01"]["avg_grr"] == pytest.approx(0.95)
    assert got["2024-01"]["avg_nrr_rolling_12m"] == 1.1
    assert got["2024-02"]["blended_nrr"] is None


def test_growth(frame):
    df = frame("billing_period string, total_closing_arr double",
               ("2024-01", 0.0), ("2024-02", 100.0), ("2024-03", 133.333), ("2024-04", -5.0), ("2024-05", 5.0))
    got = by(waterfall.growth(df), "billing_period")
    assert [got[p]["arr_growth_rate"] for p in sorted(got)] == [None, None, 0.3333, -1.0375, None]


def test_whole_waterfall(chained, frame):
    metrics = frame(METRICS, ("2024-02", 1.0, 1.0, None, 10.0))
    got = by(waterfall.arr_waterfall(chained, metrics), "billing_period")
    assert len(got) == 6
    assert got["2024-02"]["blended_nrr"] == 1.0 and got["2024-03"]["blended_nrr"] is None
    assert got["2024-02"]["waterfall_closing_arr"] == 426.0
