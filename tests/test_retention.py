import pytest

from tallyspark.operators import retention

from .conftest import by

MATRIX = (
    "cohort_month string, billing_period string, cohort_index int, geo_region string,"
    " account_count bigint, churned_account_count bigint, total_beginning_arr_dollars double,"
    " expansion_arr_dollars double, contraction_arr_dollars double, churn_arr_dollars double"
)
DIMS = ["geo_region"]


def cell(i=1, begin=100.0, exp=0.0, con=0.0, churn=0.0, accounts=5, lost=0, month="2024-01"):
    period = f"{2024 + i // 12}-{i % 12 + 1:02d}"
    return (month, period, i, "EU", accounts, lost, begin, exp, con, churn)


@pytest.mark.parametrize(
    "begin, exp, con, churn, nrr, grr",
    [
        (100.0, 20.0, -10.0, -5.0, 1.05, 0.85),
        (100.0, 50.0, 0.0, 0.0, 1.5, 1.0),
        (100.0, 0.0, 5.0, 0.0, 1.05, 1.0),  # wrong sign upstream: GRR stays capped
        (0.0, 5.0, 0.0, 0.0, None, None),
        (-5.0, 5.0, 0.0, 0.0, None, None),
        (100.0, None, 0.0, 0.0, None, 1.0),
        (100.0, 0.0, None, 0.0, None, None),  # unknown is not full retention
    ],
)
def test_point_in_time(frame, begin, exp, con, churn, nrr, grr):
    row = retention.point_in_time(frame(MATRIX, cell(1, begin, exp, con, churn))).first()
    assert (row.nrr_point_in_time, row.grr_point_in_time) == (nrr, grr)


def test_rolling_needs_a_year_and_sums_before_dividing(frame):
    rows = [cell(i, begin=100.0 * (i + 1), exp=10.0, churn=-20.0) for i in range(14)]
    got = by(retention.rolling_nrr(frame(MATRIX, *rows), DIMS), "cohort_index")
    assert got[10]["nrr_rolling_12m"] is None
    assert got[11]["rolling_12m_beginning_arr"] == 7800.0
    assert got[11]["nrr_rolling_12m"] == round((7800 + 120 - 240) / 7800, 6)
    assert got[13]["rolling_12m_beginning_arr"] == sum(100.0 * (i + 1) for i in range(2, 14))


def test_rolling_rows_and_range_differ_on_gaps(frame):
    rows = [cell(i) for i in (0, 1, 20)]
    by_rows = by(retention.rolling_nrr(frame(MATRIX, *rows), DIMS), "cohort_index")
    by_range = by(retention.rolling_nrr(frame(MATRIX, *rows), DIMS, "range"), "cohort_index")
    assert by_rows[20]["rolling_12m_beginning_arr"] == 300.0
    assert by_range[20]["rolling_12m_beginning_arr"] == 100.0
    with pytest.raises(ValueError):
        retention.rolling_nrr(frame(MATRIX, *rows), DIMS, "months")


def test_logo_retention_counts_partial_churn(frame):
    df = frame(MATRIX, cell(1, churn=-5.0, accounts=3, lost=1), cell(2, accounts=0), cell(3))
    got = by(retention.logo_retention(df), "cohort_index")
    assert (got[1]["churned_accounts"], got[1]["logo_retention_rate"]) == (1, 0.6667)
    assert got[2]["logo_retention_rate"] is None and got[3]["logo_retention_rate"] == 1.0
    whole = by(retention.logo_retention(df, "as_written"), "cohort_index")
    assert (whole[1]["churned_accounts"], whole[1]["logo_retention_rate"]) == (3, 0.0)


def test_recognised_revenue(frame):
    alloc = frame(
        "cohort_month string, allocated_period string, recognition_status string,"
        " recognised_in_period_dollars double, recognised_revenue_dollars double",
        ("2024-01", "2024-02", "recognised", 1.1, 10.0), ("2024-01", "2024-02", "current", 2.2, 20.0),
        ("2024-01", "2024-02", "future", 4.0, 40.0), ("2024-01", "2024-02", "beyond_contract", 8.0, 80.0),
    )
    df = frame(MATRIX, cell(1), cell(2))
    got = by(retention.recognised_revenue(df, alloc), "cohort_index")
    assert got[1]["total_recognised_revenue"] == 3.3 and got[2]["total_recognised_revenue"] is None
    cumulative = by(retention.recognised_revenue(df, alloc, "recognised_revenue_dollars"), "cohort_index")
    assert cumulative[1]["total_recognised_revenue"] == 30.0


def test_recognised_revenue_by_slice_adds_up(frame):
    slices = "cohort_month string, billing_period string, geo_region string"
    matrix = frame(slices, *[("2024-01", "2024-02", g) for g in ("EU", "US", None)], ("2024-01", "2024-03", "EU"))
    alloc = frame(
        "cohort_month string, allocated_period string, geo_region string, recognition_status string,"
        " recognised_in_period_dollars double",
        *[("2024-01", "2024-02", g, "recognised", x) for g, x in (("EU", 1.1), ("EU", 2.2), ("US", 5.0), (None, 7.0))],
        ("2024-01", "2024-03", "EU", "future", 9.0),
    )
    got = retention.recognised_revenue(matrix, alloc, dims=["geo_region"])
    assert got.columns == [*matrix.columns, "total_recognised_revenue"]
    found = {(r.billing_period, r.geo_region): r.total_recognised_revenue for r in got.collect()}
    assert found == {
        ("2024-02", "EU"): 3.3, ("2024-02", "US"): 5.0, ("2024-02", None): 7.0, ("2024-03", "EU"): None
    }
    whole = retention.recognised_revenue(matrix, alloc).where("billing_period = '2024-02'").collect()
    assert {r.total_recognised_revenue for r in whole} == {15.3}


def test_quality_filter(frame):
    df = frame(MATRIX, cell(1, accounts=2), cell(2, accounts=3), cell(3, begin=0.0))
    assert [r.cohort_index for r in retention.quality_filter(df).collect()] == [2]
    assert retention.quality_filter(df, min_accounts=2).count() == 2


def test_implausible(frame):
    df = retention.point_in_time(
        frame(MATRIX, cell(1, exp=200.0), cell(2, exp=201.0), cell(3, churn=-101.0), cell(4, churn=-100.0),
              cell(5, begin=0.0), cell(6, exp=500.0))
    )
    assert {r.cohort_index for r in retention.implausible_nrr(df).collect()} == {2, 3, 6}
    assert [r.cohort_index for r in retention.implausible_nrr(df, limit=2).collect()] == [6, 2]
