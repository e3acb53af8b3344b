"""Net and gross revenue retention, rolling retention and logo retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import positive_ratio, total
from .cohort import DIMENSIONS, retained_arr

# Fixed values.
ROLLING_MONTHS = 12
MIN_ACCOUNTS = 3
PLAUSIBLE_NRR = (0.0, 3.0)
EARNED = ("recognised", "current")
ROLLED = {
    "total_beginning_arr_dollars": "rolling_12m_beginning_arr",
    "expansion_arr_dollars": "rolling_12m_expansion",
    "contraction_arr_dollars": "rolling_12m_contraction",
    "churn_arr_dollars": "rolling_12m_churn",
}


def point_in_time(matrix: DataFrame) -> DataFrame:
    """NRR, and GRR capped at 1; NULL without beginning ARR."""
    base = F.col("total_beginning_arr_dollars")
    gross = positive_ratio(retained_arr(with_expansion=False), base, 6)
    return matrix.withColumns(
        {
            "nrr_point_in_time": positive_ratio(retained_arr(with_expansion=True), base, 6),
            "grr_point_in_time": F.when(gross.isNotNull(), F.least(F.lit(1.0), gross)),
        }
    )


def rolling_nrr(
    matrix: DataFrame, dims: Sequence[str] = DIMENSIONS, frame: str = "rows"
) -> DataFrame:
    """Ratio of sums over the last 12 observations (``rows``) or months (``range``).

    A window partition is one cohort and slice of the matrix: at most one row per month.
    """
    if frame not in ("rows", "range"):
        raise ValueError(f"frame must be 'rows' or 'range', got {frame!r}")
    ages = Window.partitionBy("cohort_month", *dims).orderBy("cohort_index")
    year = (ages.rowsBetween if frame == "rows" else ages.rangeBetween)(1 - ROLLING_MONTHS, 0)
    rolled = matrix.select("*", *[total(c, year).alias(name) for c, name in ROLLED.items()])
    base = F.col("rolling_12m_beginning_arr")
    ending = sum((F.col(c) for c in list(ROLLED.values())[1:]), base)
    return rolled.withColumn(
        "nrr_rolling_12m",
        F.when(F.col("cohort_index") >= ROLLING_MONTHS - 1, positive_ratio(ending, base, 6)),
    )


def logo_retention(matrix: DataFrame, mode: str = "counted") -> DataFrame:
    """Share of accounts kept. ``as_written`` counts the whole cohort once any ARR churned."""
    lost = {
        "counted": F.col("churned_account_count"),
        "as_written": F.when(F.col("churn_arr_dollars") < 0, F.col("account_count")).otherwise(
            F.lit(0).cast("bigint")
        ),
    }[mode]
    accounts = F.col("account_count")
    kept = F.lit(1.0) - F.col("churned_accounts") / accounts
    return matrix.withColumn("churned_accounts", lost).withColumn(
        "logo_retention_rate", F.when(accounts > 0, F.round(kept, 4))
    )


def recognised_revenue(
    matrix: DataFrame,
    allocated: DataFrame,
    measure: str = "recognised_in_period_dollars",
    dims: Sequence[str] = (),
) -> DataFrame:
    """Earned revenue per cohort and period, aggregated before the left join.

    Without ``dims`` every slice of a cohort shows the whole cohort's revenue, which must not be
    added up over slices. With the matrix's ``dims`` each slice shows its own; a NULL attribute is
    a slice like any other.
    """
    keys = ["cohort_month", "billing_period", *dims]
    earned = (
        allocated.filter(F.col("recognition_status").isin(*EARNED))
        .withColumn("billing_period", F.col("allocated_period"))
        .groupBy(*keys)
        .agg(total(measure).alias("total_recognised_revenue"))
    )
    if not dims:
        return matrix.join(earned, keys, "left")
    same = [F.col(f"m.{k}") == F.col(f"e.{k}") for k in keys[:2]]
    same += [F.col(f"m.{k}").eqNullSafe(F.col(f"e.{k}")) for k in dims]
    return matrix.alias("m").join(earned.alias("e"), same, "left").select("m.*", "e.total_recognised_revenue")


def quality_filter(metrics: DataFrame, min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """Cohorts large enough to report, in periods with beginning ARR."""
    return metrics.filter(
        (F.col("account_count") >= min_accounts) & (F.col("total_beginning_arr_dollars") > 0)
    )


def implausible_nrr(metrics: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows whose NRR lies outside 0..3; ``limit`` gives an ordered sample."""
    low, high = PLAUSIBLE_NRR
    nrr = F.col("nrr_point_in_time")
    rows = metrics.filter((nrr < low) | (nrr > high))
    if limit is None:
        return rows
    return rows.orderBy(
        nrr.desc(), "cohort_month", "billing_period", *[c for c in DIMENSIONS if c in rows.columns]
    ).limit(limit)


def retention_metrics(
    matrix: DataFrame,
    allocated: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    min_accounts: int = MIN_ACCOUNTS,
    measure: str = "recognised_in_period_dollars",
    revenue_dims: Sequence[str] = (),
) -> DataFrame:
    """Cohort matrix to the reported retention table. ``revenue_dims``: the matrix's dimensions
    for each slice's own recognised revenue, none for that of the whole cohort."""
    measured = logo_retention(rolling_nrr(point_in_time(matrix), dims))
    return quality_filter(recognised_revenue(measured, allocated, measure, revenue_dims), min_accounts)
