"""Cohort x period ARR matrix from the MRR ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import (
    cents, dollars, month_number, one_value, period_of, period_text, positive_ratio, total,
)

# Fixed values.
DIMENSIONS = ("industry_vertical", "geo_region", "account_tier")
MONTHS_PER_YEAR = 12


def cohort_key(ledger: DataFrame) -> DataFrame:
    """``cohort_month``: month of ``first_paid_date``, else the account's first period.

    Aggregates to accounts and joins back, so that a skewed account is split by the
    adaptive join instead of being sorted in one window task.
    """
    first = ledger.groupBy("account_id").agg(F.min("billing_period").alias("first_period"))
    paid = F.try_to_date(F.col("first_paid_date").cast("string"), "yyyy-MM-dd")
    return (
        ledger.drop("cohort_month")
        .join(first, "account_id", "left")
        .withColumn("cohort_month", F.coalesce(period_of(paid), "first_period"))
        .drop("first_period")
    )


def cohort_index(ledger: DataFrame) -> DataFrame:
    """Whole months since the cohort month; rows before it are dropped."""
    age = month_number("billing_period") - month_number("cohort_month")
    return ledger.withColumn("cohort_index", age).filter("cohort_index >= 0")


def _account_months(
    indexed: DataFrame, dims: Sequence[str], through: str | Column | None
) -> DataFrame:
    """One row per account and period with a movement, and the month of the next one.

    Rows collapse to account x period first, so an account's window holds at most its months.
    """
    keys = ["account_id", "cohort_month", *dims]
    here = month_number("billing_period")
    if through is None:
        last = one_value(indexed.agg(F.max(here).alias("m")), "m")
    else:
        last = month_number(through if isinstance(through, Column) else F.lit(through))
    history = Window.partitionBy(*keys).orderBy("billing_period")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        indexed.groupBy(*keys, "billing_period", "cohort_index")
        .agg(F.sum("net_new_mrr_cents").alias("net_new_mrr_cents"))
        .select(
            "*",
            F.sum("net_new_mrr_cents").over(so_far).alias("cumulative_net_new_mrr_cents"),
            here.alias("month"),
            F.coalesce(F.lead(here).over(history), F.greatest(last, here) + 1).alias("next_month"),
        )
    )


def arr_intervals(
    indexed: DataFrame, dims: Sequence[str] = DIMENSIONS, through: str | Column | None = None
) -> DataFrame:
    """Account ARR as intervals of one level: from ``month`` (that of a movement) until before
    ``until_month``, clipped to the months with ARR.

    A level of zero lasts for the month of its movement only, and only where there was ARR
    before; an account's intervals are its movements, however long they last.
    """
    level, net = F.col("cumulative_net_new_mrr_cents"), F.col("net_new_mrr_cents")
    months = F.when(level != 0, F.col("next_month") - F.col("month")).when(level != net, 1).otherwise(0)
    return (
        _account_months(indexed, dims, through)
        .withColumn("until_month", F.col("month") + months)
        .filter("until_month > month")
        .drop("next_month")
    )


def arr_snapshots(
    indexed: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    densify: bool = True,
    through: str | Column | None = None,
) -> DataFrame:
    """Opening and closing ARR per account and period.

    ``densify`` repeats the closing value for the months until the next movement, up to
    ``through`` (default: the last period in the input), and has no empty months: intervals are
    clipped before they are expanded.
    """
    if densify:
        step, moved = F.col("step"), F.col("step") == 0
        months = F.sequence(F.lit(0), F.col("until_month") - F.col("month") - 1)
        snapshots = (
            arr_intervals(indexed, dims, through)
            .select("*", F.explode(months).alias("step"))
            .withColumns(
                {
                    "billing_period": F.when(moved, F.col("billing_period")).otherwise(
                        period_text(F.col("month") + step)
                    ),
                    "cohort_index": F.col("cohort_index") + step,
                    "net_new_mrr_cents": F.when(moved, F.col("net_new_mrr_cents")).otherwise(
                        F.lit(0).cast("bigint")
                    ),
                }
            )
            .drop("step", "until_month")
        )
    else:
        snapshots = _account_months(indexed, dims, through).drop("next_month")
    closing = F.col("cumulative_net_new_mrr_cents") * MONTHS_PER_YEAR
    opening = closing - F.col("net_new_mrr_cents") * MONTHS_PER_YEAR
    return snapshots.drop("month").withColumns(
        {
            "closing_arr_cents": closing,
            "closing_arr_dollars": dollars(closing),
            "beginning_arr_dollars": dollars(opening),
        }
    )


def arr_movement(snapshots: DataFrame) -> DataFrame:
    """Movement label of each account and period; any start from zero is new ARR."""
    opening, closing = F.col("beginning_arr_dollars"), F.col("closing_arr_dollars")
    return snapshots.withColumns(
        {
            "arr_delta_dollars": dollars(cents(closing - opening)),
            "arr_movement_label": F.when(opening == 0, "new_arr")
            .when(closing == 0, "churned_arr")
            .when(closing > opening, "expansion_arr")
            .when(closing < opening, "contraction_arr")
            .otherwise("retained_arr"),
        }
    )


def cohort_matrix(movements: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Accounts, ARR and its movements per cohort, period and dimension values."""

    def moved(label: str, amount: str = "arr_delta_dollars") -> Column:
        return total(F.when(F.col("arr_movement_label") == label, F.col(amount)).otherwise(0.0))

    return movements.groupBy("cohort_month", "cohort_index", "billing_period", *dims).agg(
        F.count("account_id").alias("account_count"),
        F.count_if(F.col("arr_movement_label") == "churned_arr").alias("churned_account_count"),
        moved("new_arr").alias("new_arr_dollars"),
        moved("expansion_arr").alias("expansion_arr_dollars"),
        moved("contraction_arr").alias("contraction_arr_dollars"),
        moved("churned_arr").alias("churn_arr_dollars"),
        moved("retained_arr", "closing_arr_dollars").alias("retained_arr_dollars"),
        total("closing_arr_dollars").alias("total_closing_arr_dollars"),
        total("beginning_arr_dollars").alias("total_beginning_arr_dollars"),
    )


def retained_arr(*, with_expansion: bool) -> Column:
    """ARR left of the beginning ARR after movements."""
    parts = ["contraction_arr_dollars", "churn_arr_dollars"]
    if with_expansion:
        parts.insert(0, "expansion_arr_dollars")
    left = F.col("total_beginning_arr_dollars")
    for part in parts:
        left = left + F.col(part)
    return left


def cohort_nrr(matrix: DataFrame) -> DataFrame:
    base = F.col("total_beginning_arr_dollars")
    return matrix.withColumn(
        "net_revenue_retention_rate", positive_ratio(retained_arr(with_expansion=True), base, 4)
    )


# Sums of a matrix cell while it is built, in cents, and their names in the matrix.
CELL_SUMS = {
    "new": "new_arr_dollars",
    "expansion": "expansion_arr_dollars",
    "contraction": "contraction_arr_dollars",
    "churn": "churn_arr_dollars",
    "retained": "retained_arr_dollars",
    "closing": "total_closing_arr_dollars",
    "beginning": "total_beginning_arr_dollars",
}


def dense_matrix(
    indexed: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    through: str | Column | None = None,
) -> DataFrame:
    """The matrix of the densified snapshots, without a row per account and quiet month.

    An account that stays at the same ARR from one movement to the next enters its cell once
    (+) in the first quiet month and leaves it once (-) in the month of the next movement.
    These marks are summed per cell like the movements; running sums over the months of the
    small result give the accounts and ARR that are quiet in each month. All sums are whole
    cents, so entering and leaving cancel exactly.
    """
    zero = F.lit(0).cast("bigint")
    net, total_net = F.col("net_new_mrr_cents"), F.col("cumulative_net_new_mrr_cents")
    closing, delta = total_net * MONTHS_PER_YEAR, net * MONTHS_PER_YEAR
    opening = closing - delta
    month, following = F.col("month"), F.col("next_month")
    label = (
        F.when(opening == 0, "new")
        .when(closing == 0, "churn")
        .when(delta > 0, "expansion")
        .when(delta < 0, "contraction")
        .otherwise("retained")
    )

    def row(at: Column, **values: Column) -> Column:
        fields = ["accounts", "churned", *CELL_SUMS, "quiet_accounts", "quiet_cents"]
        return F.struct(at.alias("month"), *[values.get(f, zero).cast("bigint").alias(f) for f in fields])

    def only(kind: str) -> Column:
        return F.when(F.col("label") == kind, closing if kind == "retained" else delta).otherwise(0)

    present = ((opening != 0) | (closing != 0)).cast("int")
    movement = row(
        month,
        accounts=present,
        churned=(F.col("label") == "churn").cast("int"),
        **{k: only(k) for k in ("new", "expansion", "contraction", "churn", "retained")},
        closing=closing,
        beginning=opening,
    )
    enters = row(month + 1, quiet_accounts=F.lit(1), quiet_cents=closing)
    leaves = row(following, quiet_accounts=F.lit(-1), quiet_cents=-closing)
    quiet = (closing != 0) & (following > month + 1)

    cell = ["cohort_month", *dims]
    sums = ["accounts", "churned", *CELL_SUMS, "quiet_accounts", "quiet_cents"]
    events = (
        _account_months(indexed, dims, through)
        .withColumn("label", label)
        .select(
            *cell,
            F.inline(F.when(quiet, F.array(movement, enters, leaves)).otherwise(F.array(movement))),
        )
        .groupBy(*cell, "month")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    ages = Window.partitionBy(*cell).orderBy("month")
    so_far = ages.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("month").over(ages), F.col("month") + 1)
    months = (
        events.withColumns(
            {
                "quiet_accounts": F.sum("quiet_accounts").over(so_far),
                "quiet_cents": F.sum("quiet_cents").over(so_far),
                "until": until,
            }
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.col("until") - F.col("month") - 1)).alias("step"))
        .withColumn("month", F.col("month") + F.col("step"))
    )

    def in_month(c: str) -> Column:
        moved = F.when(F.col("step") == 0, F.col(c)).otherwise(zero)
        if c == "accounts":
            return moved + F.col("quiet_accounts")
        return moved + F.col("quiet_cents") if c in ("retained", "closing", "beginning") else moved

    return months.filter(in_month("accounts") > 0).select(
        "cohort_month",
        (F.col("month") - month_number("cohort_month")).alias("cohort_index"),
        period_text(F.col("month")).alias("billing_period"),
        *dims,
        in_month("accounts").alias("account_count"),
        in_month("churned").alias("churned_account_count"),
        *[dollars(in_month(c)).alias(name) for c, name in CELL_SUMS.items()],
    )


def build_matrix(
    ledger: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    densify: bool = True,
    through: str | Column | None = None,
) -> DataFrame:
    """Ledger (with ``cohort_month``) to the cohort matrix with its retention rate."""
    indexed = cohort_index(ledger)
    if densify:
        return cohort_nrr(dense_matrix(indexed, dims, through))
    snapshots = arr_snapshots(indexed, dims, densify=False)
    return cohort_nrr(cohort_matrix(arr_movement(snapshots), dims))
