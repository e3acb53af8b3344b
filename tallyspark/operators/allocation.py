"""Contract revenue allocated to calendar months.

Durations, contract terms and the rounding check are worked out on the ledger row, before
it is expanded to months, so the large expanded table never has to be shuffled.
"""

from __future__ import annotations

from datetime import date
from itertools import chain

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import dollars, month_number, period_of, period_text

# Months covered by each billing interval.
INTERVAL_MONTHS = {"monthly": 1, "quarterly": 3, "annual": 12, "biennial": 24}
BASES = ("recurring", "upfront")
ROUNDING_LIMIT = 0.005  # dollars a month: half a cent


def contract_months(ledger: DataFrame) -> DataFrame:
    """Months per billing interval, case-insensitive; unknown or missing is 1."""
    months = F.create_map(*map(F.lit, chain.from_iterable(INTERVAL_MONTHS.items())))
    return ledger.withColumn(
        "contract_duration_months",
        F.coalesce(F.try_element_at(months, F.lower("billing_interval")), F.lit(1)),
    )


def monthly_allocation(terms: DataFrame) -> DataFrame:
    """Closing MRR divided over the months, in whole cents and in dollars."""
    per_month = F.round(
        F.col("closing_mrr_dollars") * 100.0 / F.col("contract_duration_months"), 0
    ).cast("bigint")
    return terms.withColumn("allocated_mrr_cents_per_month", per_month).withColumn(
        "allocated_mrr_dollars_per_month", dollars("allocated_mrr_cents_per_month")
    )


def expand_months(allocated: DataFrame) -> DataFrame:
    """One row per allocated month, with the months elapsed since the billing period and the
    contract terms of the month, where there are any."""
    offsets = F.sequence(F.lit(0), F.col("contract_duration_months") - 1)
    month = F.col("first_month") + F.col("months_elapsed")
    expanded = (
        allocated.withColumn("first_month", month_number("billing_period"))
        .select("*", F.explode(offsets).alias("months_elapsed"))
        .withColumn("allocated_period", period_text(month))
    )
    if "contract_coming" in expanded.columns:
        expanded = _terms_of_month(expanded, month)
    return expanded.drop("first_month")


def deferred_balance(expanded: DataFrame, contract_value_basis: str = "recurring") -> DataFrame:
    """Revenue recognised so far and in the month, and what remains deferred.

    ``recurring`` takes closing MRR times the duration as the contract value, ``upfront``
    the closing value itself, which the last month brings to zero but for rounding.
    """
    if contract_value_basis not in BASES:
        raise ValueError(f"contract_value_basis must be one of {BASES}")
    monthly = F.col("allocated_mrr_dollars_per_month")
    value = F.col("closing_mrr_dollars")
    if contract_value_basis == "recurring":
        value = value * F.col("contract_duration_months")
    left = value - F.col("recognised_revenue_dollars")
    return (
        expanded.withColumns(
            {
                "recognised_revenue_dollars": monthly * (F.col("months_elapsed") + 1),
                "recognised_in_period_dollars": monthly,
            }
        )
        .withColumn(
            "deferred_revenue_balance_dollars",
            F.when(left.isNotNull(), F.greatest(F.lit(0.0), left)),
        )
    )


def recognition_status(expanded: DataFrame, as_of: date | str | Column) -> DataFrame:
    """future, current or recognised at ``as_of``; ``beyond_contract`` after a known end."""
    today = period_of(as_of if isinstance(as_of, Column) else F.lit(as_of))
    month = F.col("allocated_period")
    ended = F.lit(False)
    if "contract_end_period" in expanded.columns:
        ended = month > F.col("contract_end_period")
    elif "contract_end" in expanded.columns:
        ended = month > period_of("contract_end")
    return expanded.withColumn(
        "recognition_status",
        F.when(ended, "beyond_contract")
        .when(month > today, "future")
        .when(month == today, "current")
        .otherwise("recognised"),
    )


def rounding_difference(allocated: DataFrame) -> DataFrame:
    """Allocated total minus closing MRR, known before expansion; needs no shuffle.

    Valid for a ledger with one row per subscription and period.
    """
    whole = F.col("allocated_mrr_cents_per_month") * F.col("contract_duration_months") / 100.0
    return allocated.withColumn("sum_allocated_mrr", whole).withColumn(
        "allocation_rounding_diff",
        F.round(F.col("sum_allocated_mrr") - F.col("closing_mrr_dollars"), 4),
    )


def gate_metrics(limit: float = ROUNDING_LIMIT) -> list[Column]:
    """Rows, and rows whose rounding difference exceeds ``limit`` for each month."""
    most = F.col("contract_duration_months") * F.lit(limit) + F.lit(1e-9)
    return [
        F.count("*").alias("total_rows"),
        F.count_if(F.abs("allocation_rounding_diff") > most).alias("rounding_breaches"),
    ]


def reconcile_expanded(expanded: DataFrame) -> DataFrame:
    """The same check on rows that are already expanded (at most 24 per group)."""
    group = Window.partitionBy("subscription_id", "billing_period")
    whole = F.sum("allocated_mrr_cents_per_month").over(group) / 100.0
    return expanded.withColumn("sum_allocated_mrr", whole).withColumn(
        "allocation_rounding_diff",
        F.round(F.col("sum_allocated_mrr") - F.col("closing_mrr_dollars"), 4),
    )


TERM = ("contract_arr_cents", "auto_renew", "contract_end")


def contract_terms(
    ledger: DataFrame, schedule: DataFrame, horizon: int = max(INTERVAL_MONTHS.values())
) -> DataFrame:
    """Each ledger row with the contract in force in its billing month, and those that start in
    the months after it, within ``horizon`` months (``contract_coming``, by month).

    A contract is in force from the month of its start until another one starts; months after
    its end are outside it. Before the first contract there are no terms; a contract without a
    start is in force from the beginning. Of several that start in one month the last by start,
    end and value counts.

    Terms and ledger rows are sorted together by month, so there is no range join: the last
    terms are carried forward, and a window holds the months of one subscription.
    """
    started = F.coalesce(month_number(period_of("contract_start")), F.lit(0))
    terms = (
        schedule.filter(F.col("subscription_id").isNotNull())
        .groupBy("subscription_id", started.alias("month"))
        .agg(F.max_by(F.struct(*TERM), F.struct("contract_start", "contract_end", "contract_arr_cents")).alias("t"))
        .select("subscription_id", F.col("month").alias("__month"), F.struct("month", "t.*").alias("__term"))
    )
    rows = ledger.withColumns({"__month": month_number("billing_period"), "__row": F.lit(True)})
    months = Window.partitionBy("subscription_id").orderBy("__month")
    past, next_months = months.rangeBetween(Window.unboundedPreceding, 0), months.rangeBetween(1, max(horizon - 1, 1))
    both = rows.unionByName(terms, allowMissingColumns=True).withColumns(
        {
            "__now": F.last("__term", ignorenulls=True).over(past),
            "contract_coming": F.collect_list("__term").over(next_months),
        }
    )
    return both.filter("__row").select(
        *[f"`{c}`" for c in ledger.columns],
        *[F.col(f"__now.{c}").alias(c) for c in TERM],
        period_of("__now.contract_end").alias("contract_end_period"),
        "contract_coming",
    )


def _terms_of_month(expanded: DataFrame, month: Column) -> DataFrame:
    """The terms in force in the allocated month instead of those of the billing month."""
    later = F.filter("contract_coming", lambda t: t["month"] <= month)
    expanded = expanded.withColumn("__later", F.try_element_at(later, F.lit(-1)))
    own = {
        c: F.when(F.col("__later").isNotNull(), F.col(f"__later.{c}")).otherwise(F.col(c)) for c in TERM
    }
    expanded = expanded.withColumns(own).drop("__later", "contract_coming")
    return expanded.withColumn("contract_end_period", period_of("contract_end"))


def allocate_revenue(
    ledger: DataFrame,
    as_of: date | str | Column,
    schedule: DataFrame | None = None,
    contract_value_basis: str = "recurring",
) -> DataFrame:
    """Ledger to allocated months with recognition status and rounding check."""
    if schedule is not None:
        ledger = contract_terms(ledger, schedule)
    allocated = rounding_difference(monthly_allocation(contract_months(ledger)))
    balances = deferred_balance(expand_months(allocated), contract_value_basis)
    return recognition_status(balances, as_of)
