"""ARR waterfall per billing period.

Everything after the first aggregation has one row per month; the unpartitioned windows
below run on that calendar-sized table only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.exprs import cents, mean, positive_ratio, total

# Movement type -> column stem, in pivot order.
MOVEMENTS = {
    "new_business": "new_business",
    "expansion": "expansion",
    "contraction": "contraction",
    "churned": "churn",
    "reactivated": "reactivation",
    "neutral": "neutral",
}
COMPONENTS = (
    "new_business_arr", "expansion_arr", "reactivation_arr", "contraction_arr", "churn_arr",
)
MONTHS_PER_YEAR = 12
TOLERANCE = 0.01
RATE_SCALE = 1_000_000  # retention rates have six decimals


def _periods() -> WindowSpec:
    """All periods in order, for tables that already have one row per period."""
    return Window.orderBy("billing_period")


def opening_arr(ledger: DataFrame, basis: str = "active") -> DataFrame:
    """Measured closing ARR per period, and the period before's as opening.

    ``active`` carries every subscription's last closing MRR forward: the change of each
    ledger row against the subscription's row before, summed by period and accumulated.
    ``events`` sums only the rows of the period.
    """
    closing = cents("closing_mrr_dollars")
    if basis == "active":
        history = Window.partitionBy("subscription_id").orderBy("billing_period")
        changes = ledger.select(
            "billing_period",
            (closing - F.coalesce(F.lag(closing).over(history), F.lit(0))).alias("cents"),
        )
        level = F.sum("cents").over(_periods().rowsBetween(Window.unboundedPreceding, 0))
    elif basis == "events":
        changes = ledger.select("billing_period", closing.alias("cents"))
        level = F.col("cents")
    else:
        raise ValueError(f"basis must be 'active' or 'events', got {basis!r}")
    periods = changes.groupBy("billing_period").agg(F.sum("cents").alias("cents"))
    return (
        periods.select("billing_period", (level / 100.0).alias("total_closing_mrr"))
        .withColumn("total_closing_arr", F.col("total_closing_mrr") * MONTHS_PER_YEAR)
        .withColumn("opening_arr", F.lag("total_closing_arr").over(_periods()))
    )


def components(ledger: DataFrame) -> DataFrame:
    """Net MRR per movement type as columns, and the same as ARR with gaps as zero."""
    pivoted = (
        ledger.groupBy("billing_period")
        .pivot("movement_type", list(MOVEMENTS))
        .agg(total("net_new_mrr_dollars"))
        .withColumnsRenamed({kind: f"{stem}_mrr" for kind, stem in MOVEMENTS.items()})
    )
    return pivoted.withColumns(
        {
            f"{stem}_arr": F.coalesce(F.col(f"{stem}_mrr"), F.lit(0.0)) * MONTHS_PER_YEAR
            for stem in MOVEMENTS.values()
        }
    )


def blended_nrr(metrics: DataFrame) -> DataFrame:
    """NRR per period weighted by beginning ARR, with plain averages of GRR and rolling NRR."""
    weight = F.col("total_beginning_arr_dollars")
    return (
        metrics.groupBy("billing_period")
        .agg(
            total(F.col("nrr_point_in_time") * weight).alias("weighted"),
            total(weight).alias("total_beginning_arr"),
            mean("grr_point_in_time", scale=RATE_SCALE).alias("avg_grr"),
            mean("nrr_rolling_12m", scale=RATE_SCALE).alias("avg_nrr_rolling_12m"),
        )
        .select(
            "billing_period",
            positive_ratio(F.col("weighted"), F.col("total_beginning_arr"), 4).alias("blended_nrr"),
            "avg_grr",
            "avg_nrr_rolling_12m",
            "total_beginning_arr",
        )
    )


def closing_arr(waterfall: DataFrame) -> DataFrame:
    """Opening plus the five movements; NULL without an opening."""
    moved: Column = F.col("opening_arr")
    for part in COMPONENTS:
        moved = moved + F.coalesce(F.col(part), F.lit(0.0))
    return waterfall.withColumn("waterfall_closing_arr", moved)


def growth(waterfall: DataFrame) -> DataFrame:
    before = F.col("prior_period_closing_arr")
    return waterfall.withColumn(
        "prior_period_closing_arr", F.lag("total_closing_arr").over(_periods())
    ).withColumn(
        "arr_growth_rate", positive_ratio(F.col("total_closing_arr") - before, before, 4)
    )


def mismatches(
    waterfall: DataFrame, tolerance: float = TOLERANCE, limit: int | None = None, with_neutral: bool = False
) -> DataFrame:
    """Periods whose movements miss the measured closing ARR by more than ``tolerance``.

    A period that closes at zero fails on any difference. ``with_neutral`` counts
    ``neutral_arr``, the disclosed residual, as a movement. ``limit`` keeps the worst ones.
    """
    measured, built = F.col("total_closing_arr"), F.col("waterfall_closing_arr")
    if with_neutral:
        built = built + F.coalesce("neutral_arr", F.lit(0.0))
    relative = F.when(measured != 0, F.col("abs_delta") / F.abs(measured)).otherwise(
        F.when(F.col("abs_delta") > 0, 1.0).otherwise(0.0)
    )
    bad = (
        waterfall.filter(F.col("opening_arr").isNotNull() & built.isNotNull() & measured.isNotNull())
        .withColumn("abs_delta", F.abs(built - measured))
        .withColumn("pct_delta", relative)
        .filter(F.col("pct_delta") > tolerance)
        .select(
            "billing_period", "opening_arr", "waterfall_closing_arr", "total_closing_arr",
            "abs_delta", "pct_delta",
        )
    )
    return bad if limit is None else bad.orderBy(F.desc("pct_delta"), "billing_period").limit(limit)


def require_reconciled(
    waterfall: DataFrame, tolerance: float = TOLERANCE, with_neutral: bool = False
) -> None:
    """Raise when any period misses; the message names the count and the worst period."""
    worst = (
        mismatches(waterfall, tolerance, with_neutral=with_neutral)
        .agg(
            F.count("*").alias("periods"),
            F.max("pct_delta").alias("pct"),
            F.max_by("billing_period", "pct_delta").alias("period"),
        )
        .first()
    )
    if worst["periods"]:
        raise ValueError(
            f"ARR waterfall does not reconcile in {worst['periods']} period(s);"
            f" worst is {worst['period']} with {worst['pct']:.2%}"
        )


def arr_waterfall(ledger: DataFrame, metrics: DataFrame, basis: str = "active") -> DataFrame:
    """Ledger and retention metrics to the waterfall."""
    joined = opening_arr(ledger, basis).join(components(ledger), "billing_period", "full")
    return growth(closing_arr(joined.join(blended_nrr(metrics), "billing_period", "left")))
