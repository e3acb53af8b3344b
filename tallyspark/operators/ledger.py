"""MRR ledger: billing events to one row per subscription and billing period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import dollars, period_of
from ..schemas import ACCOUNT_METADATA, LEDGER_COLUMNS

# Fixed values.
EVENT_TYPES = (
    "new_subscription", "upgrade", "downgrade", "reactivation", "cancellation", "pause",
    "plan_change",
)


def valid_events(events: DataFrame) -> DataFrame:
    """Known types with subscription and time, outside trials; an unknown trial flag drops."""
    return events.filter(
        F.col("event_type").isin(*EVENT_TYPES)
        & F.col("subscription_id").isNotNull()
        & F.col("event_ts").isNotNull()
        & ~F.col("is_trial").try_cast("boolean")
    )


def one_per_day(events: DataFrame, keep: str = "first") -> DataFrame:
    """First (or last) mutation of each subscription and day; ties go by event id.

    Spark limits each group to one row before the shuffle, so a hot subscription
    contributes one row per day and map task. Where ``billing_period`` is known it leads
    the sort, which then also serves the grouping by period that follows.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    order = [F.col("created_at"), F.col("event_id")]
    if keep == "last":
        order = [c.desc() for c in order]
    keys = [c for c in ("subscription_id", "billing_period") if c in events.columns]
    days = Window.partitionBy(*keys, "event_date").orderBy(*order)
    return (
        events.withColumn("event_date", F.to_date("event_ts"))
        .withColumn("nth", F.row_number().over(days))
        .filter("nth = 1")
        .drop("nth")
    )


def mrr_delta(events: DataFrame) -> DataFrame:
    """Change in cents; a missing before or after counts as zero. Adds the billing period."""
    before, after = (
        F.coalesce(F.col(c), F.lit(0).cast("bigint"))
        for c in ("mrr_before_cents", "mrr_after_cents")
    )
    return events.withColumns(
        {
            "mrr_before_safe": before,
            "mrr_after_safe": after,
            "mrr_delta_cents": after - before,
            "billing_period": period_of("event_ts"),
        }
    )


def period_net(deltas: DataFrame) -> DataFrame:
    """One row per subscription and period: its last event, with the net change of all.

    After ``one_per_day`` a group holds at most the days of a month. Windows keep the
    columns prunable, so a query that needs few of them reads and shuffles only those.
    """
    latest = Window.partitionBy("subscription_id", "billing_period").orderBy(
        F.desc("event_ts"), F.desc("event_id")
    )
    whole = latest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        deltas.select(
            "*",
            F.sum("mrr_delta_cents").over(whole).alias("net_new_mrr_cents"),
            F.row_number().over(latest).alias("nth"),
        )
        .filter("nth = 1")
        .drop("nth")
        .withColumns(
            {
                "net_new_mrr_dollars": dollars("net_new_mrr_cents"),
                "closing_mrr_dollars": dollars("mrr_after_safe"),
            }
        )
    )


def movement_type(net: DataFrame) -> DataFrame:
    """Movement category from the period's last event type and its net change."""
    kind, change = F.col("event_type"), F.col("net_new_mrr_cents")
    return net.withColumn(
        "movement_type",
        F.when(kind == "new_subscription", "new_business")
        .when(kind == "reactivation", "reactivated")
        .when(kind.isin("upgrade", "plan_change") & (change > 0), "expansion")
        .when(kind.isin("downgrade", "plan_change") & (change < 0), "contraction")
        .when(kind == "cancellation", "churned")
        .otherwise("neutral"),
    )


def with_account_metadata(rows: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Left join of the account attributes; NULL attributes where there is no table."""
    attributes = [f for f in ACCOUNT_METADATA if f.name != "account_id"]
    if metadata is None:
        return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in attributes])
    return rows.join(metadata.select("account_id", *[f.name for f in attributes]), "account_id", "left")


def account_dimension(events: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """One row per account: attributes and cohort month.

    The cohort month is that of ``first_paid_date``, else of the first valid event. Partial
    minima keep a hot account to one row per map task, where a window would not.
    """
    first = events.groupBy("account_id").agg(F.min("event_ts").alias("first_ts"))
    paid = F.try_to_date(F.col("first_paid_date").cast("string"), "yyyy-MM-dd")
    return (
        with_account_metadata(first, metadata)
        .withColumn("cohort_month", F.coalesce(period_of(paid), period_of("first_ts")))
        .drop("first_ts")
    )


def net_movements(valid: DataFrame, keep: str = "first") -> DataFrame:
    """Valid events to one classified row per subscription and period, without accounts."""
    return movement_type(period_net(one_per_day(mrr_delta(valid), keep)))


def mrr_ledger(
    events: DataFrame, metadata: DataFrame | None = None, keep: str = "first"
) -> DataFrame:
    """The full chain from raw events to the ledger table.

    A skewed account is split by the adaptive join: the account side has one row each.
    """
    valid = valid_events(events)
    accounts = account_dimension(valid, metadata)
    return net_movements(valid, keep).join(accounts, "account_id", "left").select(*LEDGER_COLUMNS)
