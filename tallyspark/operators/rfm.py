"""Customer segmentation by recency, frequency and monetary value."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import band, mean, one_value, total
from .tiles import with_tiles

# Fixed values.
PAID = ("COMPLETED", "SHIPPED", "DELIVERED")
WEIGHTS = (0.3, 0.35, 0.35)
SEGMENTS = ((4.5, "Champions"), (3.5, "Loyal"), (2.5, "At-Risk"), (1.5, "Lost"))
NO_ORDERS = {
    "recency_days": 999,
    "order_count": 0,
    "monetary_value": 0.0,
    "avg_order_value": 0.0,
    "r_score": 1,
    "f_score": 1,
    "m_score": 1,
    "rfm_composite": 1.0,
    "rfm_cell": "1-1-1",
    "rfm_segment": "New",
    "purchase_velocity": 0.0,
}
RETENTION_MULTIPLIER = 1.2


def paid_orders(orders: DataFrame, statuses: Sequence[str] = PAID) -> DataFrame:
    return orders.filter(F.col("status").isin(*statuses))


def customer_totals(orders: DataFrame, orders_are_unique: bool = False) -> DataFrame:
    """One row per customer: order count, spend, order dates.

    ``order_count`` counts distinct order ids. With ``orders_are_unique=True`` (order_id is
    a primary key) a plain count gives the same number, and rows collapse to customers
    before the shuffle instead of being exchanged by (customer, order) first.
    """
    count = F.count("order_id") if orders_are_unique else F.countDistinct("order_id")
    return orders.groupBy("customer_id").agg(
        count.alias("order_count"),
        total("total_amount").alias("monetary_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        mean("total_amount").alias("avg_order_value"),
        F.stddev("total_amount").alias("stddev_order_value"),
    )


def with_recency(totals: DataFrame, as_of: date | str | Column | None = None) -> DataFrame:
    """Days from the last order to ``as_of``, by default the latest order of all customers."""
    if as_of is None:
        as_of = one_value(totals.agg(F.max("last_order_date").alias("d")), "d")
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of).cast("date")
    return totals.withColumn("recency_days", F.datediff(as_of, "last_order_date"))


def purchase_velocity(first: str = "first_order_date", last: str = "last_order_date",
                      orders: str = "order_count") -> Column:
    """Orders per day from the whole-day average gap; 0 for a single order or a gap under a day."""
    span, n = F.datediff(last, first), F.col(orders)
    gap = F.when(n > 1, F.floor(span / (n - 1)))
    return F.when(
        span.isNotNull(), F.when(gap > 0, F.bround(F.lit(1.0) / gap, 6)).otherwise(F.lit(0.0))
    )


def with_quintiles(metrics: DataFrame) -> DataFrame:
    """r, f and m scores, 1 worst to 5 best."""
    return with_tiles(
        metrics,
        "customer_id",
        {
            "r_score": ("recency_days", True),
            "f_score": ("order_count", False),
            "m_score": ("monetary_value", False),
        },
    )


def with_segment(scored: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Weighted composite, score cell and segment label."""
    if abs(sum(weights) - 1.0) >= 1e-6:
        raise ValueError(f"RFM weights must sum to 1, got {tuple(weights)}")
    scores = ("r_score", "f_score", "m_score")
    r, f, m = (F.col(s) * F.lit(float(w)) for s, w in zip(scores, weights))
    return (
        scored.withColumn("rfm_composite", F.round(r + f + m, 4))
        .withColumn("rfm_cell", F.concat_ws("-", *scores))
        .withColumn("rfm_segment", band(F.col("rfm_composite"), SEGMENTS, "New"))
    )


def enrich_customers(customers: DataFrame, segments: DataFrame) -> DataFrame:
    """All customers with their scores, defaults for those without orders, and derived scores."""
    composite = F.col("rfm_composite")
    known = customers.join(segments, "customer_id", "left").fillna(NO_ORDERS)
    return known.withColumns(
        {
            "is_high_value": F.coalesce(composite >= 4.0, F.lit(False)),
            "churn_risk_score": F.round(
                F.lit(5.0) - composite + F.col("recency_days") / F.lit(365.0) * F.lit(0.5), 4
            ),
            "ltv_estimate": F.round(
                F.col("monetary_value")
                * (composite / F.lit(5.0))
                * F.lit(RETENTION_MULTIPLIER),
                2,
            ),
        }
    )


def segment_distribution(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.round(mean("monetary_value"), 2).alias("avg_monetary"),
            F.round(mean("rfm_composite"), 3).alias("avg_rfm_score"),
            F.round(mean("churn_risk_score"), 3).alias("avg_churn_risk"),
        )
        .orderBy(F.col("avg_rfm_score").desc(), "rfm_segment")
    )


def gate_metrics() -> list[Column]:
    """Gate metrics of one pass: rows, rows without a segment, rows with negative LTV."""
    return [
        F.count("*").alias("total_rows"),
        F.count_if(F.col("rfm_segment").isNull()).alias("null_segment_rows"),
        F.count_if(F.col("ltv_estimate") < 0).alias("negative_ltv_rows"),
    ]
