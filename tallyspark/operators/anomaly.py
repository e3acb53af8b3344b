"""Revenue anomaly detection on a daily series per segment.

Input: ``date, segment, revenue_amount, transaction_count, avg_basket_size``, one row per
segment and day. All frames share one shuffle and one sort by segment.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import band, mean, pct_of_base, total
from .frames import by_day, trailing

REVENUE = "revenue_amount"

# Fixed values.
Z_THRESHOLD, BAND_SIGMAS, LOOKBACK = 2.5, 2.0, 30
SEVERITY_BANDS = ((8.0, "CRITICAL"), (5.0, "HIGH"), (3.0, "MEDIUM"))
BASE_CAP, MOMENTUM_FLOOR_PCT, MOMENTUM_CAP, DUAL_BONUS, SCORE_CAP = 6.0, 20.0, 2.0, 2.0, 10.0
ALERT_RATE_LIMIT = 0.40


def plausible_revenue(revenue: DataFrame) -> DataFrame:
    """Drop rows without a date and rows with missing or negative revenue."""
    return revenue.filter(F.col("date").isNotNull() & (F.col(REVENUE) >= 0))


def daily_series(revenue: DataFrame) -> DataFrame:
    """Collapse rows to one per (segment, day); a unique row stays as it is."""
    return revenue.groupBy("segment", "date").agg(
        total(REVENUE).alias(REVENUE),
        F.sum("transaction_count").cast("int").alias("transaction_count"),
        F.avg("avg_basket_size").alias("avg_basket_size"),
    )


def segment_metrics(rfm: DataFrame) -> DataFrame:
    """Customer metrics per RFM segment, to be joined to that segment's alerts."""
    return rfm.groupBy(F.col("rfm_segment").alias("segment")).agg(
        F.count("customer_id").alias("segment_customer_count"),
        F.round(mean("monetary_value"), 2).alias("segment_avg_monetary"),
        F.round(mean("rfm_composite"), 3).alias("segment_avg_rfm"),
        F.round(mean("churn_risk_score"), 3).alias("segment_avg_churn_risk"),
        total("monetary_value").alias("segment_total_monetary"),
    )


def rolling_windows(revenue: DataFrame, lookback: int = LOOKBACK, frame: str = "rows") -> DataFrame:
    """7 row and ``lookback`` row statistics, row number and change on the row before."""
    series = by_day("segment", "date")
    week = trailing("segment", "date", 7, frame)
    month = trailing("segment", "date", lookback, frame)

    def stats(window, suffix: str) -> list[Column]:
        return [
            F.round(mean(REVENUE, window), 4).alias(f"ma_{suffix}"),
            F.round(F.stddev(REVENUE).over(window), 4).alias(f"std_{suffix}"),
            F.min(REVENUE).over(window).alias(f"min_{suffix}"),
            F.max(REVENUE).over(window).alias(f"max_{suffix}"),
        ]

    before = F.col("prev_day_revenue")
    return revenue.select(
        "*",
        F.row_number().over(series).alias("row_num"),
        *stats(week, "7d"),
        *stats(month, "30d"),
        F.lag(REVENUE).over(series).alias("prev_day_revenue"),
        F.round(F.avg("transaction_count").over(week), 2).alias("tx_count_7d_avg"),
        F.round(F.avg("avg_basket_size").over(week), 4).alias("basket_7d_avg"),
    ).withColumn("pct_change_1d", F.round(pct_of_base(F.col(REVENUE) - before, before), 4))


def score(
    windows: DataFrame, z_threshold: float = Z_THRESHOLD, band_sigmas: float = BAND_SIGMAS
) -> DataFrame:
    """z-score on the rounded baseline, Bollinger bands and the anomaly flags."""
    revenue, middle, spread = F.col(REVENUE), F.col("ma_30d"), F.col("std_30d")
    width = F.lit(float(band_sigmas)) * spread
    measured = windows.withColumns(
        {
            "zscore_30d": F.round(
                F.when(spread > 0, (revenue - middle) / spread).otherwise(F.lit(0.0)), 4
            ),
            "bollinger_upper": F.round(middle + width, 4),
            "bollinger_lower": F.round(middle - width, 4),
        }
    )
    far = F.abs("zscore_30d") > z_threshold
    outside = (revenue > F.col("bollinger_upper")) | (revenue < F.col("bollinger_lower"))
    return measured.withColumns(
        {"is_zscore_anomaly": far, "is_bollinger_breach": outside, "is_anomaly": far | outside}
    )


def severity_score(z_threshold: float = Z_THRESHOLD) -> Column:
    """0 to 10 from z-score size, one-day momentum and agreement of both flags."""
    z, momentum = F.abs("zscore_30d"), F.abs("pct_change_1d") - MOMENTUM_FLOOR_PCT
    base = F.least(z / z_threshold * 4.0, F.lit(BASE_CAP))
    push = F.when(momentum > 0, F.least(momentum / 10.0, F.lit(MOMENTUM_CAP))).otherwise(0.0)
    both = F.when(F.col("is_zscore_anomaly") & F.col("is_bollinger_breach"), DUAL_BONUS).otherwise(0.0)
    capped = F.bround(F.least(base + push + both, F.lit(SCORE_CAP)), 4)
    return F.when(z.isNull(), F.lit(0.0)).otherwise(capped)


def with_severity(scored: DataFrame, z_threshold: float = Z_THRESHOLD) -> DataFrame:
    return scored.withColumn("severity_score", severity_score(z_threshold))


def alerts(
    scored: DataFrame,
    metrics: DataFrame | None = None,
    generated_at: datetime | Column | None = None,
    z_threshold: float = Z_THRESHOLD,
) -> DataFrame:
    """Anomalous rows with band, direction, deviation and the metrics of their segment."""
    away = F.col(REVENUE) - F.col("ma_30d")
    stamp = F.current_timestamp() if generated_at is None else generated_at
    flagged = (
        with_severity(scored.filter("is_anomaly"), z_threshold)
        .withColumns(
            {
                "severity_band": band(F.col("severity_score"), SEVERITY_BANDS, "LOW"),
                "anomaly_direction": F.when(F.col("zscore_30d") > 0, "SPIKE").otherwise("DIP"),
                "revenue_deviation_abs": F.round(away, 4),
                "revenue_deviation_pct": F.round(pct_of_base(away, F.col("ma_30d")), 4),
                "reference_revenue_usd": F.col(REVENUE),
                "alert_generated_at": stamp if isinstance(stamp, Column) else F.lit(stamp),
            }
        )
    )
    # The join strategy follows the measured size of the metrics, one row per segment.
    return flagged if metrics is None else flagged.join(metrics, "segment", "left")


def alert_summary(found: DataFrame) -> DataFrame:
    return (
        found.groupBy("severity_band", "anomaly_direction")
        .agg(
            F.count("*").alias("alert_count"),
            F.round(mean("severity_score"), 3).alias("avg_severity"),
            F.round(mean("revenue_deviation_pct"), 2).alias("avg_deviation_pct"),
        )
        .orderBy(F.desc("avg_severity"), "severity_band", "anomaly_direction")
    )


def alert_rate(scored: DataFrame, limit: float = ALERT_RATE_LIMIT) -> DataFrame:
    """One row: input rows, anomalies, their share, and whether the share exceeds ``limit``."""
    counted = scored.agg(
        F.count("*").alias("total_rows"), F.count_if("is_anomaly").alias("anomaly_rows")
    )
    rate = F.coalesce(F.try_divide("anomaly_rows", "total_rows"), F.lit(0.0))
    return counted.withColumn("anomaly_rate", rate).withColumn("exceeds_limit", rate > limit)
