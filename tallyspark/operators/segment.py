"""Per-segment revenue: rolling baselines, spikes, rank, share, threshold scoring, report.

Input: a daily series with ``date, segment_id, revenue_daily, customer_count,
avg_order_value``, one row per segment and day.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import mean, total
from ..schemas import REPORT_COLUMNS
from .frames import by_day, trailing
from .ranks import dense_ranks

SEGMENT, DAY, REVENUE = "segment_id", "date", "revenue_daily"

# Fixed values.
NORMAL, WARNING, CRITICAL = "NORMAL", "P2_WARNING", "P1_CRITICAL"
WARNING_Z, CRITICAL_Z = 2.0, 3.5
SPIKE_MULTIPLIER = 2.5
BAND_SIGMAS = 2


def daily_series(revenue: DataFrame) -> DataFrame:
    """Collapse rows to one per (segment, day); partial sums keep hot segments small."""
    return revenue.groupBy(SEGMENT, DAY).agg(
        total(REVENUE).alias(REVENUE),
        F.sum("customer_count").alias("customer_count"),
        mean("avg_order_value").alias("avg_order_value"),
    )


def rolling_stats(daily: DataFrame, frame: str = "rows") -> DataFrame:
    """7 and 30 day average and deviation, and the 30 day Bollinger bands (unrounded)."""
    week, month = (trailing(SEGMENT, DAY, n, frame) for n in (7, 30))
    stats = daily.select(
        "*",
        mean(REVENUE, week).alias("revenue_7d_avg"),
        F.stddev(REVENUE).over(week).alias("revenue_7d_std"),
        mean(REVENUE, month).alias("revenue_30d_avg"),
        F.stddev(REVENUE).over(month).alias("revenue_30d_std"),
    )
    middle, width = F.col("revenue_30d_avg"), F.lit(BAND_SIGMAS) * F.col("revenue_30d_std")
    return stats.withColumns(
        {"revenue_bollinger_upper": middle + width, "revenue_bollinger_lower": middle - width}
    )


def revenue_zscore(stats: DataFrame) -> DataFrame:
    spread = F.col("revenue_30d_std")
    away = F.col(REVENUE) - F.col("revenue_30d_avg")
    return stats.withColumn(
        "revenue_zscore", F.when(spread > 0, away / spread).otherwise(F.lit(0.0))
    )


def week_over_week(daily: DataFrame) -> DataFrame:
    """Change against the seventh row before, in percent."""
    before = F.col("revenue_lag_7d")
    return daily.withColumn(
        "revenue_lag_7d", F.lag(REVENUE, 7).over(by_day(SEGMENT, DAY))
    ).withColumn(
        "revenue_wow_pct_change",
        F.when(before != 0, F.round((F.col(REVENUE) - before) / before * 100, 2)),
    )


def rolling_week(daily: DataFrame, frame: str = "rows") -> DataFrame:
    week = trailing(SEGMENT, DAY, 7, frame)
    return daily.select(
        "*",
        mean(REVENUE, week).alias("revenue_7d_avg"),
        total(REVENUE, week).alias("revenue_7d_total"),
    )


def flag_spikes(rolled: DataFrame, multiplier: float = SPIKE_MULTIPLIER) -> DataFrame:
    """``is_spike`` when the day exceeds ``multiplier`` times its 7 day average."""
    usual = F.col("revenue_7d_avg")
    return rolled.withColumns(
        {
            "is_spike": F.coalesce(F.col(REVENUE) > usual * multiplier, F.lit(False)),
            "spike_ratio": F.try_divide(REVENUE, usual),
        }
    )


def segment_totals(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy(SEGMENT).agg(
        total(REVENUE).alias("total_revenue"),
        mean(REVENUE).alias("avg_daily_revenue"),
        F.count("*").alias("record_count"),
        F.count_if("is_spike").alias("spike_count"),
    )


def segment_days(
    revenue: DataFrame, metadata: DataFrame | None = None, since: date | str | None = None
) -> DataFrame:
    """Revenue per segment and day from ``since`` on, with optional segment attributes."""
    if since is not None:
        revenue = revenue.filter(F.col(DAY) >= F.lit(since).cast("date"))
    days = revenue.groupBy(SEGMENT, DAY).agg(
        total(REVENUE).alias("segment_revenue_total"),
        mean(REVENUE).alias("segment_revenue_avg"),
        F.max(REVENUE).alias("segment_revenue_peak"),
        F.count("*").alias("transaction_count"),
    )
    return days if metadata is None else days.join(metadata, SEGMENT, "left")


def revenue_rank(days: DataFrame, revenue: str = "segment_revenue_total") -> DataFrame:
    """Dense rank of the segments of a day, highest revenue first; a day with many segments is
    ranked by many tasks."""
    return dense_ranks(days, [DAY], revenue, "revenue_rank")


def contribution_pct(days: DataFrame, revenue: str = "segment_revenue_total") -> DataFrame:
    """Each segment's share of its day, in percent; NULL on a day that sums to zero.

    The days' totals are partial sums, one row a day, joined back.
    """
    whole = days.groupBy(F.col(DAY).alias("__day")).agg(total(revenue).alias("__whole"))
    share = F.round(F.try_divide(F.col(revenue), F.col("__whole")) * 100, 2)
    joined = days.join(whole, F.col(DAY).eqNullSafe(F.col("__day")), "left")
    return joined.withColumn("revenue_contribution_pct", share).drop("__day", "__whole")


def segment_report(days: DataFrame, scored: DataFrame) -> DataFrame:
    """``segment_days`` with the rank and share of each segment on its day and, from the
    ``threshold_scores``, its severity that day and its share of flagged days."""
    rates = anomaly_rate(scored).select(SEGMENT, "anomaly_days", "anomaly_rate_pct")
    flags = scored.select(SEGMENT, DAY, "anomaly_severity")
    placed = contribution_pct(revenue_rank(days))
    return placed.join(flags, [SEGMENT, DAY], "left").join(rates, SEGMENT, "left")


def _severity(z: Column, ratio: Column, z_threshold: float, multiplier: float) -> Column:
    size = F.abs(z)
    return (
        F.when(size >= CRITICAL_Z, F.lit(CRITICAL))
        .when((size >= z_threshold) | (ratio >= multiplier), F.lit(WARNING))
        .otherwise(F.lit(NORMAL))
    )


def threshold_scores(
    stats: DataFrame, z_threshold: float = WARNING_Z, multiplier: float = SPIKE_MULTIPLIER
) -> DataFrame:
    """Severity and a sentence per day, from z-score and ratio to the 7 day average."""
    usual, z = F.col("revenue_7d_avg"), F.col("revenue_zscore")
    scored = stats.withColumn(
        "spike_ratio", F.when(usual > 0, F.col(REVENUE) / usual).otherwise(F.lit(1.0))
    ).withColumn("anomaly_severity", _severity(z, F.col("spike_ratio"), z_threshold, multiplier))
    # The words of the sentence.
    sentence = F.concat(
        F.lit("Segment "), F.col(SEGMENT),
        F.lit(" recorded revenue="), F.col(REVENUE).cast("string"),
        F.lit(" vs 7d_avg="), F.round(usual, 2).cast("string"),
        F.lit(" (z="), F.round(z, 2).cast("string"), F.lit(")"),
    )
    return scored.withColumn("anomaly_description", F.when(is_flagged(), sentence))


def is_flagged() -> Column:
    return F.col("anomaly_severity") != NORMAL


def anomalies_only(scored: DataFrame) -> DataFrame:
    return scored.filter(is_flagged()).select(
        DAY, SEGMENT, REVENUE, "revenue_7d_avg", "revenue_30d_avg", "revenue_zscore",
        "spike_ratio", "anomaly_severity", "anomaly_description",
    )


def anomaly_rate(scored: DataFrame) -> DataFrame:
    """Share of flagged days per segment."""
    return (
        scored.groupBy(SEGMENT)
        .agg(
            F.count("*").alias("total_days"),
            F.count_if(is_flagged()).alias("anomaly_days"),
            mean(REVENUE).alias("avg_revenue"),
            F.stddev(REVENUE).alias("stddev_revenue"),
        )
        .withColumn(
            "anomaly_rate_pct", F.round(F.col("anomaly_days") / F.col("total_days") * 100, 2)
        )
    )


def summary_stats(scored: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    """One row over the whole report period, stamped when ``generated_at`` is given."""
    stats = scored.agg(
        total(REVENUE).alias("total_revenue"),
        mean(REVENUE).alias("avg_daily_revenue"),
        F.max(REVENUE).alias("peak_daily_revenue"),
        F.min(REVENUE).alias("min_daily_revenue"),
        F.countDistinct(SEGMENT).alias("active_segments"),
        F.count_if(is_flagged()).alias("total_anomalies"),
    )
    return stats if generated_at is None else stats.withColumn("generated_at", F.lit(generated_at))


def performance_report(
    scored: DataFrame,
    report_date: date | str | Column,
    day: date | str | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """Report columns stamped with ``report_date``; ``day`` keeps one date only.

    ``allow_missing=True`` leaves out columns the input lacks instead of failing.
    """
    if day is not None:
        scored = scored.filter(F.col(DAY) == F.lit(day).cast("date"))
    stamp = report_date if isinstance(report_date, Column) else F.lit(report_date)
    stamped = scored.withColumn("report_date", stamp.cast("date"))
    return stamped.select(
        *[c for c in REPORT_COLUMNS if not allow_missing or c in stamped.columns]
    )
