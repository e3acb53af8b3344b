"""Outgoing records: alert payloads, escalation route, normalised failure signals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import mean, total
from .ranks import row_numbers
from .segment import DAY, REVENUE, SEGMENT, is_flagged

# Fixed values.
SCHEMA_VERSION = "v2"
HIGH_VOLUME = 5
MONEY = "decimal(18,2)"
PAYLOAD_ENTRIES = 1000


def _money(c: str | Column) -> Column:
    return F.round(c, 2).cast(MONEY)


def _entry() -> Column:
    return F.struct(
        F.col(SEGMENT),
        F.col(DAY),
        _money(REVENUE).alias("revenue_actual"),
        _money("revenue_7d_avg").alias("revenue_expected"),
        _money("revenue_zscore").alias("zscore"),
        F.col("anomaly_severity").alias("severity"),
        F.col("anomaly_description").alias("description"),
    )


def alert_payloads(
    scored: DataFrame, report_date: date | str | Column, pipeline: str = "segment_revenue"
) -> DataFrame:
    """One JSON payload per segment: its metrics and its flagged days.

    ``scored`` is a daily series, so the list holds at most one entry per calendar day
    (a sum over raw rows would not be bounded). Amounts are written as decimals.
    """

    by_day = F.array_sort(
        F.collect_list(F.when(is_flagged(), _entry())),
        lambda a, b: F.datediff(a[DAY], b[DAY]),
    )
    stamp = report_date if isinstance(report_date, Column) else F.lit(report_date)
    grouped = scored.groupBy(SEGMENT).agg(
        _money(mean(REVENUE)).alias("average"),
        _money(total(REVENUE)).alias("whole"),
        F.count_if(is_flagged()).alias("anomaly_count"),
        by_day.alias("anomalies"),
    )
    payload = F.struct(
        F.lit(pipeline).alias("pipeline"),
        F.date_format(stamp.cast("date"), "yyyy-MM-dd").alias("report_date"),
        F.col(SEGMENT),
        F.struct(
            F.col("average").alias(REVENUE), F.col("whole").alias("total_revenue"), "anomaly_count"
        ).alias("metrics"),
        "anomalies",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    return grouped.select(
        SEGMENT, "anomaly_count", F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload")
    )


def alert_payload_chunks(
    scored: DataFrame,
    report_date: date | str | Column,
    pipeline: str = "segment_revenue",
    most: int = PAYLOAD_ENTRIES,
) -> DataFrame:
    """``alert_payloads`` in numbered chunks of at most ``most`` flagged rows, whatever their number.

    (segment_id, chunk from 1, chunks, anomaly_count of the segment, payload); the payload has its
    chunk and the number of chunks too. Rows are in order of date over the chunks of a segment; a
    segment without flagged rows has one empty chunk. Rows are numbered in range-sorted slices,
    so a segment with any number of flagged rows is spread over tasks.
    """
    # Rows that agree in all of these give equal entries, so their order does not matter.
    order = [F.col(c).asc_nulls_first() for c in (DAY, REVENUE, "revenue_7d_avg", "revenue_zscore", "anomaly_description")]
    flagged = scored.filter(is_flagged()).select(SEGMENT, DAY, REVENUE, "revenue_7d_avg", "revenue_zscore",
                                                 "anomaly_severity", "anomaly_description")
    numbered = row_numbers(flagged, [SEGMENT], order, "place")
    entries = (
        numbered.withColumn("chunk", F.floor((F.col("place") - 1) / most).cast("int") + 1)
        .groupBy(SEGMENT, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("place", _entry().alias("entry")))).alias("rows"))
        .select(SEGMENT, "chunk", F.transform("rows", lambda r: r["entry"]).alias("anomalies"))
    )
    segments = scored.groupBy(F.col(SEGMENT).alias("__segment")).agg(
        _money(mean(REVENUE)).alias("average"),
        _money(total(REVENUE)).alias("whole"),
        F.count_if(is_flagged()).alias("anomaly_count"),
    )
    stamp = report_date if isinstance(report_date, Column) else F.lit(report_date)
    joined = segments.join(entries, F.col("__segment").eqNullSafe(F.col(SEGMENT)), "left").drop(SEGMENT)
    joined = joined.withColumnRenamed("__segment", SEGMENT).withColumns(
        {
            "chunk": F.coalesce("chunk", F.lit(1)),
            "chunks": F.greatest(F.ceil(F.col("anomaly_count") / most), F.lit(1)).cast("int"),
            "anomalies": F.coalesce("anomalies", F.array().cast(entries.schema["anomalies"].dataType)),
        }
    )
    payload = F.struct(
        F.lit(pipeline).alias("pipeline"),
        F.date_format(stamp.cast("date"), "yyyy-MM-dd").alias("report_date"),
        F.col(SEGMENT),
        F.struct(
            F.col("average").alias(REVENUE), F.col("whole").alias("total_revenue"), "anomaly_count"
        ).alias("metrics"),
        "chunk",
        "chunks",
        "anomalies",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    text = F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload")
    return joined.select(SEGMENT, "chunk", "chunks", "anomaly_count", text)


def escalation_route(found: DataFrame) -> DataFrame:
    """One row: alert counts and where they lead."""
    counted = found.agg(
        F.count("*").alias("anomaly_count"),
        F.count_if(F.col("severity_band") == "CRITICAL").alias("critical_count"),
    )
    return counted.withColumn(
        "alert_type",
        F.when(F.col("critical_count") > 0, "CRITICAL_REVENUE_ANOMALY")
        .when(F.col("anomaly_count") > HIGH_VOLUME, "HIGH_VOLUME_ANOMALY")
        .otherwise("NONE"),
    )


def failure_signals(log: DataFrame, platform: str = "aws") -> DataFrame:
    """Failure log rows in one shape, with empty lists and maps for absent ones, and as JSON."""
    no_strings = F.array().cast("array<string>")
    no_config = F.create_map().cast("map<string,string>")
    signal = log.select(
        F.lit(platform).alias("platform"),
        "job_id",
        "run_id",
        "timestamp",
        "error_signature",
        "log_excerpt",
        F.coalesce("artifacts", no_strings).alias("artifacts"),
        F.coalesce("code_paths", no_strings).alias("code_paths"),
        F.coalesce("config", no_config).alias("config"),
    )
    whole = F.struct(*[F.col(c) for c in signal.columns])
    return signal.withColumn("payload", F.to_json(whole, {"ignoreNullFields": "false"}))
