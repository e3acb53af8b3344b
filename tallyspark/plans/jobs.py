"""The jobs. Each reads its input tables, passes its gate and writes its output table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import alerts, allocation, anomaly, cohort, ledger, quality, retention, rfm, segment, waterfall
from ..scratch import park
from ..sources import history, readers
from ..sources.publish import Version
from ..sources.writers import write_json, write_table

NULL_SEGMENT_LIMIT = 0.05


def _record(
    spark: SparkSession,
    history_path: str | None,
    job: str,
    run_id: str | None,
    written: Mapping[str, Version],
    more: Mapping[str, float] | None = None,
) -> None:
    """One row for each metric of the run: the rows of each table it published, and ``more``."""
    if history_path is None:
        return
    rows = {f"{table}_rows": v.row_count for table, v in written.items()}
    history.record(spark, history_path, job, run_id, {**rows, **(more or {})})


def ingest_job(
    spark: SparkSession,
    landing: DataFrame,
    schema: StructType,
    keys: Sequence[str],
    output_path: str,
    run_id: str,
    aliases: quality.Aliases | None = None,
) -> DataFrame:
    """Landed rows to curated and quarantined ones; returns the run's metrics.

    ``landing`` holds the columns as they arrived (``quality.merge_versions`` of text columns
    joins versions). A row is curated where ``keys`` are present and every value parses as
    ``schema`` declares; the others go to quarantine as they arrived, with the rules they
    fail. All four tables of a run lie in its own folder: ``curated``, ``quarantine``,
    ``run_metrics`` and, written last, ``manifest``. ``published`` reads a run only by its
    manifest.
    """
    landed = park(landing)
    rules = {**quality.present(*keys), **quality.unreadable(landed, schema, aliases)}
    good, bad = quality.split_valid(landed, rules)
    curated, quarantine, metrics, manifest = (
        f"{output_path}/{name}/run_id={run_id}" for name in ("curated", "quarantine", "run_metrics", "manifest")
    )
    quality.conform(good, schema, aliases).write.mode("overwrite").parquet(curated)
    bad.write.mode("overwrite").parquet(quarantine)
    stored = spark.read.schema(schema).parquet(curated)
    counts = quality.metric_rows(quality.ingest_counts(landed, rules), run_id, "ingest")
    counts.drop("run_id").write.mode("overwrite").parquet(metrics)
    written, refused = stored.count(), spark.read.parquet(quarantine).count()
    counted = {r.metric: r.value for r in counts.collect()}
    quality.check(counted, {"all_rows_landed": written + refused == counted["bronze"]})
    quality.manifest(stored, schema.names).write.mode("overwrite").parquet(manifest)
    return counts


def published(spark: SparkSession, path: str, schema: StructType, run_id: str | None = None) -> DataFrame:
    """Curated rows of a run (the last whose manifest was written unless given) after a check of
    its manifest."""
    chosen = run_id if run_id is not None else readers.last_run(spark.read.parquet(f"{path}/manifest"))
    listed = spark.read.parquet(f"{path}/manifest/run_id={chosen}")
    stored = spark.read.schema(schema).parquet(f"{path}/curated/run_id={chosen}")
    wrong = quality.check_manifest(listed, quality.manifest(stored, schema.names)).count()
    quality.check({"differing_files": wrong}, {"manifest": wrong == 0})
    return stored


def segment_customers(
    orders: DataFrame,
    customers: DataFrame,
    weights: Sequence[float] = rfm.WEIGHTS,
    orders_are_unique: bool = False,
    as_of: date | str | None = None,
) -> DataFrame:
    """All customers with RFM scores, segment and derived scores.

    The orders are aggregated once into a parked table of one row per customer; the
    reference date, the quintiles and the scores all come from that.
    """
    totals = park(rfm.customer_totals(rfm.paid_orders(orders), orders_are_unique))
    metrics = rfm.with_recency(totals, as_of).withColumn("purchase_velocity", rfm.purchase_velocity())
    segments = rfm.with_segment(rfm.with_quintiles(metrics), weights)
    return rfm.enrich_customers(customers, segments)


def rfm_job(
    spark: SparkSession,
    orders_path: str,
    customers_path: str,
    output_path: str,
    weights: Sequence[float] = rfm.WEIGHTS,
    processed_at: datetime | None = None,
    run_id: str | None = None,
    orders_are_unique: bool = False,
    as_of: date | str | None = None,
    history_path: str | None = None,
) -> DataFrame:
    """CSV orders and customers to the segments table; returns the segment distribution."""
    enriched = segment_customers(
        readers.orders(spark, orders_path),
        readers.customers(spark, customers_path),
        weights,
        orders_are_unique,
        as_of,
    ).withColumn(
        "processing_timestamp", F.lit(processed_at) if processed_at else F.current_timestamp()
    )
    watched, seen = quality.observed(enriched, "rfm_gate", rfm.gate_metrics())
    checked = park(watched)
    m = seen.get
    share = m["null_segment_rows"] / max(m["total_rows"], 1)
    quality.check(m, {"null_segment_share": share <= NULL_SEGMENT_LIMIT})
    written = write_table(checked, "rfm_segments", output_path, run_id, metrics=m)
    _record(spark, history_path, "rfm", run_id, {"rfm_segments": written}, m)
    return rfm.segment_distribution(checked)


def anomaly_job(
    spark: SparkSession,
    revenue_path: str,
    segments_path: str,
    output_path: str,
    z_threshold: float = anomaly.Z_THRESHOLD,
    band_sigmas: float = anomaly.BAND_SIGMAS,
    lookback: int = anomaly.LOOKBACK,
    generated_at: datetime | None = None,
    run_id: str | None = None,
    route_path: str | None = None,
    history_path: str | None = None,
) -> DataFrame:
    """Daily revenue and the segments table to the alerts table; returns the alert summary.

    ``route_path`` takes the escalation route of these alerts.
    """
    plausible = anomaly.plausible_revenue(readers.segment_revenue(spark, revenue_path))
    revenue = anomaly.daily_series(plausible)
    metrics = anomaly.segment_metrics(readers.read_table(spark, segments_path))
    scored = anomaly.score(anomaly.rolling_windows(revenue, lookback), z_threshold, band_sigmas)
    watched, seen = quality.observed(
        scored,
        "alert_gate",
        [F.count("*").alias("total_rows"), F.count_if("is_anomaly").alias("anomaly_rows")],
    )
    found = park(anomaly.alerts(watched, metrics, generated_at, z_threshold))
    m = seen.get
    rate = m["anomaly_rows"] / max(m["total_rows"], 1)
    quality.check(m, {"anomaly_rate": rate <= anomaly.ALERT_RATE_LIMIT}, on_fail="warn")
    written = {"revenue_alerts": write_table(found, "revenue_alerts", output_path, run_id, metrics=m)}
    if route_path is not None:
        route = alerts.escalation_route(found)
        written["escalation_route"] = write_table(route, "escalation_route", route_path, run_id)
    _record(spark, history_path, "anomaly", run_id, written, m)
    return anomaly.alert_summary(found)


def segment_job(
    spark: SparkSession,
    revenue_path: str,
    totals_path: str,
    report_path: str,
    report_date: date | str,
    json_path: str | None = None,
    payload_path: str | None = None,
    summary_path: str | None = None,
    segments_path: str | None = None,
    metadata: DataFrame | None = None,
    run_id: str | None = None,
    history_path: str | None = None,
) -> DataFrame:
    """Daily revenue to segment totals and the scored performance report; returns the latter.

    ``payload_path`` takes the alert payloads of each segment, in chunks, ``summary_path`` the
    one-row summary of the period; both are kept by report date. ``segments_path`` takes rank,
    share, severity and rate of flagged days of each segment and day, with the attributes of
    ``metadata``.
    """
    daily = segment.daily_series(readers.daily_revenue(spark, revenue_path))
    totals = segment.segment_totals(segment.flag_spikes(segment.rolling_week(daily)))
    tables = {"segment_totals": write_table(totals, "segment_totals", totals_path, run_id)}
    scored = segment.threshold_scores(
        segment.week_over_week(segment.revenue_zscore(segment.rolling_stats(daily)))
    )
    report = segment.performance_report(scored, report_date)
    tables["performance_report"] = write_table(report, "performance_report", report_path, run_id)
    stamp = F.lit(report_date).cast("date").alias("report_date")
    if payload_path is not None:
        payloads = alerts.alert_payload_chunks(scored, report_date)
        tables["alert_payloads"] = write_table(payloads.select("*", stamp), "alert_payloads", payload_path, run_id)
    if summary_path is not None:
        summary = segment.summary_stats(scored)
        tables["report_summary"] = write_table(summary.select("*", stamp), "report_summary", summary_path, run_id)
    if segments_path is not None:
        placed = segment.segment_report(segment.segment_days(daily, metadata), scored)
        tables["segment_report"] = write_table(placed, "segment_report", segments_path, run_id)
    _record(spark, history_path, "segment", run_id, tables)
    written = readers.read_table(spark, report_path, run_id=run_id)
    written = written.where(F.col("report_date") == F.lit(report_date).cast("date")).select(*report.columns)
    if json_path is not None:
        write_json(written, json_path)
    return written


def ledger_job(
    spark: SparkSession,
    events_path: str,
    output_path: str,
    metadata_path: str | None = None,
    keep: str = "first",
    run_id: str | None = None,
    history_path: str | None = None,
) -> None:
    rows = ledger.mrr_ledger(
        readers.billing_events(spark, events_path),
        readers.account_metadata(spark, metadata_path),
        keep,
    )
    written = write_table(rows, "mrr_events", output_path, run_id)
    _record(spark, history_path, "ledger", run_id, {"mrr_events": written})


def cohort_job(
    spark: SparkSession,
    ledger_path: str,
    output_path: str,
    dims: Sequence[str] = cohort.DIMENSIONS,
    densify: bool = True,
    run_id: str | None = None,
    history_path: str | None = None,
) -> None:
    rows = readers.read_table(spark, ledger_path)
    if "cohort_month" not in rows.columns:
        rows = cohort.cohort_key(rows)
    written = write_table(cohort.build_matrix(rows, dims, densify), "cohort_arr_matrix", output_path, run_id)
    _record(spark, history_path, "cohort", run_id, {"cohort_arr_matrix": written})


def allocation_job(
    spark: SparkSession,
    ledger_path: str,
    output_path: str,
    as_of: date | str,
    schedule_path: str | None = None,
    contract_value_basis: str = "recurring",
    rounding_limit: float = allocation.ROUNDING_LIMIT,
    run_id: str | None = None,
    history_path: str | None = None,
) -> None:
    """Ledger and contracts to allocated months. The gate warns where rounding to whole cents
    moves a row by more than ``rounding_limit`` for each month."""
    allocated = allocation.allocate_revenue(
        readers.read_table(spark, ledger_path),
        as_of,
        readers.contract_schedule(spark, schedule_path),
        contract_value_basis,
    )
    watched, seen = quality.observed(allocated, "allocation_gate", allocation.gate_metrics(rounding_limit))
    written = write_table(watched, "allocated_revenue", output_path, run_id, allow_missing=True)
    m = seen.get
    quality.check(m, {"allocation_rounding": not m.get("rounding_breaches")}, on_fail="warn")
    _record(spark, history_path, "allocation", run_id, {"allocated_revenue": written}, m)


def retention_job(
    spark: SparkSession,
    matrix_path: str,
    allocated_path: str,
    output_path: str,
    dims: Sequence[str] = cohort.DIMENSIONS,
    min_accounts: int = retention.MIN_ACCOUNTS,
    run_id: str | None = None,
    history_path: str | None = None,
    revenue_by_slice: bool = False,
) -> DataFrame:
    """Writes the retention table; returns its rows with an implausible NRR. Recognised revenue is
    that of the whole cohort in each of its slices, or with ``revenue_by_slice`` the slice's own."""
    metrics = retention.retention_metrics(
        readers.read_table(spark, matrix_path),
        readers.read_table(spark, allocated_path),
        dims,
        min_accounts,
        revenue_dims=dims if revenue_by_slice else (),
    )
    written = write_table(metrics, "nrr_metrics", output_path, run_id, allow_missing=True)
    odd = retention.implausible_nrr(readers.read_table(spark, output_path, run_id=run_id))
    count = odd.count()
    quality.check({"implausible_rows": count}, {"plausible_nrr": count == 0}, on_fail="warn")
    _record(spark, history_path, "retention", run_id, {"nrr_metrics": written}, {"implausible_rows": count})
    return odd


def waterfall_job(
    spark: SparkSession,
    ledger_path: str,
    metrics_path: str,
    output_path: str,
    basis: str = "active",
    tolerance: float = waterfall.TOLERANCE,
    with_neutral: bool = True,
    run_id: str | None = None,
    history_path: str | None = None,
) -> None:
    """Writes the waterfall only when it reconciles; neutral movements (pauses, changes without
    growth) count as disclosed unless ``with_neutral`` is off."""
    built = park(
        waterfall.arr_waterfall(
            readers.read_table(spark, ledger_path), readers.read_table(spark, metrics_path), basis
        )
    )
    waterfall.require_reconciled(built, tolerance, with_neutral)
    written = write_table(built, "arr_waterfall", output_path, run_id)
    _record(spark, history_path, "waterfall", run_id, {"arr_waterfall": written})
