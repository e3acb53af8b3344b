"""One query per operator: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from tallyspark.functions.exprs import one_value, total
from tallyspark.operators import (
    alerts, allocation, anomaly, cohort, ledger, quality, retention, rfm, segment, skew, waterfall,
)
from tallyspark import schemas
from tallyspark.plans.incremental import apply_batch
from tallyspark.plans.jobs import segment_customers
from tallyspark.schemas import ALERT_COLUMNS, WATERFALL_COLUMNS, schema
from tallyspark.scratch import park
from tallyspark.sources import history, publish, readers, writers

from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIMS = ["geo_region"]
SINCE = "1996-01-01"
REPORT_DAY = "1997-03-03"
SNAPSHOT_KEYS = ["account_id", "cohort_month", *DIMS, "billing_period", "cohort_index"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **by_column: int) -> DataFrame:
    """Doubles rounded, so that another engine's last bit does not show."""
    return df.select(
        *[
            F.round(f.name, by_column.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


# --- customer segmentation -------------------------------------------------------


def _paid(spark, sf_dir):
    return rfm.paid_orders(inputs.rfm_orders(spark, sf_dir))


def _enriched(spark, sf_dir):
    return segment_customers(
        inputs.rfm_orders(spark, sf_dir), inputs.rfm_customers(spark, sf_dir)
    )


def _scored_customers(spark, sf_dir):
    totals = park(rfm.customer_totals(_paid(spark, sf_dir)))
    return rfm.with_quintiles(rfm.with_recency(totals)).drop(
        "first_order_date", "last_order_date", "avg_order_value", "stddev_order_value"
    )


@query
def rfm_raw(spark, sf_dir):
    paid = _paid(spark, sf_dir)
    latest = one_value(paid.agg(F.max("order_date").alias("d")), "d")
    return rounded(rfm.with_recency(rfm.customer_totals(paid), latest), stddev_order_value=4)


@query
def rfm_velocity(spark, sf_dir):
    return rfm.customer_totals(_paid(spark, sf_dir)).select(
        "customer_id", "order_count", "first_order_date", "last_order_date",
        rfm.purchase_velocity().alias("purchase_velocity"),
    )


@query
def rfm_quintiles(spark, sf_dir):
    return _scored_customers(spark, sf_dir)


@query
def rfm_segments(spark, sf_dir):
    return rfm.with_segment(_scored_customers(spark, sf_dir))


@query
def rfm_enriched(spark, sf_dir):
    return rounded(_enriched(spark, sf_dir), stddev_order_value=4)


@query
def rfm_distribution(spark, sf_dir):
    return rfm.segment_distribution(_enriched(spark, sf_dir))


@query
def rfm_gate(spark, sf_dir):
    return _enriched(spark, sf_dir).agg(*rfm.gate_metrics())


# --- segment revenue -------------------------------------------------------------


def _daily(spark, sf_dir):
    return inputs.daily_revenue(spark, sf_dir).drop("transaction_count")


def _stats(spark, sf_dir):
    return segment.revenue_zscore(segment.rolling_stats(_daily(spark, sf_dir)))


def _thresholds(spark, sf_dir):
    return segment.threshold_scores(_stats(spark, sf_dir))


ROLLING = [
    "date", "segment_id", "revenue_daily", "revenue_7d_avg", "revenue_7d_std", "revenue_30d_avg",
    "revenue_30d_std",
]


@query
def rolling_7_30(spark, sf_dir):
    return rounded(segment.rolling_stats(_daily(spark, sf_dir)).select(*ROLLING), 4)


@query
def rolling_calendar(spark, sf_dir):
    return rounded(segment.rolling_stats(_daily(spark, sf_dir), "calendar").select(*ROLLING), 4)


@query
def bollinger(spark, sf_dir):
    stats = segment.rolling_stats(_daily(spark, sf_dir))
    return rounded(
        stats.select("date", "segment_id", "revenue_bollinger_upper", "revenue_bollinger_lower"), 4
    )


@query
def revenue_zscore(spark, sf_dir):
    return rounded(_stats(spark, sf_dir).select("date", "segment_id", "revenue_daily", "revenue_zscore"))


@query
def wow_change(spark, sf_dir):
    return segment.week_over_week(_daily(spark, sf_dir)).select(
        "date", "segment_id", "revenue_daily", "revenue_lag_7d", "revenue_wow_pct_change"
    )


@query
def rolling_7_total(spark, sf_dir):
    return rounded(
        segment.rolling_week(_daily(spark, sf_dir)).select(
            "date", "segment_id", "revenue_7d_avg", "revenue_7d_total"
        )
    )


def _flagged(spark, sf_dir):
    return segment.flag_spikes(segment.rolling_week(_daily(spark, sf_dir)))


@query
def revenue_spikes(spark, sf_dir):
    return rounded(
        _flagged(spark, sf_dir).select("date", "segment_id", "revenue_daily", "is_spike", "spike_ratio")
    )


@query
def segment_totals(spark, sf_dir):
    return rounded(segment.segment_totals(_flagged(spark, sf_dir)))


def _segment_days(spark, sf_dir):
    return segment.segment_days(
        inputs.segment_orders(spark, sf_dir), inputs.segment_metadata(spark, sf_dir), SINCE
    )


@query
def segment_daily_join(spark, sf_dir):
    return rounded(_segment_days(spark, sf_dir))


@query
def revenue_rank(spark, sf_dir):
    days = segment.segment_days(inputs.segment_orders(spark, sf_dir))
    return segment.revenue_rank(days).select(
        "segment_id", "date", "segment_revenue_total", "revenue_rank"
    )


@query
def contribution_pct(spark, sf_dir):
    days = segment.segment_days(inputs.segment_orders(spark, sf_dir))
    return segment.contribution_pct(days).select(
        "segment_id", "date", "segment_revenue_total", "revenue_contribution_pct"
    )


@query
def threshold_scores(spark, sf_dir):
    return rounded(
        _thresholds(spark, sf_dir).select(
            "date", "segment_id", "revenue_daily", "spike_ratio", "anomaly_severity",
            "anomaly_description",
        )
    )


@query
def anomalies_only(spark, sf_dir):
    return rounded(segment.anomalies_only(_thresholds(spark, sf_dir)))


@query
def anomaly_rate(spark, sf_dir):
    return rounded(segment.anomaly_rate(_thresholds(spark, sf_dir)), 4)


@query
def summary_stats(spark, sf_dir):
    return rounded(segment.summary_stats(_thresholds(spark, sf_dir)))


@query
def performance_report(spark, sf_dir):
    return rounded(
        segment.performance_report(_thresholds(spark, sf_dir), inputs.AS_OF, REPORT_DAY)
    )


# --- anomaly detection -----------------------------------------------------------


def _windows(spark, sf_dir):
    return anomaly.rolling_windows(
        anomaly.plausible_revenue(inputs.anomaly_revenue(spark, sf_dir))
    )


def _scored(spark, sf_dir):
    return anomaly.score(_windows(spark, sf_dir))


def _alerts(spark, sf_dir):
    stamp = F.lit(inputs.AS_OF).cast("timestamp_ntz")
    return anomaly.alerts(_scored(spark, sf_dir), generated_at=stamp)


@query
def segment_metrics(spark, sf_dir):
    return anomaly.segment_metrics(_enriched(spark, sf_dir))


@query
def anomaly_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


@query
def anomaly_scored(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "date", "segment", "revenue_amount", "zscore_30d", "bollinger_upper", "bollinger_lower",
        "is_zscore_anomaly", "is_bollinger_breach", "is_anomaly",
    )


@query
def anomaly_severity(spark, sf_dir):
    return anomaly.with_severity(_scored(spark, sf_dir)).select(
        "date", "segment", "zscore_30d", "pct_change_1d", "severity_score"
    )


@query
def anomaly_alerts(spark, sf_dir):
    metrics = anomaly.segment_metrics(_enriched(spark, sf_dir))
    stamp = F.lit(inputs.AS_OF).cast("timestamp_ntz")
    found = anomaly.alerts(_scored(spark, sf_dir), metrics, stamp)
    return found.select(*ALERT_COLUMNS)


@query
def alert_summary(spark, sf_dir):
    return anomaly.alert_summary(_alerts(spark, sf_dir))


@query
def alert_volume_gate(spark, sf_dir):
    return rounded(anomaly.alert_rate(_scored(spark, sf_dir)))


@query
def escalation_route(spark, sf_dir):
    return alerts.escalation_route(_alerts(spark, sf_dir))


@query
def alert_payload(spark, sf_dir):
    return alerts.alert_payloads(_thresholds(spark, sf_dir), inputs.AS_OF)


# --- MRR ledger ------------------------------------------------------------------


def _valid(spark, sf_dir):
    return ledger.valid_events(inputs.billing_events(spark, sf_dir))


def _deltas(spark, sf_dir):
    return ledger.one_per_day(ledger.mrr_delta(_valid(spark, sf_dir)))


def _net(spark, sf_dir):
    """The ledger without its account columns, for queries that need none."""
    return ledger.net_movements(_valid(spark, sf_dir))


def _ledger(spark, sf_dir):
    return ledger.mrr_ledger(
        inputs.billing_events(spark, sf_dir), inputs.account_metadata(spark, sf_dir)
    )


NET_COLUMNS = [
    "subscription_id", "billing_period", "event_id", "event_type", "event_date",
    "mrr_after_safe", "net_new_mrr_cents", "net_new_mrr_dollars", "closing_mrr_dollars",
]


@query
def valid_events(spark, sf_dir):
    return _valid(spark, sf_dir)


@query
def intraday_dedup(spark, sf_dir):
    return ledger.one_per_day(inputs.user_mutations(spark, sf_dir))


@query
def mrr_delta(spark, sf_dir):
    return _deltas(spark, sf_dir).select(
        "event_id", "subscription_id", "billing_period", "mrr_before_safe", "mrr_after_safe",
        "mrr_delta_cents",
    )


@query
def period_net_mrr(spark, sf_dir):
    return ledger.period_net(_deltas(spark, sf_dir)).select(*NET_COLUMNS)


@query
def movement_type(spark, sf_dir):
    return _net(spark, sf_dir).select(
        "subscription_id", "billing_period", "event_type", "net_new_mrr_cents", "movement_type"
    )


@query
def mrr_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


# --- cohorts ---------------------------------------------------------------------


def _movements(spark, sf_dir):
    indexed = cohort.cohort_index(park(_ledger(spark, sf_dir)))
    return cohort.arr_movement(cohort.arr_snapshots(indexed, DIMS))


def _matrix_of(rows):
    return cohort.build_matrix(rows, DIMS)


@query
def cohort_key(spark, sf_dir):
    rows = ledger.with_account_metadata(
        ledger.period_net(_deltas(spark, sf_dir)), inputs.account_metadata(spark, sf_dir)
    )
    return cohort.cohort_key(rows).select(
        "subscription_id", "account_id", "billing_period", "first_paid_date", "cohort_month"
    )


@query
def cohort_index(spark, sf_dir):
    return cohort.cohort_index(_ledger(spark, sf_dir)).select(
        "subscription_id", "account_id", "billing_period", "cohort_month", "cohort_index"
    )


@query
def arr_snapshots(spark, sf_dir):
    indexed = cohort.cohort_index(park(_ledger(spark, sf_dir)))
    return cohort.arr_snapshots(indexed, DIMS)


@query
def arr_movement(spark, sf_dir):
    return _movements(spark, sf_dir).select(
        *SNAPSHOT_KEYS, "beginning_arr_dollars", "closing_arr_dollars", "arr_delta_dollars",
        "arr_movement_label",
    )


@query
def cohort_matrix(spark, sf_dir):
    return _matrix_of(park(_ledger(spark, sf_dir))).drop("net_revenue_retention_rate")


@query
def cohort_nrr(spark, sf_dir):
    return _matrix_of(park(_ledger(spark, sf_dir))).select(
        "cohort_month", "cohort_index", "billing_period", *DIMS, "net_revenue_retention_rate"
    )


# --- allocation ------------------------------------------------------------------


TERMS = ["subscription_id", "billing_period", "billing_interval", "closing_mrr_dollars"]


def _allocated(spark, sf_dir):
    return allocation.monthly_allocation(allocation.contract_months(_net(spark, sf_dir)))


@query
def contract_duration(spark, sf_dir):
    return allocation.contract_months(_net(spark, sf_dir)).select(
        *TERMS, "contract_duration_months"
    )


@query
def monthly_allocation(spark, sf_dir):
    return _allocated(spark, sf_dir).select(
        *TERMS, "contract_duration_months", "allocated_mrr_cents_per_month",
        "allocated_mrr_dollars_per_month",
    )


@query
def contract_expand(spark, sf_dir):
    return allocation.expand_months(_allocated(spark, sf_dir)).select(
        "subscription_id", "billing_period", "allocated_period", "contract_duration_months"
    )


@query
def deferred_balance(spark, sf_dir):
    return rounded(
        allocation.deferred_balance(allocation.expand_months(_allocated(spark, sf_dir))).select(
            "subscription_id", "billing_period", "allocated_period", "months_elapsed",
            "recognised_revenue_dollars", "recognised_in_period_dollars",
            "deferred_revenue_balance_dollars",
        ),
        4,
    )


@query
def recognition_status(spark, sf_dir):
    rows = allocation.contract_terms(
        _net(spark, sf_dir), inputs.contract_schedule(spark, sf_dir)
    )
    expanded = allocation.expand_months(allocation.contract_months(rows))
    return allocation.recognition_status(expanded, inputs.AS_OF).select(
        "subscription_id", "billing_period", "allocated_period", "contract_end",
        "recognition_status",
    )


@query
def allocation_recon(spark, sf_dir):
    checked = allocation.rounding_difference(_allocated(spark, sf_dir))
    return allocation.expand_months(checked).select(
        "subscription_id", "billing_period", "allocated_period", "closing_mrr_dollars",
        "sum_allocated_mrr", "allocation_rounding_diff",
    )


@query
def contract_join(spark, sf_dir):
    return allocation.contract_terms(
        _net(spark, sf_dir), inputs.contract_schedule(spark, sf_dir)
    ).select("subscription_id", "billing_period", "contract_arr_cents", "auto_renew", "contract_end")


# --- retention -------------------------------------------------------------------


KEYS = ["cohort_month", "billing_period", "cohort_index", *DIMS]


def _retention_of(rows, schedule):
    allocated = allocation.allocate_revenue(rows, inputs.AS_OF, schedule)
    return retention.retention_metrics(_matrix_of(rows), allocated, DIMS)


@query
def nrr_grr(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.point_in_time(matrix).select(*KEYS, "nrr_point_in_time", "grr_point_in_time")


@query
def rolling_nrr(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.rolling_nrr(matrix, DIMS).select(
        *KEYS, *retention.ROLLED.values(), "nrr_rolling_12m"
    )


@query
def logo_retention(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.logo_retention(matrix).select(
        *KEYS, "account_count", "churned_accounts", "logo_retention_rate"
    )


@query
def recognised_join(spark, sf_dir):
    rows = park(_ledger(spark, sf_dir))
    allocated = allocation.allocate_revenue(
        rows, inputs.AS_OF, inputs.contract_schedule(spark, sf_dir)
    )
    return retention.recognised_revenue(_matrix_of(rows), allocated).select(
        *KEYS, "total_closing_arr_dollars", "total_recognised_revenue"
    )


@query
def nrr_quality(spark, sf_dir):
    rows = park(_ledger(spark, sf_dir))
    return _retention_of(rows, inputs.contract_schedule(spark, sf_dir)).select(
        *KEYS, "account_count", "total_beginning_arr_dollars", "nrr_point_in_time",
        "grr_point_in_time", "nrr_rolling_12m", "logo_retention_rate", "total_recognised_revenue",
    )


@query
def nrr_implausible(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.implausible_nrr(retention.point_in_time(matrix)).select(
        *KEYS, "nrr_point_in_time", "total_beginning_arr_dollars", "expansion_arr_dollars",
        "contraction_arr_dollars", "churn_arr_dollars",
    )


# --- waterfall -------------------------------------------------------------------


def _waterfall(spark, sf_dir):
    rows = park(_ledger(spark, sf_dir))
    metrics = _retention_of(rows, inputs.contract_schedule(spark, sf_dir))
    return waterfall.arr_waterfall(rows, metrics)


@query
def opening_arr(spark, sf_dir):
    return waterfall.opening_arr(_net(spark, sf_dir))


@query
def waterfall_components(spark, sf_dir):
    return waterfall.components(_net(spark, sf_dir))


@query
def blended_nrr(spark, sf_dir):
    rows = park(_ledger(spark, sf_dir))
    return rounded(
        waterfall.blended_nrr(_retention_of(rows, inputs.contract_schedule(spark, sf_dir))), 9
    )


@query
def arr_waterfall(spark, sf_dir):
    built = _waterfall(spark, sf_dir).select(*WATERFALL_COLUMNS)
    return rounded(built, 4, avg_grr=9, avg_nrr_rolling_12m=9)


def _bare_waterfall(spark, sf_dir):
    rows = park(_net(spark, sf_dir))
    joined = waterfall.opening_arr(rows).join(waterfall.components(rows), "billing_period", "full")
    return waterfall.closing_arr(joined)


@query
def waterfall_recon(spark, sf_dir):
    return rounded(waterfall.mismatches(_bare_waterfall(spark, sf_dir)))


@query
def arr_growth(spark, sf_dir):
    return waterfall.growth(waterfall.opening_arr(_net(spark, sf_dir))).select(
        "billing_period", "total_closing_arr", "prior_period_closing_arr", "arr_growth_rate"
    )


# --- data quality ----------------------------------------------------------------

LANDED = schema("id bigint, event_date date, value double, source string")
LANDED_NAMES = {"event_date": ["event_ts"]}


@query
def schema_conform(spark, sf_dir):
    return quality.conform(inputs.landing_rows(spark, sf_dir), LANDED, LANDED_NAMES)


def _landing_rules(rows):
    return {
        **quality.present("id", "event_ts"),
        **quality.unreadable(rows, LANDED, LANDED_NAMES),
    }


@query
def ingest_quality(spark, sf_dir):
    rows = inputs.landing_rows(spark, sf_dir)
    return quality.ingest_counts(rows, quality.present("id", "event_ts"))


@query
def quarantine(spark, sf_dir):
    rows = inputs.landing_rows(spark, sf_dir)
    _, bad = quality.split_valid(rows, _landing_rules(rows))
    return bad.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@query
def quality_metrics(spark, sf_dir):
    rows = inputs.landing_rows(spark, sf_dir)
    return quality.metric_rows(quality.key_metrics(rows), inputs.RUN_ID, "quality")


CANARY_COLUMNS = ["event_id", "user_id", "event_type"]


@query
def canary(spark, sf_dir):
    # The output holds every row; the type of error events was damaged on the way.
    events = inputs.table(spark, sf_dir, "events")
    output = events.replace("error", "fault", "event_type")
    found = quality.compare_canaries(events, output, CANARY_COLUMNS, "md5")
    return found.select(
        *[
            F.col(f"{s}_{v}").cast("bigint").alias(f"{s}_{v}")
            for s in ("source", "output")
            for v in ("row_count", "checksum")
        ],
        "matches",
    )


@query
def manifest_check(spark, sf_dir):
    # Every row is listed and stored: one day was stored under another date, and the error
    # events of Sundays were damaged.
    events = inputs.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    sunday = F.dayofweek("day") == 1
    stored = events.withColumns(
        {
            "day": F.when(F.col("day") == "2024-01-05", F.to_date(F.lit("2023-12-31"))).otherwise(F.col("day")),
            "event_type": F.when(sunday & (F.col("event_type") == "error"), "fault").otherwise(F.col("event_type")),
        }
    )
    listed, there = (quality.manifest(df, CANARY_COLUMNS, ["day"], "md5") for df in (events, stored))
    return quality.check_manifest(listed, there, ["day"]).select(
        "day", "expected_rows", F.col("expected_checksum").cast("bigint").alias("expected_checksum"),
        "actual_rows", F.col("actual_checksum").cast("bigint").alias("actual_checksum"), "status",
    )


@query
def skew_report(spark, sf_dir):
    return quality.skew_report(inputs.table(spark, sf_dir, "events"), "event_type", threshold=0.2)


@query
def salted_aggregate(spark, sf_dir):
    return quality.salted_totals(
        inputs.table(spark, sf_dir, "lineitem"), "l_returnflag", "l_orderkey", "l_extendedprice"
    )


@query
def failure_signals(spark, sf_dir):
    # Lists and maps as JSON text, which every engine can compare.
    signal = alerts.failure_signals(inputs.failure_log(spark, sf_dir))
    nested = {"artifacts", "code_paths", "config"}
    return signal.select(
        *[F.to_json(c).alias(c) if c in nested else F.col(c) for c in signal.columns]
    )


# --- options and reports of the operators above --------------------------------------


@query
def ledger_keep_last(spark, sf_dir):
    return ledger.mrr_ledger(
        inputs.billing_events(spark, sf_dir), inputs.account_metadata(spark, sf_dir), keep="last"
    )


@query
def ledger_without_metadata(spark, sf_dir):
    return ledger.mrr_ledger(inputs.billing_events(spark, sf_dir))


@query
def cohort_matrix_dimensions(spark, sf_dir):
    matrix = cohort.build_matrix(park(_ledger(spark, sf_dir)), cohort.DIMENSIONS)
    return matrix.drop("net_revenue_retention_rate")


@query
def deferred_upfront(spark, sf_dir):
    expanded = allocation.expand_months(_allocated(spark, sf_dir))
    return rounded(
        allocation.deferred_balance(expanded, "upfront").select(
            "subscription_id", "billing_period", "allocated_period", "months_elapsed",
            "recognised_revenue_dollars", "recognised_in_period_dollars", "deferred_revenue_balance_dollars",
        ),
        4,
    )


@query
def logo_as_written(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.logo_retention(matrix, mode="as_written").select(
        *KEYS, "account_count", "churned_accounts", "logo_retention_rate"
    )


@query
def recognised_by_slice(spark, sf_dir):
    rows = park(_ledger(spark, sf_dir))
    allocated = allocation.allocate_revenue(
        rows, inputs.AS_OF, inputs.contract_schedule(spark, sf_dir)
    )
    return retention.recognised_revenue(_matrix_of(rows), allocated, dims=DIMS).select(
        *KEYS, "total_closing_arr_dollars", "total_recognised_revenue"
    )


@query
def worst_mismatches(spark, sf_dir):
    return rounded(waterfall.mismatches(_bare_waterfall(spark, sf_dir), limit=10))


@query
def implausible_sample(spark, sf_dir):
    matrix = _matrix_of(park(_ledger(spark, sf_dir)))
    return retention.implausible_nrr(retention.point_in_time(matrix), limit=20).select(
        *KEYS, "nrr_point_in_time", "total_beginning_arr_dollars"
    )


@query
def contract_in_force(spark, sf_dir):
    rows = allocation.contract_terms(_net(spark, sf_dir), inputs.contract_renewals(spark, sf_dir))
    expanded = allocation.expand_months(allocation.contract_months(rows))
    return allocation.recognition_status(expanded, inputs.AS_OF).select(
        "subscription_id", "billing_period", "allocated_period", "contract_arr_cents", "auto_renew",
        "contract_end", "recognition_status",
    )


@query
def payload_chunks(spark, sf_dir):
    return alerts.alert_payload_chunks(_thresholds(spark, sf_dir), inputs.AS_OF, most=5)


@query
def segment_report(spark, sf_dir):
    days = segment.segment_days(inputs.segment_orders(spark, sf_dir), inputs.segment_metadata(spark, sf_dir))
    return rounded(segment.segment_report(days, _thresholds(spark, sf_dir)))


# --- skew --------------------------------------------------------------------------


@query
def heavy_hitters(spark, sf_dir):
    return skew.heavy_hitters(inputs.table(spark, sf_dir, "lineitem"), "l_suppkey", 0.0102)


@query
def skew_join(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    suppliers = inputs.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = skew.skew_join(items, suppliers, "s_suppkey", ["l_orderkey", "l_linenumber"], partitions=256)
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("row_count"), total("l_extendedprice").alias("amount"))


@query
def salted_repartition(spark, sf_dir):
    # Three flags, the largest with half of all rows, over 16 partitions.
    items = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    dealt = skew.spread(items, "l_returnflag", ["l_orderkey", "l_linenumber"], 16)
    counts = park(dealt.withColumn("part", F.spark_partition_id()).groupBy("part", "l_returnflag").count())
    loads = counts.groupBy("part").agg(F.sum("count").alias("n"))
    even = loads.agg((F.max("n") * 16 <= F.sum("n") * 2).alias("even"))
    return counts.groupBy("l_returnflag").agg(F.sum("count").alias("row_count")).withColumn(
        "is_balanced", one_value(even, "even")
    )


# --- files and published tables ------------------------------------------------------


@query
def schema_merge(spark, sf_dir):
    return readers.read_csv(
        spark, inputs.landed_orders(spark, sf_dir), schemas.ORDERS, {"order_date": ["ordered_on"]}
    )


@query
def source_customers(spark, sf_dir):
    people = inputs.rfm_customers(spark, sf_dir).withColumn("signup_date", F.lit("2021-03-15"))
    return readers.customers(spark, inputs.landed(people)).select(
        "customer_id", "first_name", "country", "segment", "signup_date"
    )


@query
def source_revenue(spark, sf_dir):
    return readers.segment_revenue(spark, inputs.landed(inputs.anomaly_revenue(spark, sf_dir)))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as the named table and read back from its last version."""
    path, df = inputs.landing_folder(df.sparkSession), park(df)
    writers.write_table(df.limit(3), name, path, allow_missing=True)
    writers.write_table(df, name, path, allow_missing=True)
    return readers.read_table(df.sparkSession, path).select(*[f"`{c}`" for c in df.columns])


@query
def stored_segments(spark, sf_dir):
    return _stored(rfm_enriched(spark, sf_dir).drop("segment"), "rfm_segments")


@query
def stored_alerts(spark, sf_dir):
    found = anomaly_alerts(spark, sf_dir)
    return _stored(found.select(*[c for c in schemas.ALERT_COLUMNS if c in found.columns]), "revenue_alerts")


@query
def stored_totals(spark, sf_dir):
    return _stored(segment_totals(spark, sf_dir), "segment_totals")


@query
def stored_report(spark, sf_dir):
    return _stored(performance_report(spark, sf_dir), "performance_report")


@query
def stored_ledger(spark, sf_dir):
    return _stored(_ledger(spark, sf_dir), "mrr_events")


@query
def stored_matrix(spark, sf_dir):
    return _stored(cohort_matrix(spark, sf_dir), "cohort_arr_matrix")


@query
def stored_allocation(spark, sf_dir):
    allocated = allocation.allocate_revenue(
        _net(spark, sf_dir), inputs.AS_OF, inputs.contract_schedule(spark, sf_dir)
    )
    return _stored(
        allocated.select(
            "subscription_id", "billing_period", "allocated_period", "allocated_mrr_cents_per_month",
            "recognition_status", "contract_arr_cents", "auto_renew",
        ),
        "allocated_revenue",
    )


@query
def stored_metrics(spark, sf_dir):
    found = nrr_quality(spark, sf_dir)
    return _stored(found.select(*[c for c in schemas.RETENTION_COLUMNS if c in found.columns]), "nrr_metrics")


@query
def stored_waterfall(spark, sf_dir):
    return _stored(arr_waterfall(spark, sf_dir), "arr_waterfall")


@query
def ledger_batches(spark, sf_dir):
    # Three batches without order in time, so that each holds late events. What all of them
    # read is written once.
    events, path = park(inputs.billing_events(spark, sf_dir)), inputs.landing_folder(spark)
    metadata = park(inputs.account_metadata(spark, sf_dir))
    for i in range(3):
        batch = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i)
        apply_batch(spark, batch, f"{path}/state", f"{path}/ledger", metadata)
    return readers.read_table(spark, f"{path}/ledger").select(*schemas.LEDGER_COLUMNS)


@query
def run_history(spark, sf_dir):
    # Each day of events as a run that counts its types, recorded in two appends.
    path = inputs.landing_folder(spark)
    days = inputs.table(spark, sf_dir, "events").groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("event_type").alias("metric")
    ).agg(F.count("*").cast("double").alias("value"))
    rows = days.select(
        "run_id", F.lit("load").alias("job"), "metric", "value", F.to_timestamp("run_id").alias("recorded_at")
    )
    for half in (F.substring("run_id", 9, 2) > "15", F.substring("run_id", 9, 2) <= "15"):
        publish.publish(rows.where(half), path, replace="nothing")
    return history.changes(history.read(spark, path), limit=0.1).drop("recorded_at")
