"""Declared schemas of the input and intermediate tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
}


def schema(columns: str) -> StructType:
    """``"name type, name type"`` as a schema, without needing a running session."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and types of the input tables.
CUSTOMERS = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("first_name", StringType()),
        StructField("last_name", StringType()),
        StructField("email", StringType()),
        StructField("signup_date", DateType()),
        StructField("country", StringType()),
        StructField("segment", StringType()),
    ]
)
ORDERS = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("order_date", DateType()),
        StructField("status", StringType()),
        StructField("total_amount", DoubleType()),
    ]
)
SEGMENT_REVENUE = StructType(
    [
        StructField("date", DateType()),
        StructField("segment", StringType()),
        StructField("revenue_amount", DoubleType()),
        StructField("transaction_count", IntegerType()),
        StructField("avg_basket_size", DoubleType()),
    ]
)
DAILY_REVENUE = StructType(
    [
        StructField("date", DateType()),
        StructField("segment_id", StringType()),
        StructField("revenue_daily", DoubleType()),
        StructField("customer_count", LongType()),
        StructField("avg_order_value", DoubleType()),
    ]
)
BILLING_EVENTS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("subscription_id", StringType()),
        StructField("account_id", StringType()),
        StructField("event_type", StringType()),
        StructField("event_ts", TimestampType()),
        StructField("mrr_before_cents", LongType()),
        StructField("mrr_after_cents", LongType()),
        StructField("plan_id", StringType()),
        StructField("billing_interval", StringType()),
        StructField("country_code", StringType()),
        StructField("created_at", TimestampType()),
        StructField("is_trial", BooleanType()),
    ]
)
ACCOUNT_METADATA = StructType(
    [
        StructField("account_id", StringType()),
        StructField("account_tier", StringType()),
        StructField("csm_owner", StringType()),
        StructField("industry_vertical", StringType()),
        StructField("geo_region", StringType()),
        StructField("first_paid_date", StringType()),
    ]
)
CONTRACT_SCHEDULE = StructType(
    [
        StructField("subscription_id", StringType()),
        StructField("contract_start", DateType()),
        StructField("contract_end", DateType()),
        StructField("contract_arr_cents", LongType()),
        StructField("billing_interval", StringType()),
        StructField("auto_renew", StringType()),
    ]
)
INGEST_ROWS = StructType(
    [
        StructField("id", StringType()),
        StructField("event_ts", StringType()),
        StructField("value", DoubleType()),
    ]
)

# Column renamed by a past migration, canonical name -> accepted older names.
REVENUE_ALIASES = {"revenue_daily": ("daily_revenue",)}

# Column order of the stored tables.
RFM_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "signup_date",
    "country",
    "recency_days",
    "order_count",
    "monetary_value",
    "avg_order_value",
    "stddev_order_value",
    "first_order_date",
    "last_order_date",
    "purchase_velocity",
    "r_score",
    "f_score",
    "m_score",
    "rfm_composite",
    "rfm_cell",
    "rfm_segment",
    "is_high_value",
    "churn_risk_score",
    "ltv_estimate",
    "processing_timestamp",
]
ALERT_COLUMNS = [
    "date",
    "segment",
    "revenue_amount",
    "transaction_count",
    "avg_basket_size",
    "ma_7d",
    "std_7d",
    "ma_30d",
    "std_30d",
    "zscore_30d",
    "bollinger_upper",
    "bollinger_lower",
    "pct_change_1d",
    "is_zscore_anomaly",
    "is_bollinger_breach",
    "is_anomaly",
    "severity_score",
    "severity_band",
    "anomaly_direction",
    "revenue_deviation_abs",
    "revenue_deviation_pct",
    "reference_revenue_usd",
    "segment_customer_count",
    "segment_avg_monetary",
    "segment_avg_rfm",
    "segment_total_monetary",
    "alert_generated_at",
]
LEDGER_COLUMNS = [
    "event_id",
    "subscription_id",
    "account_id",
    "billing_period",
    "event_date",
    "event_type",
    "movement_type",
    "mrr_before_safe",
    "mrr_after_safe",
    "mrr_delta_cents",
    "net_new_mrr_cents",
    "net_new_mrr_dollars",
    "closing_mrr_dollars",
    "plan_id",
    "billing_interval",
    "country_code",
    "account_tier",
    "csm_owner",
    "industry_vertical",
    "geo_region",
    "first_paid_date",
    "cohort_month",
]
ALLOCATION_COLUMNS = [
    "subscription_id",
    "account_id",
    "billing_period",
    "allocated_period",
    "contract_duration_months",
    "movement_type",
    "allocated_mrr_cents_per_month",
    "allocated_mrr_dollars_per_month",
    "recognised_revenue_dollars",
    "recognised_in_period_dollars",
    "deferred_revenue_balance_dollars",
    "recognition_status",
    "allocation_rounding_diff",
    "contract_arr_cents",
    "auto_renew",
    "account_tier",
    "industry_vertical",
    "geo_region",
    "cohort_month",
]
RETENTION_COLUMNS = [
    "cohort_month",
    "billing_period",
    "cohort_index",
    "industry_vertical",
    "geo_region",
    "account_tier",
    "account_count",
    "churned_accounts",
    "total_beginning_arr_dollars",
    "total_closing_arr_dollars",
    "new_arr_dollars",
    "expansion_arr_dollars",
    "contraction_arr_dollars",
    "churn_arr_dollars",
    "nrr_point_in_time",
    "grr_point_in_time",
    "nrr_rolling_12m",
    "logo_retention_rate",
    "rolling_12m_beginning_arr",
    "rolling_12m_expansion",
    "rolling_12m_contraction",
    "rolling_12m_churn",
    "total_recognised_revenue",
]
WATERFALL_COLUMNS = [
    "billing_period",
    "opening_arr",
    "total_closing_arr",
    "waterfall_closing_arr",
    "new_business_arr",
    "expansion_arr",
    "reactivation_arr",
    "contraction_arr",
    "churn_arr",
    "neutral_arr",
    "blended_nrr",
    "avg_grr",
    "avg_nrr_rolling_12m",
    "arr_growth_rate",
    "total_beginning_arr",
]
REPORT_COLUMNS = [
    "report_date",
    "date",
    "segment_id",
    "revenue_daily",
    "revenue_7d_avg",
    "revenue_30d_avg",
    "revenue_zscore",
    "spike_ratio",
    "anomaly_severity",
    "customer_count",
    "avg_order_value",
]
