"""The test tables in the shape of the library's inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tallyspark.functions.exprs import total, units
from tallyspark.scratch import shared_folder

AS_OF = "1998-06-15"
RUN_ID = "run-1"
STATUS = {"F": "DELIVERED", "O": "COMPLETED", "P": "PENDING"}
EVENT_OF_PRIORITY = {
    "1-URGENT": "upgrade",
    "2-HIGH": "new_subscription",
    "3-MEDIUM": "plan_change",
    "4-NOT SPECIFIED": "downgrade",
    "5-LOW": "cancellation",
}
INTERVALS = ("monthly", "Quarterly", "ANNUAL", "biennial")
RFM_LABEL = {
    "AUTOMOBILE": "Champions",
    "BUILDING": "Loyal",
    "FURNITURE": "At-Risk",
    "HOUSEHOLD": "Lost",
    "MACHINERY": "New",
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table; its schema is looked up in the file once, not on every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _lookup(mapping: dict[str, str], key: str) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(key))


# --- customers and daily revenue ----------------------------------------------


def rfm_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        _lookup(STATUS, "o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
    )


def rfm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One revenue record per order."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.to_date("o_orderdate").alias("date"),
            F.col("c_mktsegment").alias("segment_id"),
            F.col("o_totalprice").alias("revenue_daily"),
        )
    )


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per segment and day.

    Orders collapse to customer x day before they meet the customers, so a customer with a
    large share of all orders reaches the join as one row per day, and the distinct
    customers of a segment's day are its rows.
    """
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.sum(units("o_totalprice")).alias("u"), F.count("*").alias("n"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    amount = F.sum("u") / 10_000.0
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("date", F.col("c_mktsegment").alias("segment_id"))
        .agg(
            amount.alias("revenue_daily"),
            F.count("*").alias("customer_count"),
            F.round(amount / F.sum("n"), 2).alias("avg_order_value"),
            F.sum("n").cast("int").alias("transaction_count"),
        )
    )


def segment_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_mktsegment").alias("segment_id"))
        .agg(total("c_acctbal").alias("segment_balance"), F.count("*").alias("segment_accounts"))
    )


def anomaly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue with the segments named like customer segments."""
    return daily_revenue(spark, sf_dir).select(
        "date",
        _lookup(RFM_LABEL, "segment_id").alias("segment"),
        F.col("revenue_daily").alias("revenue_amount"),
        "transaction_count",
        F.col("avg_order_value").alias("avg_basket_size"),
    )


# --- subscriptions -------------------------------------------------------------


def _billing(orders: DataFrame) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    kind = (
        F.when(key % 17 == 0, "usage_report")
        .when(key % 13 == 0, "pause")
        .when(key % 11 == 0, "reactivation")
        .otherwise(_lookup(EVENT_OF_PRIORITY, "o_orderpriority"))
    )
    at = F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate"))
    return orders.select(
        key.alias("event_id"),
        (customer * 10 + key % 2).alias("subscription_id"),
        customer.alias("account_id"),
        kind.alias("event_type"),
        at.alias("event_ts"),
        F.floor("o_totalprice").alias("list_cents"),
        F.concat(F.lit("plan_"), key % 3).alias("plan_id"),
        F.element_at(F.array(*map(F.lit, (*INTERVALS, None))), (customer % 5 + 1).cast("int")).alias(
            "billing_interval"
        ),
        F.concat(F.lit("N"), customer % 25).alias("country_code"),
        at.alias("created_at"),
        F.when(key % 19 != 0, key % 20 == 0).alias("is_trial"),
    ).withColumn(
        "mrr_after_cents",
        F.when(F.col("event_type") == "cancellation", F.lit(0).cast("bigint")).otherwise(
            F.col("list_cents")
        ),
    ).drop("list_cents")


def billing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose MRR before is the subscription's MRR at the end of its day before.

    The chain runs over days, at most one row per calendar day and subscription, so that
    no task sorts the whole history of one subscription.
    """
    events = _billing(table(spark, sf_dir, "orders")).withColumn("day", F.to_date("event_ts"))
    day_keys = ["subscription_id", "day"]
    over_days = Window.partitionBy("subscription_id").orderBy("day")
    days = (
        events.groupBy(*day_keys)
        .agg(F.max_by("mrr_after_cents", F.struct("event_ts", "event_id")).alias("day_end"))
        .select(*day_keys, F.lag("day_end").over(over_days).alias("day_start"))
    )
    return (
        events.join(days, day_keys, "left")
        .withColumn("mrr_before_cents", F.coalesce("day_start", F.lit(0).cast("bigint")))
        .drop("day", "day_start")
    )


def account_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("account_id"))
        .agg(F.to_date(F.min("o_orderdate")).alias("first_order"))
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    balance = F.col("c_acctbal")
    return customers.join(first, F.col("c_custkey") == F.col("account_id")).select(
        "account_id",
        F.when(balance < 0, "basic").when(balance < 5000, "standard").otherwise("premium").alias(
            "account_tier"
        ),
        F.concat(F.lit("csm_"), F.col("account_id") % 7).alias("csm_owner"),
        F.col("c_mktsegment").alias("industry_vertical"),
        F.col("r_name").alias("geo_region"),
        F.when(F.col("account_id") % 5 != 0, F.date_format("first_order", "yyyy-MM-dd")).alias(
            "first_paid_date"
        ),
    )


def contract_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years per subscription from its first order."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") * 10 + F.col("o_orderkey") % 2).alias("subscription_id"))
        .agg(
            F.to_date(F.min("o_orderdate")).alias("contract_start"),
            (F.max(F.floor("o_totalprice")) * 12).alias("contract_arr_cents"),
        )
        .select(
            "subscription_id",
            "contract_start",
            F.add_months("contract_start", 24).alias("contract_end"),
            "contract_arr_cents",
            F.when(F.col("subscription_id") % 3 == 0, "Y").otherwise("N").alias("auto_renew"),
        )
    )


def contract_renewals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract of eight months for each subscription and year with orders, from the first one."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            (F.col("o_custkey") * 10 + F.col("o_orderkey") % 2).alias("subscription_id"),
            F.year("o_orderdate").alias("year"),
        )
        .agg(
            F.to_date(F.min("o_orderdate")).alias("contract_start"),
            (F.max(F.floor("o_totalprice")) * 12).alias("contract_arr_cents"),
        )
        .select(
            "subscription_id",
            "contract_start",
            F.add_months("contract_start", 8).alias("contract_end"),
            "contract_arr_cents",
            F.when(F.col("year") % 2 == 0, "Y").otherwise("N").alias("auto_renew"),
        )
    )


# --- files as they land ------------------------------------------------------------


def landed_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as CSV files of three versions: all columns, one missing, one renamed and one new."""
    folder = landing_folder(spark)
    rows = rfm_orders(spark, sf_dir)
    third = F.pmod("order_id", F.lit(3))
    versions = (
        rows.where(third == 0),
        rows.where(third == 1).select("status", "total_amount", "order_id", "order_date"),
        rows.where(third == 2).withColumnRenamed("order_date", "ordered_on").withColumn("channel", F.lit("a, b")),
    )
    for version in versions:
        version.write.mode("append").option("header", True).csv(folder)
    return folder


def landed(df: DataFrame) -> str:
    folder = landing_folder(df.sparkSession)
    df.write.option("header", True).csv(folder)
    return folder


def landing_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


# --- event stream tables ---------------------------------------------------------


def user_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("subscription_id"),
        F.col("ts").alias("event_ts"),
        F.col("ts").alias("created_at"),
        "event_type",
    )


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows as they land: some without id or time, some with an unreadable value."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(key % 50 != 0, key.cast("string")).alias("id"),
        F.when(key % 77 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("event_ts"),
        F.when(key % 91 == 0, "n/a").otherwise((key % 1000).cast("string")).alias("value"),
        "event_type",
    )


def failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    """Every event as a failure record."""
    return (
        table(spark, sf_dir, "events")
        .select(
            F.concat(F.lit("job_"), F.col("user_id") % 10).alias("job_id"),
            F.concat(F.lit("run_"), key).alias("run_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.concat(F.lit("signature_"), key % 7).alias("error_signature"),
            F.col("props").alias("log_excerpt"),
            F.when(key % 2 == 0, F.array(F.concat(F.lit("log_"), key))).alias("artifacts"),
            F.when(key % 3 == 0, F.array(F.lit("main.py"))).alias("code_paths"),
            F.when(key % 5 == 0, F.create_map(F.lit("retries"), (key % 4).cast("string"))).alias(
                "config"
            ),
        )
    )
