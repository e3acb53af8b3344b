"""The MRR ledger kept up to date by batches of events, in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import ledger
from ..schemas import ACCOUNT_METADATA, LEDGER_COLUMNS
from ..scratch import park
from ..sources import history, publish, readers

#: What a day's mutation keeps of its event: all that the ledger is made from.
DAY_COLUMNS = [
    "event_id", "subscription_id", "account_id", "event_type", "event_ts", "created_at", "plan_id",
    "billing_interval", "country_code", "mrr_before_safe", "mrr_after_safe", "mrr_delta_cents", "billing_period",
]
DIMENSION = [*[f.name for f in ACCOUNT_METADATA if f.name != "account_id"], "cohort_month"]


def _stored(spark: SparkSession, path: str, like: StructType, periods: list[str] | None = None) -> DataFrame:
    """The last version's rows (of ``periods``: from their folders only), or none of that shape."""
    if not publish.is_published(spark, path):
        return spark.createDataFrame([], like)
    return readers.read_table(spark, path, periods=periods)


def _periods(df: DataFrame) -> list[str]:
    return sorted(r[0] for r in df.select("billing_period").distinct().collect())  # calendar months


def apply_batch(
    spark: SparkSession,
    events: DataFrame,
    state_path: str,
    ledger_path: str,
    metadata: DataFrame | None = None,
    keep: str = "first",
    run_id: str | None = None,
    history_path: str | None = None,
) -> dict[str, float]:
    """Bring the ledger at ``ledger_path`` up to date with a batch of raw events.

    After any number of batches, in any order, late and repeated events included, the ledger has
    the rows of one run over all events with the metadata of the last batch. The state is the
    one mutation kept of each subscription and day, by month, and one row per account: its first
    event, its attributes and its months. A batch reads and rewrites only the months it touches:

    * the days of the months of its events are taken together with its events in one exchange,
      and the ledger of these months is worked out from the days as published: no row is looked
      up in a list of what the batch holds, so a batch of any size costs its months alone;
    * other months in which accounts have changed cohort month or attributes get them.

    The accounts are published last: when a batch fails before that, its repetition finds the
    same work to do. Returns the counts of the batch.
    """
    days_path, accounts_path = f"{state_path}/days", f"{state_path}/accounts"
    batch = park(ledger.mrr_delta(ledger.valid_events(events)).select(*DAY_COLUMNS))
    periods = _periods(batch)
    by_month = ["billing_period"]

    day_schema = ledger.one_per_day(batch.limit(0), keep).schema
    known = _stored(spark, days_path, day_schema, periods).select(*DAY_COLUMNS)
    days = ledger.one_per_day(known.unionByName(batch), keep)
    written = {
        "days": publish.publish(days.hint("rebalance", *by_month), days_path, by_month, "partitions", run_id)
    }
    days = _stored(spark, days_path, day_schema, periods)

    firsts = batch.groupBy("account_id").agg(
        F.min("event_ts").alias("event_ts"), F.collect_set("billing_period").alias("months")
    )
    empty = firsts.limit(0).select("*", *[F.lit("").alias(c) for c in DIMENSION])
    before = _stored(spark, accounts_path, empty.schema)
    merged = park(
        before.select(*firsts.columns).unionByName(firsts)
        .groupBy("account_id")
        .agg(F.min("event_ts").alias("event_ts"), F.array_distinct(F.flatten(F.collect_list("months"))).alias("months"))
    )  # two rows an account at most
    dimension = ledger.account_dimension(merged.select("account_id", "event_ts"), metadata).select(
        "account_id", *[F.col(c).cast("string").alias(c) for c in DIMENSION]
    )
    accounts = park(merged.join(dimension, "account_id", "left").select(*firsts.columns, *DIMENSION))
    same = F.lit(True)
    for c in DIMENSION:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(c))
    old = before.select("account_id", *[F.col(c).alias(f"old_{c}") for c in DIMENSION])
    changed = park(accounts.join(old, "account_id").where(~same).select("account_id", "months", *DIMENSION))
    moved = changed.select(F.explode("months").alias("billing_period"))
    touched = sorted({*periods, *_periods(moved)})

    net = ledger.movement_type(ledger.period_net(days))
    rows = net.join(accounts.select("account_id", *DIMENSION), "account_id", "left").select(*LEDGER_COLUMNS)
    others = [m for m in touched if m not in periods]
    if others:
        new = changed.select("account_id", F.lit(True).alias("__changed"), *[F.col(c).alias(f"__{c}") for c in DIMENSION])
        stored = _stored(spark, ledger_path, rows.schema, others).join(new, "account_id", "left")
        same_columns = [c for c in LEDGER_COLUMNS if c not in DIMENSION]
        stored = stored.select(
            *same_columns, *[F.when(F.col("__changed"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in DIMENSION]
        )
        rows = rows.unionByName(stored.select(*LEDGER_COLUMNS))

    written["mrr_events"] = publish.publish(
        rows.hint("rebalance", *by_month), ledger_path, by_month, "partitions", run_id
    )
    written["accounts"] = publish.publish(accounts, accounts_path, (), "all", run_id)
    counts = {f"{name}_rows": float(v.row_count) for name, v in written.items()}
    counts |= {"touched_periods": float(len(touched)), "changed_accounts": float(changed.count())}
    if history_path is not None:
        history.record(spark, history_path, "ledger_batch", run_id, counts)
    return counts
