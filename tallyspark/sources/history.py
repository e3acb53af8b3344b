"""Metrics of runs as one growing table, and gates that compare a run with the ones before."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import quality
from . import publish

SCHEMA = "run_id string, job string, metric string, value double, recorded_at timestamp"


def record(
    spark: SparkSession,
    path: str,
    job: str,
    run_id: str | None,
    metrics: Mapping[str, float],
    moment: datetime | None = None,
) -> None:
    """Add the metrics of a job's run; runs that end at the same time are all kept."""
    at = moment or datetime.now(timezone.utc)
    rows = quality.record_metrics(spark, metrics, run_id or f"{at:%Y%m%dT%H%M%S%f}", job)
    publish.publish(rows.withColumn("recorded_at", F.lit(at).cast("timestamp")).coalesce(1), path, replace="nothing", run_id=run_id)


def read(spark: SparkSession, path: str) -> DataFrame:
    if not publish.is_published(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return publish.read(spark, path)


def changes(metrics: DataFrame, limit: float | None = None) -> DataFrame:
    """Each metric of each run beside its value in the run before: ``previous``, ``change``
    (a share of the previous value, NULL where that is 0 or missing) and, with a ``limit``,
    ``breach`` where the change exceeds it in either direction.

    A run that recorded a metric more than once counts with its last value. A window holds the
    runs of one metric of one job.
    """
    last = (
        metrics.groupBy("job", "metric", "run_id")
        .agg(F.max("recorded_at").alias("recorded_at"), F.max_by("value", "recorded_at").alias("value"))
    )
    runs = Window.partitionBy("job", "metric").orderBy("recorded_at", "run_id")
    before = F.lag("value").over(runs)
    out = last.withColumn("previous", before).withColumn(
        "change", F.when(F.col("previous") != 0, F.round((F.col("value") - F.col("previous")) / F.abs("previous"), 6))
    )
    if limit is not None:
        out = out.withColumn("breach", F.coalesce(F.abs("change") > limit, F.lit(False)))
    return out


def check_change(spark: SparkSession, path: str, job: str, limits: Mapping[str, float], on_fail: str = "raise") -> bool:
    """A gate on the last run of a job: no metric of ``limits`` moved by more than its share."""
    moved = {
        r.metric: r.change
        for r in changes(read(spark, path).where(F.col("job") == job).where(F.col("metric").isin(*limits)))
        .groupBy("metric")
        .agg(F.max_by("change", F.struct("recorded_at", "run_id")).alias("change"))
        .collect()
    }
    rules = {f"{m}_change": moved.get(m) is None or abs(moved[m]) <= limit for m, limit in limits.items()}
    return quality.check(moved, rules, on_fail)
