"""Output tables: column contract, layout, and overwrite rules.

A snapshot table, which its job recomputes in full, is replaced as a whole, so a rerun leaves
no row of a partition that it no longer fills. Other partitioned tables replace only the
partitions they write. Every write is a new version (``publish``): it is seen whole or not at
all, and the version before it stays readable. With ``run_id`` a version holds that run alone;
``readers.read_table`` reads the last version, or the last of a run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import schemas
from .publish import Version, publish


@dataclass(frozen=True)
class Table:
    columns: Sequence[str] | None
    partition_by: Sequence[str] = ()
    files: int | None = None  # only for tables bounded by the calendar
    snapshot: bool = False


TABLES = {
    "rfm_segments": Table(schemas.RFM_COLUMNS, ["rfm_segment"], snapshot=True),
    "revenue_alerts": Table(schemas.ALERT_COLUMNS, ["severity_band", "segment"], snapshot=True),
    "segment_totals": Table(None),
    "segment_report": Table(None),
    "performance_report": Table(None, ["report_date"]),
    "alert_payloads": Table(None, ["report_date"]),
    "report_summary": Table(None, ["report_date"]),
    "escalation_route": Table(None, files=1),
    "mrr_events": Table(schemas.LEDGER_COLUMNS, ["billing_period"], snapshot=True),
    "cohort_arr_matrix": Table(None, ["cohort_month"], snapshot=True),
    "allocated_revenue": Table(schemas.ALLOCATION_COLUMNS, ["allocated_period"], snapshot=True),
    "nrr_metrics": Table(schemas.RETENTION_COLUMNS, ["cohort_month"], snapshot=True),
    "arr_waterfall": Table(schemas.WATERFALL_COLUMNS, files=4),
}


def project(df: DataFrame, columns: Sequence[str], allow_missing: bool = False) -> DataFrame:
    return df.select(*[c for c in columns if not allow_missing or c in df.columns])


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    run_id: str | None = None,
    allow_missing: bool = False,
    metrics: Mapping[str, float] | None = None,
) -> Version:
    """Publish ``df`` as the next version of the named table.

    Rows are rebalanced by partition value before the write: adaptive execution then
    splits the files of a large partition over tasks and joins those of small ones.
    """
    table = TABLES[name]
    if table.columns is not None:
        df = project(df, table.columns, allow_missing)
    partition_by = list(table.partition_by)
    if table.files is not None:
        df = df.coalesce(table.files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    whole = table.snapshot or run_id is not None or not partition_by
    return publish(df, path, partition_by, "all" if whole else "partitions", run_id, metrics)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
