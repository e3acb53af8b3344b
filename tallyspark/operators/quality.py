"""Data quality: schema reconciliation, quarantine, canary, manifest, skew, gates."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.exprs import UNITS, one_value, units

log = logging.getLogger(__name__)

Aliases = Mapping[str, Sequence[str]]


# --- schema drift ------------------------------------------------------------


def _sources(df: DataFrame, field: StructField, aliases: Aliases) -> list[str]:
    return [n for n in (field.name, *aliases.get(field.name, ())) if n in df.columns]


def text_as(value: Column, field: StructField) -> Column:
    """A text value as declared, NULL where it does not parse."""
    if isinstance(field.dataType, DateType):
        return F.try_to_date(value, "yyyy-MM-dd")
    return value.try_cast(field.dataType)


def _read_as(df: DataFrame, name: str, field: StructField) -> Column:
    if isinstance(df.schema[name].dataType, StringType):
        return text_as(F.col(name), field)
    return F.col(name).try_cast(field.dataType)


def conform(df: DataFrame, schema: StructType, aliases: Aliases | None = None) -> DataFrame:
    """The declared columns, by name: renamed from older names, cast, NULL where absent.

    A value that does not parse becomes NULL; ``unreadable`` finds those rows.
    """
    aliases = aliases or {}

    def column(field: StructField) -> Column:
        found = [_read_as(df, n, field) for n in _sources(df, field, aliases)]
        value = F.coalesce(*found) if found else F.lit(None).cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema])


def unreadable(
    df: DataFrame, schema: StructType, aliases: Aliases | None = None
) -> dict[str, Column]:
    """Rules for ``split_valid``: each column that is present must parse as declared."""
    rules = {}
    for field in schema:
        for name in _sources(df, field, aliases or {}):
            rules[f"{name}_readable"] = F.col(name).isNull() | _read_as(df, name, field).isNotNull()
    return rules


def merge_versions(
    versions: Iterable[DataFrame], schema: StructType, aliases: Aliases | None = None
) -> DataFrame:
    """Landing files of several schema versions as one table."""
    return reduce(DataFrame.unionByName, (conform(v, schema, aliases) for v in versions))


# --- quarantine --------------------------------------------------------------


def present(*columns: str) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in columns}


def is_valid(rules: Mapping[str, Column]) -> Column:
    """True when every rule holds; an undecided rule counts as failed."""
    return reduce(lambda a, b: a & b, (F.coalesce(r, F.lit(False)) for r in rules.values()))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``failed_rules``); together exactly the input."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()])
    )
    return df.filter(is_valid(rules)), df.filter(~is_valid(rules)).withColumn("failed_rules", failed)


def ingest_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: bronze (all), silver (valid) and bad rows."""
    return df.agg(
        F.count("*").alias("bronze"),
        F.count_if(is_valid(rules)).alias("silver"),
        F.count_if(~is_valid(rules)).alias("bad"),
    )


def key_metrics(df: DataFrame, key: str = "id") -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col(key).isNull()).alias("null_key_rows")
    )


# --- canary and manifest -----------------------------------------------------


def row_hash(columns: Sequence[str], algorithm: str = "xxhash64") -> Column:
    """Whole-number hash of a row that tells NULL from empty and one column from the next.

    ``md5`` (its first 32 bits) can be recomputed by any other system.
    """
    if algorithm == "xxhash64":
        return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def fingerprint(columns: Sequence[str], algorithm: str = "xxhash64") -> list[Column]:
    """Row count and order-independent checksum, as aggregates."""
    return [
        F.count("*").alias("row_count"),
        F.sum(row_hash(columns, algorithm).cast("decimal(20,0)")).alias("checksum"),
    ]


def canary(df: DataFrame, columns: Sequence[str], algorithm: str = "xxhash64") -> DataFrame:
    """One row: row count and an order-independent checksum."""
    return df.agg(*fingerprint(columns, algorithm))


def compare_canaries(
    source: DataFrame, output: DataFrame, columns: Sequence[str], algorithm: str = "xxhash64"
) -> DataFrame:
    """One row: both fingerprints and whether they match."""
    sides = [
        canary(df, columns, algorithm).withColumn("side", F.lit(side))
        for side, df in (("source", source), ("output", output))
    ]

    def of(side: str, value: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(value)))

    both = sides[0].unionByName(sides[1]).agg(
        *[
            of(side, value).alias(f"{side}_{value}")
            for side in ("source", "output")
            for value in ("row_count", "checksum")
        ]
    )
    same = F.col("source_row_count").eqNullSafe(F.col("output_row_count")) & F.col(
        "source_checksum"
    ).eqNullSafe(F.col("output_checksum"))
    return both.withColumn("matches", same)


def manifest(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] | None = None,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """Rows and checksum per ``keys``, by default per data file of a file-backed table."""
    if keys is None:
        df, keys = df.withColumn("path", F.col("_metadata.file_path")), ["path"]
    return df.groupBy(*keys).agg(*fingerprint(columns, algorithm))


def check_manifest(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    """Entries that differ: ``missing`` from the table, ``unlisted``, or ``changed``."""
    e, a = (
        df.select(*keys, F.col("row_count").alias(f"{n}_rows"), F.col("checksum").alias(f"{n}_checksum"))
        for n, df in (("expected", expected), ("actual", actual))
    )
    same = F.col("expected_rows").eqNullSafe(F.col("actual_rows")) & F.col(
        "expected_checksum"
    ).eqNullSafe(F.col("actual_checksum"))
    return e.join(a, list(keys), "full").withColumn(
        "status",
        F.when(F.col("actual_rows").isNull(), "missing")
        .when(F.col("expected_rows").isNull(), "unlisted")
        .when(~same, "changed"),
    ).filter("status IS NOT NULL")


# --- skew --------------------------------------------------------------------


def skew_report(df: DataFrame, key: str, limit: int | None = None, threshold: float = 0.3) -> DataFrame:
    """All keys, or the ``limit`` heaviest, with their share of all rows."""
    everything = one_value(df.agg(F.count("*").alias("n")), "n")
    counts = df.groupBy(key).agg(F.count("*").alias("row_count"))
    if limit is not None:
        counts = counts.orderBy(F.desc("row_count"), F.col(key).asc_nulls_first()).limit(limit)
    return (
        counts.withColumn("share", F.round(F.col("row_count") / everything, 6))
        .withColumn("is_skewed", F.col("share") > threshold)
    )


def salt(spread_by: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")


def salted_repartition(
    df: DataFrame, key: str, spread_by: str, salts: int, partitions: int | None = None
) -> DataFrame:
    """Repartition so that one key's rows spread over up to ``salts`` partitions."""
    by = (F.col(key), salt(spread_by, salts))
    return df.repartition(partitions, *by) if partitions else df.repartition(*by)


def salted_totals(df: DataFrame, key: str, spread_by: str, amount: str, salts: int = 32) -> DataFrame:
    """Rows, distinct ``spread_by`` values and sum per key, in two stages.

    All rows of a ``spread_by`` value share a salt, so distinct counts of the first stage
    add up, and a hot key is counted by ``salts`` tasks.
    """
    first = df.groupBy(key, salt(spread_by, salts).alias("salt")).agg(
        F.count("*").alias("row_count"),
        F.countDistinct(spread_by).alias("distinct_count"),
        F.sum(units(amount)).alias("amount_units"),
    )
    return first.groupBy(key).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("distinct_count").alias("distinct_count"),
        (F.sum("amount_units") / float(UNITS)).alias("total_amount"),
    )


# --- gates -------------------------------------------------------------------


class GateFailed(RuntimeError):
    """A quality rule does not hold."""


def check(metrics: Mapping[str, object], rules: Mapping[str, bool], on_fail: str = "raise") -> bool:
    """Log the metrics; raise or warn with the names of the rules that do not hold."""
    if on_fail not in ("raise", "warn"):
        raise ValueError(f"on_fail must be 'raise' or 'warn', got {on_fail!r}")
    broken = [name for name, holds in rules.items() if not holds]
    log.info("gate metrics: %s", dict(metrics))
    if broken:
        message = f"quality gate: {', '.join(broken)} failed with {dict(metrics)}"
        if on_fail == "raise":
            raise GateFailed(message)
        log.warning(message)
    return not broken


def observed(df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, Observation]:
    """Attach metrics that the next action computes on the way, without a pass of their own."""
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


def stamped(counts: DataFrame, moment: datetime | None = None, column: str = "ts") -> DataFrame:
    """Counts with the time they were taken, by default now."""
    return counts.withColumn(column, F.lit(moment) if moment else F.current_timestamp())


def record_metrics(
    spark: SparkSession, metrics: Mapping[str, float], run_id: str, job: str
) -> DataFrame:
    """Observed metrics of a job as rows for a run metrics table."""
    rows = [(run_id, job, name, None if v is None else float(v)) for name, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, job string, metric string, value double")


def metric_rows(one_row: DataFrame, run_id: str, job: str) -> DataFrame:
    """A one-row aggregate as (run_id, job, metric, value) rows for a run metrics table."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in one_row.columns
    ]
    return one_row.select(F.lit(run_id).alias("run_id"), F.lit(job).alias("job"), F.inline(F.array(*pairs)))
