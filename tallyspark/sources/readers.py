"""Input tables. CSV is matched to its schema by header name, Parquet by declared schema."""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from .. import schemas
from ..operators.quality import Aliases, conform, text_as
from ..scratch import park
from . import publish


MOST_VERSIONS = 1000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of all files in one job: the first line of each file's first block."""
    first = _lines(spark, path).where("start = 0").withColumn("line", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def _names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]), [])


def _headers(found: DataFrame) -> list[tuple[str, int]]:
    """Distinct headers with their number of files."""
    rows = found.groupBy("header").count().orderBy("header").limit(MOST_VERSIONS + 1).collect()
    if len(rows) > MOST_VERSIONS:
        raise ValueError(f"more than {MOST_VERSIONS} different headers; are these files without one?")
    return [(r["header"], r["count"]) for r in rows]


def schema_versions(spark: SparkSession, path: str, schema: StructType, aliases: Aliases | None = None) -> DataFrame:
    """One row for each header among the files of a folder: its fingerprint, files, columns, and
    how it departs from ``schema``: missing columns, unknown ones, and those under an older name."""
    aliases = aliases or {}
    older = {old: new for new, names in aliases.items() for old in names}
    rows = []
    for header, count in _headers(csv_headers(spark, path)):
        names = _names(header)
        known = {older.get(n, n) for n in names}
        rows.append(
            (
                hashlib.md5(",".join(names).encode()).hexdigest(),
                count,
                names,
                [n for n in schema.names if n not in known],
                [n for n in names if n not in older and n not in schema.names],
                [n for n in names if n in older],
            )
        )
    return spark.createDataFrame(
        rows,
        "fingerprint string, files long, columns array<string>, missing array<string>, unknown array<string>,"
        " renamed array<string>",
    )


def _columns(names: Sequence[str], schema: StructType, aliases: Aliases) -> Column:
    """The declared columns out of a line parsed into ``r`` by position; the first of two columns
    of one name counts."""
    place = {n: i for i, n in reversed(list(enumerate(names)))}

    def column(field: StructField) -> Column:
        found = [
            text_as(F.col(f"r.c{place[n]}"), field) for n in (field.name, *aliases.get(field.name, ())) if n in place
        ]
        return (F.coalesce(*found) if found else F.lit(None).cast(field.dataType)).alias(field.name)

    return F.struct(*[column(f) for f in schema])


def read_csv(
    spark: SparkSession, path: str, schema: StructType, aliases: Aliases | None = None
) -> DataFrame:
    """CSV with a header; malformed dates and numbers become NULL.

    Files whose headers differ are matched by column name: one job takes the headers of all files,
    and one scan parses each line by the header of its file, however many files there are. A line
    that equals its file's header is one (of files that were joined); blank lines are none.
    """
    found = park(csv_headers(spark, path))
    headers = [h for h, _ in _headers(found)]
    if len(headers) < 2:
        return conform(spark.read.option("header", True).csv(path), schema, aliases)
    widest = max(len(_names(h)) for h in headers)
    parsed = F.from_csv("value", ", ".join(f"c{i} string" for i in range(widest)), {"mode": "PERMISSIVE"})
    lines = _lines(spark, path).join(found, "file").where((F.trim("value") != "") & (F.col("value") != F.col("header")))
    lines = lines.select("header", parsed.alias("r"))
    row = F.coalesce(*[F.when(F.col("header") == h, _columns(_names(h), schema, aliases or {})) for h in headers])
    return lines.select(row.alias("row")).select("row.*")


def customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def orders(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ORDERS)


def segment_revenue(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SEGMENT_REVENUE)


def last_run(stored: DataFrame) -> str:
    """The run whose files were written last, from its folders: the column may be read as a
    number or a date."""
    changed = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("at"))
    last = changed.groupBy("file").agg(F.max("at").alias("at"))
    run = F.url_decode(F.regexp_extract("file", "/run_id=([^/]+)/", 1))
    return last.where("file LIKE '%/run_id=%'").agg(F.max_by(run, F.struct("at", run.alias("run")))).first()[0]


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    periods: Sequence[str] | None = None,
    period_column: str = "billing_period",
    run_id: str | None = None,
) -> DataFrame:
    """The rows of a published table, the last version or the last of ``run_id``, or of a plain
    Parquet folder; ``periods`` are read from their directories only.

    Period directories look like dates; they are kept as text whatever the session infers.
    """
    if publish.is_published(spark, path):
        df = publish.read(spark, path, run_id=run_id)
        if schema is not None:
            df = conform(df, schema)
    else:
        if run_id is not None:
            raise ValueError(f"{path} holds no runs")
        df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    for name in ("billing_period", "allocated_period", "cohort_month"):
        if name in df.columns and df.schema[name].dataType.typeName() != "string":
            df = df.withColumn(name, F.date_format(F.col(name), "yyyy-MM"))
    return df if periods is None else df.filter(F.col(period_column).isin(*periods))


def daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    """Daily revenue under its current or its former column name."""
    return conform(spark.read.parquet(path), schemas.DAILY_REVENUE, schemas.REVENUE_ALIASES)


def billing_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.BILLING_EVENTS)


def optional_table(
    spark: SparkSession, path: str | None, schema: StructType | None = None
) -> DataFrame | None:
    """The table, or None where the path does not exist. Any other fault is raised."""
    if path is None:
        return None
    try:
        return read_table(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def account_metadata(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Account attributes as stored; ``first_paid_date`` may be text or a date."""
    return optional_table(spark, path)


def contract_schedule(spark: SparkSession, path: str | None) -> DataFrame | None:
    return optional_table(spark, path, schemas.CONTRACT_SCHEDULE)
