"""Tables in versions: written aside, compared with what was meant, then committed at once.

A table's folder holds ``data/write=<id>`` for each write, ``nodes/write=<id>`` with the counts
and checksums of its files, and ``log/<number>.json`` for each version: the writes (or the
partitions of a write) that make it up. A version exists from the moment its log file is there;
a write that fails leaves the former version as it was. The number is the compare-and-set: of
two writers that started from one version the second finds its number taken.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import quality
from . import files

REPLACE = ("all", "partitions", "nothing")


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Version:
    """``writes``: each write with its partition folders that belong to the version."""

    number: int
    run_id: str | None
    committed_at: float
    schema: dict
    partition_by: list[str]
    writes: dict[str, list[str]]
    row_count: int
    checksum: str
    metrics: dict[str, float] = field(default_factory=dict)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(self.schema)


def _name(number: int) -> str:
    return f"{number:020d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.modified(spark, f"{path}/log")
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{20}\.json", n))


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(numbers(spark, path))


def version(spark: SparkSession, path: str, number: int) -> Version:
    return Version(**json.loads(files.read_text(spark, f"{path}/log/{_name(number)}")))


def latest(spark: SparkSession, path: str, run_id: str | None = None) -> Version | None:
    """The last version by commit, of a run where one is named; None where there is none."""
    for number in reversed(numbers(spark, path)):
        found = version(spark, path, number)
        if run_id is None or found.run_id == run_id:
            return found
    return None


def _load(spark: SparkSession, path: str, schema: StructType, writes: Mapping[str, Sequence[str]]) -> DataFrame:
    if not any(writes.values()):
        return spark.createDataFrame([], schema)
    base = f"{path}/data"
    paths = [f"{base}/write={w}" + (f"/{p}" if p else "") for w, parts in writes.items() for p in parts]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*[f"`{n}`" for n in schema.names])


def read(spark: SparkSession, path: str, number: int | None = None, run_id: str | None = None) -> DataFrame:
    """The rows of a version: the last, the last of a run, or one by number."""
    found = version(spark, path, number) if number is not None else latest(spark, path, run_id)
    if found is None:
        raise FileNotFoundError(f"no version of {path}" + (f" by run {run_id}" if run_id else ""))
    return _load(spark, path, found.struct, found.writes)


def _file_nodes(stored: DataFrame, write: str) -> DataFrame:
    """Rows and checksum of each file of a write, with the partition folder it lies in."""
    # The names are worked out of one row a file, not of each of its rows.
    counted = quality.manifest(stored.withColumn("__path", F.col("_metadata.file_path")), stored.columns, ["__path"])
    inside = F.regexp_extract("__path", f"/write={write}/(.*)$", 1)
    inside = F.url_decode(F.replace(inside, F.lit("+"), F.lit("%2B")))  # an address as a file name
    named = counted.select(inside.alias("file"), "row_count", "checksum")
    return named.withColumn("partition", F.regexp_replace("file", "/?[^/]*$", ""))


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[str, list[str], dict]:
    """Write ``df`` aside; (write, its partition folders, its table node).

    The table node is taken by ``observe`` from the rows on their way to the files, the nodes of
    the files from the files; where their sums differ, the write fails before anything is
    published, naming both.
    """
    spark, write = df.sparkSession, uuid.uuid4().hex
    watched, seen = quality.observed(df, f"write-{write}", quality.fingerprint(df.columns))
    writer = watched.write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/data/write={write}")
    got = seen.get  # an empty result may leave nothing to observe
    meant = {"row_count": got.get("row_count") or 0, "checksum": got.get("checksum")}
    if not meant["row_count"]:
        return write, [], meant
    stored = _load(spark, path, df.schema, {write: [""]})
    _file_nodes(stored, write).write.parquet(f"{path}/nodes/write={write}")
    nodes = spark.read.parquet(f"{path}/nodes/write={write}")
    there = nodes.agg(F.sum("row_count").alias("row_count"), F.sum("checksum").alias("checksum")).first().asDict()
    quality.check({"meant": meant, "stored": there}, {"stored_as_meant": there == meant})
    parts = [r[0] for r in nodes.select("partition").distinct().orderBy("partition").collect()]
    return write, parts, meant


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace: str = "all",
    run_id: str | None = None,
    metrics: Mapping[str, float] | None = None,
    tries: int = 20,
) -> Version:
    """Write ``df`` as the next version of the table at ``path``.

    ``replace``: ``all`` rows of the former version, the ``partitions`` that ``df`` fills, or
    ``nothing`` (the rows are added). A change of columns needs ``all``. When another writer
    commits meanwhile, rows are added to its version, while a replacement raises ``Conflict``.
    """
    if replace not in REPLACE:
        raise ValueError(f"replace must be one of {REPLACE}")
    spark = df.sparkSession
    base = latest(spark, path)
    if replace != "all" and base is not None and base.struct.names != df.schema.names:
        raise ValueError(f"columns {df.schema.names} differ from those of {path}: {base.struct.names}")
    write, parts, node = stage(df, path, partition_by)
    for attempt in range(tries):
        kept = {} if base is None or replace == "all" else dict(base.writes)
        if replace == "partitions":
            gone = set(parts)
            kept = {w: left for w, ps in kept.items() if (left := [p for p in ps if p not in gone])}
        if parts:
            kept[write] = parts
        number = base.number + 1 if base is not None else 1
        made = Version(
            number, run_id, time.time(), df.schema.jsonValue(), list(partition_by), kept,
            int(node["row_count"]), str(node["checksum"]), dict(metrics or {}),
        )
        try:
            files.create(spark, f"{path}/log/{_name(number)}", json.dumps(asdict(made)))
            return made
        except FileExistsError:
            if replace != "nothing" or attempt == tries - 1:
                raise Conflict(f"version {number} of {path} was committed by another writer") from None
            base = latest(spark, path)
    raise Conflict(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row for each version: number, run_id, committed_at, rows of its write, writes held."""
    rows = [
        (v.number, v.run_id, v.committed_at, v.row_count, v.checksum, len(v.writes))
        for v in (version(spark, path, n) for n in numbers(spark, path))
    ]
    return spark.createDataFrame(
        rows, "number long, run_id string, committed_at double, row_count long, checksum string, writes int"
    )


LEVELS = ("table", "partition", "file")


def damage(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(level, name, status, rows and checksums expected and found) where the files of a version
    differ from their nodes: ``missing``, ``unlisted`` or ``changed``.

    Levels go down from the table over partitions to files, so the first row says whether
    anything is wrong, and the last which files.
    """
    found = version(spark, path, number) if number is not None else latest(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    sides = {"expected": [], "actual": []}
    for write, parts in found.writes.items():
        listed = spark.read.parquet(f"{path}/nodes/write={write}").where(F.col("partition").isin(*parts))
        folders = [f"{path}/data/write={write}" + (f"/{p}" if p else "") for p in parts]
        there = [f for f in folders if files.exists(spark, f)]
        stored = _load(spark, path, found.struct, {write: [p for p, f in zip(parts, folders, strict=True) if f in there]})
        actual = _file_nodes(stored, write) if there else listed.where("false")
        for side, nodes in (("expected", listed), ("actual", actual.select(*listed.columns))):
            sides[side].append(nodes.withColumn("file", F.concat(F.lit(f"write={write}/"), "file")))
    folded = {}
    for side, parts in sides.items():
        if not parts:
            return spark.createDataFrame([], _DAMAGE)
        nodes = parts[0]
        for more in parts[1:]:
            nodes = nodes.unionByName(more)
        named = [
            F.struct(F.lit(level).alias("level"), name.alias("name"))
            for level, name in zip(LEVELS, (F.lit(""), F.col("partition"), F.col("file")), strict=True)
        ]
        folded[side] = (
            nodes.select("row_count", "checksum", F.inline(F.array(*named)))
            .groupBy("level", "name")
            .agg(F.sum("row_count").alias("row_count"), F.sum("checksum").alias("checksum"))
        )
    wrong = quality.check_manifest(folded["expected"], folded["actual"], ("level", "name"))
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level"))
    return wrong.select(*[f.name for f in StructType.fromDDL(_DAMAGE)]).orderBy(rank, "name")


_DAMAGE = (
    "level string, name string, status string, expected_rows bigint, actual_rows bigint,"
    " expected_checksum decimal(38,0), actual_checksum decimal(38,0)"
)


def drop_versions(spark: SparkSession, path: str, keep: int = 1, abandoned_after: float = 86_400.0) -> list[str]:
    """Delete the data of all versions but the last ``keep``, and writes that were never committed
    and are older than ``abandoned_after`` seconds; returns the writes deleted.

    Log files go first, so that no version is listed whose rows are gone.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    known = [version(spark, path, n) for n in numbers(spark, path)]
    if not known:
        return []
    staying = {w for v in known[-keep:] for w in v.writes}
    committed = {w for v in known for w in v.writes}
    for old in known[:-keep]:
        files.delete(spark, f"{path}/log/{_name(old.number)}")
    gone = []
    for name, changed in files.modified(spark, f"{path}/data").items():
        write = name.removeprefix("write=")
        if write not in staying and (write in committed or time.time() - changed > abandoned_after):
            files.delete(spark, f"{path}/data/{name}")
            files.delete(spark, f"{path}/nodes/{name}")
            gone.append(write)
    return gone
