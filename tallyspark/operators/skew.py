"""Heavy keys from a mergeable sketch, and what is done for them alone: other keys keep one
place each."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def tracked(share: float) -> int:
    """Items a sketch must track so that a key's estimate is at most half of ``share`` of all rows
    too high, and every key of that share is among its items: the error of a frequent-items
    sketch is 3.5 rows in (items / 0.75)."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    return max(8, math.ceil(0.75 * 7.0 / share))


@dataclass(frozen=True)
class Heavy:
    """``keys``: (key, rows at most) of all keys that may hold ``share`` of the rows, at most
    2 / share of them; ``total`` rows in all."""

    key: str
    keys: list[tuple[object, int]]
    total: int
    share: float


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> Heavy:
    """Keys that may hold at least ``share`` of all rows, from one pass with a bounded sketch for
    each task. A key is never missed; one above half of the share may be listed too. NULL is
    counted exactly."""
    items = tracked(share)
    most = math.ceil(2.0 / share)
    name = f"`{key}`"
    found = df.agg(
        F.expr(f"approx_top_k({name}, {most}, {max(most, items)})").alias("top"),
        F.count_if(F.col(name).isNull()).alias("nulls"),
        F.count("*").alias("total"),
    ).first()
    counts = [(r["item"], r["count"]) for r in found.top or [] if r["item"] is not None]
    if found.nulls:
        counts.append((None, found.nulls))
    least = share * found.total
    return Heavy(key, [(k, n) for k, n in counts if n >= least], found.total, share)


def _table(df: DataFrame, heavy: Heavy, rows: Sequence[tuple]) -> DataFrame:
    """(key, first, width) as a table to broadcast: 2 / share rows at most."""
    schema = StructType(
        [
            StructField("__key", df.schema[heavy.key].dataType),
            StructField("__first", IntegerType()),
            StructField("__width", IntegerType()),
        ]
    )
    return F.broadcast(df.sparkSession.createDataFrame([Row(*r) for r in rows], schema))


def heavy_hitters(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """(key, row_count, share) of exactly the keys that hold at least ``share`` of all rows: only
    the sketch's candidates are counted."""
    heavy = heavy_keys(df, key, share)
    candidates = _table(df, heavy, [(k, 0, 0) for k, _ in heavy.keys])
    counted = (
        df.select(F.col(f"`{key}`").alias(key))
        .join(candidates, F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left_semi")
        .groupBy(f"`{key}`")
        .agg(F.count("*").alias("row_count"))
    )
    part = F.col("row_count") / F.lit(max(heavy.total, 1))
    return counted.where(F.col("row_count") >= F.lit(heavy.share) * heavy.total).withColumn("share", F.round(part, 6))


def _widths(heavy: Heavy, partitions: int) -> list[tuple[object, int, int]]:
    """Each heavy key's stretch of partitions, one after another around the ring: as many as its
    rows fill at the mean load."""
    out, at = [], 0
    for k, n in sorted(heavy.keys, key=lambda x: (-x[1], str(x[0]))):
        width = min(partitions, max(1, math.ceil(n * partitions / max(heavy.total, 1))))
        out.append((k, at % partitions, width))
        at += width
    return out


def _hash(spread_by: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(17), *[F.col(f"`{c}`") for c in spread_by])


def spread(
    df: DataFrame, key: str, spread_by: Sequence[str], partitions: int | None = None, heavy: Heavy | None = None
) -> DataFrame:
    """Repartition by ``key`` so that no partition is far above the mean: a key with more rows than
    a partition should hold fills a stretch of them, by a hash of ``spread_by`` (columns that tell
    its rows apart); all other keys stay whole, by hash.

    With the default ``heavy`` keys above half a partition's load are found by one pass over the
    key column.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy or heavy_keys(df, key, 0.5 / partitions)
    ring = _table(df, heavy, _widths(heavy, partitions))
    joined = df.join(ring, F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left")
    cold = F.pmod(F.xxhash64(f"`{key}`"), F.lit(partitions))
    hot = F.pmod(F.col("__first") + F.pmod(_hash(spread_by), F.col("__width")), F.lit(partitions))
    target = F.when(F.col("__width").isNull(), cold).otherwise(hot).cast("int")
    dealt = joined.withColumn("__to", target).select(*[f"`{c}`" for c in df.columns], "__to")
    return dealt.repartitionById(partitions, F.col("__to")).drop("__to")


def skew_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    partitions: int | None = None,
    heavy: Heavy | None = None,
) -> DataFrame:
    """``facts`` joined with ``dimension`` by ``key``; the facts of a heavy key are dealt to several
    salts, and only that key's dimension rows are repeated for each of them.

    ``inner`` or ``left``: a repeated dimension row without facts would show in the others. Facts
    without a key match nothing and are dealt to all salts in a left join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    partitions = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy or heavy_keys(facts, key, 0.5 / partitions)
    rows = [r for r in _widths(heavy, partitions) if r[0] is not None]
    table = _table(facts, heavy, rows)
    salt = F.pmod(_hash(spread_by), F.coalesce("__width", F.lit(1)))
    salt = F.when(F.col(f"`{key}`").isNull(), F.pmod(_hash(spread_by), F.lit(partitions))).otherwise(salt)
    left = facts.join(table, F.col(f"`{key}`") == F.col("__key"), "left").withColumn("__salt", salt.cast("int"))
    right = dimension.join(table, F.col(f"`{key}`") == F.col("__key"), "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__width", F.lit(1)) - 1))
    )
    kept = [c for c in dimension.columns if c != key]
    joined = left.drop("__key", "__first", "__width").join(
        right.select(f"`{key}`", "__salt", *[f"`{c}`" for c in kept]), [key, "__salt"], how
    )
    return joined.select(*[f"`{c}`" for c in facts.columns], *[f"`{c}`" for c in kept])
