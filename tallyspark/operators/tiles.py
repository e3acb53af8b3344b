"""Exact NTILE over whole tables without a single-task window.

``ntile(n) OVER (ORDER BY metric)`` moves every row to one task. Only the ``n - 1``
rows that open a tile matter, though. They are found with one range shuffle for all
metrics together; each row is then labelled by comparing itself with those rows,
which needs no shuffle and no join.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import park


def _oriented(metric: str, descending: bool) -> Column:
    value = F.col(metric).cast("double")
    return F.lit(0.0) - value if descending else value


def _tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based positions of the first row of tiles 2..n (SQL sizes: larger tiles first)."""
    size, extra = divmod(rows, tiles)
    starts = (t * size + min(t, extra) for t in range(1, tiles))
    return [s for s in starts if s < rows]


def opening_rows(
    df: DataFrame, key: str, metrics: dict[str, bool], tiles: int
) -> dict[str, list[tuple]]:
    """``metric -> [(value, key), ...]``: the first row of each tile after the first.

    The range shuffle orders by metric, value and key, so a value shared by a third of
    the table is still spread over many partitions. The driver sees one count per
    partition and ``len(metrics) * (tiles - 1)`` rows.
    """
    stacked = df.select(
        F.col(key).alias("k"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), _oriented(m, desc).alias("v"))
                    for m, desc in metrics.items()
                ]
            )
        ),
    )
    sliced = park(
        stacked.repartitionByRange("metric", "v", "k").withColumn("slice", F.spark_partition_id())
    )
    sizes = defaultdict(list)
    for r in sorted(sliced.groupBy("metric", "slice").count().collect()):
        sizes[r["metric"]].append((r["slice"], r["count"]))

    wanted = []  # (metric, slice, 1-based row inside the slice)
    for metric, parts in sizes.items():
        for start in _tile_starts(sum(n for _, n in parts), tiles):
            for part, n in parts:
                if start < n:
                    wanted.append((metric, part, start + 1))
                    break
                start -= n
    if not wanted:
        return {}

    inside = Window.partitionBy("metric", "slice").orderBy(
        F.col("v").asc_nulls_first(), F.col("k").asc_nulls_first()
    )
    hit = reduce(
        lambda a, b: a | b,
        [(F.col("metric") == m) & (F.col("slice") == s) & (F.col("rn") == n) for m, s, n in wanted],
    )
    found = (
        sliced.filter(F.col("slice").isin(sorted({s for _, s, _ in wanted})))
        .withColumn("rn", F.row_number().over(inside))
        .filter(hit)
        .collect()
    )
    out = defaultdict(list)
    for r in found:
        out[r["metric"]].append((r["slice"], r["rn"], r["v"], r["k"]))
    return {m: [(v, k) for _, _, v, k in sorted(rows, key=lambda r: r[:2])] for m, rows in out.items()}


def with_tiles(
    df: DataFrame, key: str, scores: dict[str, tuple[str, bool]], tiles: int = 5
) -> DataFrame:
    """Add one tile number (1..tiles, INT) per entry ``score column -> (metric, descending)``.

    Ties are ordered by ``key``, which must be unique; NULL metrics come first. ``df`` is
    read twice, so hand in a stored or parked table.
    """
    openings = opening_rows(df, key, {m: desc for m, desc in scores.values()}, tiles)
    key_type = df.schema[key].dataType

    def tile(metric: str, descending: bool) -> Column:
        me = F.struct(_oriented(metric, descending).alias("v"), F.col(key).alias("k"))
        reached = [
            (
                me
                >= F.struct(
                    F.lit(v).cast("double").alias("v"), F.lit(k).cast(key_type).alias("k")
                )
            ).cast("int")
            for v, k in openings.get(metric, [])
        ]
        return reduce(lambda a, b: a + b, reached, F.lit(1)).cast("int")

    return df.select("*", *[tile(m, d).alias(name) for name, (m, d) in scores.items()])
