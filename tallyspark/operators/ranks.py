"""Places inside large groups without one task for each group.

Rows are range-sorted by group and order, so a group that holds a third of all rows fills many
slices. Inside a slice rows are numbered by a window; what a slice's numbers start from is a sum
over one row for each slice and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import park


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with the place of each row in its group, from 1 (BIGINT)."""
    ranged = df.repartitionByRange(*[F.col(g).asc_nulls_first() for g in group], *order)
    sliced = park(ranged.withColumn("__slice", F.spark_partition_id()))
    earlier = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("__slice", *group)
        .agg(F.count("*").alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    )  # one row for each slice and group in it
    inside = Window.partitionBy("__slice", *group).orderBy(*order)
    local = sliced.withColumn("__at", F.row_number().over(inside))
    same = F.col("l.__slice") == F.col("s.__slice")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"s.{g}"))
    joined = local.alias("l").join(starts.alias("s"), same)
    return joined.select(
        *[F.col(f"l.`{c}`") for c in df.columns], (F.col("s.__start") + F.col("l.__at")).alias(name)
    )


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Numbers 1, 2, ... inside each group, as ``row_number`` gives them. ``order`` should leave
    no ties: tied rows get numbers in no fixed order."""
    return _numbered(df, group, order, name)


def dense_ranks(df: DataFrame, group: Sequence[str], value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Dense rank (INT) of ``value`` inside each group, NULL after all values when descending and
    before them when ascending, as a window would give it. ``df`` is parked, being read twice."""
    rows = park(df)
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    distinct = rows.groupBy(*group, value).agg(F.lit(1).alias("__one")).drop("__one")
    numbered = _numbered(distinct, group, [order], "__rank")
    same = F.lit(True)
    for c in (*group, value):
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"n.`{c}`"))
    joined = rows.alias("r").join(numbered.alias("n"), same)
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], F.col("n.__rank").cast("int").alias(name))
