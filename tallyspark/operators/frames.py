"""Trailing frames over a daily series.

A series has one row per (segment, day); ``segment.daily_series`` establishes that with a
partially aggregated shuffle. A window partition therefore holds at most the days of the
calendar, however many raw rows a segment has.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F
from pyspark.sql.window import WindowSpec

FRAMES = ("rows", "calendar")


def by_day(segment: str, day: str) -> WindowSpec:
    return Window.partitionBy(segment).orderBy(F.unix_date(day))


def trailing(segment: str, day: str, length: int, frame: str = "rows") -> WindowSpec:
    """The current day and the ``length - 1`` before it.

    ``rows`` counts the days present (the default meaning of "7d" here); ``calendar``
    counts dates, so missing days shorten the frame.
    """
    if frame not in FRAMES:
        raise ValueError(f"frame must be one of {FRAMES}, got {frame!r}")
    series = by_day(segment, day)
    return (series.rowsBetween if frame == "rows" else series.rangeBetween)(1 - length, 0)
