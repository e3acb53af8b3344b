"""Rows that every operator must take: nulls, empty and long texts, ties, clashing columns."""

from __future__ import annotations

from pathlib import Path

import pytest

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")

LINE = "The quick brown fox jumps over the lazy dog near the river bank. "
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r "),
    (4, "one"),
    (5, LINE * 2000),
    (6, "x" * 60_000),
    (7, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.\n" * 5),
    (7, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.\n" * 5),
    (8, "a b c　d 漢字 😀 \x1c\x1d\x85 end"),
    (None, "a row without an id"),
    (9, LINE * 2000),
    (10, "one"),
]


def odd(spark, extra: bool = True):
    """``ODD`` as documents; the extra columns have names the operators use themselves."""
    if not extra:
        return spark.createDataFrame(ODD, "doc_id long, text string")
    rows = [(i, t, "x", "y", "en", 5, "n", "s", None) for i, t in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, ids string, start string, lang string, n long, source string, q_kept string, score double",
    )


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def documents(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
