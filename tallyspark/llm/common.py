"""Shared helpers: parked tables, deterministic splits, words of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark import scratch

#: While a table is parked, shuffle files go as soon as its statement has ended, and its
#: columns, mostly ids, hashes and text, are compressed well.
PARKING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def parking(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in PARKING}
    for key, value in PARKING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def park(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder; its shuffle files are freed."""
    with parking(df.sparkSession):
        return scratch.park(df)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``part`` when divided by ``parts``."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(parts)) == part, F.lit(False))


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One text array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts: distinct words, the index of each
    word in reading order, and the number of words of each text."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    counts = before[offsets[1:]] - before[offsets[:-1]]
    encoded = flat.filter(full).dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), counts


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    one = xxhash.xxh3_64_intdigest
    return np.fromiter(map(one, words.to_pylist()), np.uint64, len(words))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chained(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of ordered pairs."""
    with np.errstate(over="ignore"):
        return mixed(first * np.uint64(0xD6E8FEB86659FD93) ^ second)


#: What encoders remember in this worker process; given up when other work begins in it.
CACHES: list = []
_LIBRARY = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next task, or for a
    stage of other work, would keep all that the last one took."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBRARY, "malloc_trim"):
        _LIBRARY.malloc_trim(0)


def portions(
    batches: Iterator[pa.RecordBatch], text: int, most: int = 2 << 20, rows: int = 2000, remember: bool = False
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in portions of at most ``rows`` rows and ``most`` bytes of text, or
    one longer row, so that what a task builds from the words of a portion stays small.

    ``remember`` keeps what encoders remember from the worker's earlier tasks.
    """
    if not remember:
        for cache in CACHES:
            cache.clear()
        release()
    try:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            start = 0
            while start < len(sizes):
                ends = np.cumsum(sizes[start : start + rows], dtype=np.int64)
                n = max(1, int(np.searchsorted(ends, most, side="right")))
                yield batch.slice(start, n)
                start += n
    finally:
        release()
