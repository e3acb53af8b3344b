"""Order MinHash fingerprints: signatures sensitive to the order of a text's parts."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import chained, mixed, park

#: Tuples in a fingerprint, k-mers in a tuple, words in a k-mer, bytes of a hashed tuple.
TUPLES, LENGTH, KMER, WIDTH = 64, 2, 2, 4
#: A text's units: words, cut after eight characters where a word is longer than 24.
UNITS = re.compile(r"[^\x20\x09-\x0D]+")


def units(text: str) -> list[str]:
    out = []
    for word in text.split() if text.isascii() and not re.search("[\x1c-\x1f]", text) else UNITS.findall(text):
        out += [word] if len(word) <= 24 else [word[i : i + 8] for i in range(0, len(word), 8)]
    return out


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value occurred before its place."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    start = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - start
    return out


class Fingerprints:
    """Order MinHash: for each of ``tuples`` hash functions the ``length`` occurrence-numbered
    k-mers with the smallest hashes are taken, put back in text order, and the tuple is hashed.
    """

    def __init__(self, tuples: int = TUPLES, length: int = LENGTH, kmer: int = KMER) -> None:
        self.tuples, self.length, self.kmer = tuples, length, kmer
        self.salts = mixed(np.arange(tuples, dtype=np.uint64), 77) | np.uint64(1)
        self.known: dict[str, int] = {}

    def _hashes(self, text: str) -> np.ndarray:
        parts, known = units(text), self.known
        if len(known) > 500_000:
            known.clear()
        for part in set(parts).difference(known):
            known[part] = xxhash.xxh3_64_intdigest(part)
        one = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        joined = one
        for k in range(1, min(self.kmer, len(one))):
            joined = chained(joined[:-1], one[k:])
        return joined

    def of(self, text: str) -> np.ndarray:
        """``tuples`` hashes of ``WIDTH`` bytes; a text without words: hashes of itself."""
        grams = self._hashes(text)
        if not len(grams):
            whole = np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
            return (mixed(self.salts ^ whole) >> np.uint64(32)).astype(np.uint32)
        numbered = mixed(grams ^ mixed(occurrences(grams).view(np.uint64), 5))
        n, take = len(numbered), min(self.length, len(numbered))
        out = np.empty(self.tuples, np.uint64)
        step = max(1, 400_000 // n)
        with np.errstate(over="ignore"):
            for at in range(0, self.tuples, step):
                salts = self.salts[at : at + step, None]
                drawn = numbered[None, :] * salts
                drawn ^= drawn >> np.uint64(31)
                rows = np.arange(len(drawn))
                places = np.empty((len(drawn), take), np.int64)
                for k in range(take):
                    places[:, k] = drawn.argmin(axis=1)
                    drawn[rows, places[:, k]] = np.iinfo(np.uint64).max
                places.sort(axis=1)
                tuple_hash = mixed(numbered[places[:, 0]], 9)
                for k in range(1, take):
                    tuple_hash = chained(tuple_hash, numbered[places[:, k]])
                out[at : at + step] = tuple_hash
        return (out >> np.uint64(32)).astype(np.uint32)


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of equal tuples."""
    return float((one == other).mean())


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as many first characters of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, without any shuffle.

    Null counts as empty; texts without words get a fingerprint of the text itself; texts of
    any length are taken whole; equal texts have equal fingerprints; an empty table gives no
    rows; other columns are not read.
    """

    def run(batches):
        maker = Fingerprints()
        for batch in batches:
            made = [written(maker.of(text or "")) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=[id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(maker: Fingerprints, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    new = edited(text, following)
    changed = maker.of(new) if new != text else own
    return (
        len(text),
        hashlib.sha256(new.encode()).hexdigest(),
        written(own),
        written(changed),
        likeness(own, changed),
        likeness(own, other),
    )


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Every text compared with its edited form and with the next text in id order (after the
    last: the first): (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next).

    Texts are range-sorted by id once; a task compares neighbours as they pass. What crosses
    ranges, the first and last text of each, is compared afterwards; that is two texts for each
    range. Rows of one id stand in the order of their texts' hashes; null ids come first; a
    single row is its own next.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        maker, last = Fingerprints(), None
        for batch in batches:
            out = []
            for doc, text, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = maker.of(text)
                if last is None:
                    out.append((doc, *[None] * 6, part, "first", text))
                else:
                    out.append((last[0], *_compared(maker, last[1], last[2], text, own), part, None, None))
                last = (doc, text, own, part)
            yield rows(out)
        if last is not None:
            yield rows([(last[0], *[None] * 6, last[3], "last", last[1])])

    def rows(out):
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=arrow)

    def pairs(batches):
        maker = Fingerprints()
        for batch in batches:
            out = []
            for doc, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append((doc, *_compared(maker, text, maker.of(text), following, maker.of(following))))
            yield pa.RecordBatch.from_pylist([dict(zip(names[:7], r, strict=True)) for r in out], schema=arrow_result)

    names = [id_col, *[f.split()[0] for f in RESULT.split(", ")], "__range", "__edge", "__text"]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    full = f"`{id_col}` {kind}, {RESULT}, __range int, __edge string, __text string"
    arrow = to_arrow_schema(StructType.fromDDL(full))
    arrow_result = to_arrow_schema(StructType.fromDDL(f"`{id_col}` {kind}, {RESULT}"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    ranged = (
        docs.select(F.col(id_col), text.alias("__text"))
        .repartitionByRange(partitions, id_col)
        .sortWithinPartitions(id_col, F.xxhash64("__text"))
        .withColumn("__range", F.spark_partition_id())
    )
    found = park(ranged.mapInArrow(run, full))
    firsts = found.where("__edge = 'first'")
    # One number for each range that has rows; their order names each range's successor.
    ranges = sorted(r[0] for r in firsts.select("__range").collect())
    after = dict(zip(ranges, ranges[1:] + ranges[:1], strict=True))
    following = spark.createDataFrame(list(after.items()), "__range int, __next int") if after else None
    inner = found.where("__edge IS NULL").select(*names[:7])
    if following is None:
        return inner
    open_ends = (
        found.where("__edge = 'last'")
        .select(id_col, "__text", "__range")
        .join(F.broadcast(following), "__range")  # one row for each range
        .join(firsts.select(F.col("__range").alias("__next"), F.col("__text").alias("__following")), "__next")
        .select(id_col, "__text", "__following")
    )
    return inner.unionByName(open_ends.mapInArrow(pairs, f"`{id_col}` {kind}, {RESULT}"))
