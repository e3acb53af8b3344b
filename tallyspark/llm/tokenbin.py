"""Token ids in a compact file format: canonical length-limited Huffman codes.

A file set is a table of blocks. Each block holds the ids of whole consecutive documents:
their ids (``docs``) and token counts (``counts``), the Huffman bits (``bits``) and the bit
offset of every ``STRIDE``-th token (``marks``). Blocks are independent; the code is given by
one byte per vocabulary id, its code length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import park, plain, portions
from .pieces import library_encoder

STRIDE, BLOCK, LIMIT = 256, 1 << 19, 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge. Ids that do not
    occur have none (0)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("the limit is too short for the number of ids")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    # levels[k]: whether each entry of the merged list is a leaf; a package takes two entries.
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        weight = np.concatenate((leaves, packages))
        rank = np.argsort(weight, kind="stable")
        levels.append(rank < len(leaves))
        weight = weight[rank]
        packages = weight[: len(weight) // 2 * 2].reshape(-1, 2).sum(1)
    take, depth = 2 * (len(used) - 1), np.zeros(len(used) + 1, np.int64)
    for is_leaf in reversed(levels):
        n_leaves = int(is_leaf[:take].sum())
        depth[0] += 1
        depth[n_leaves] -= 1
        take = 2 * (take - n_leaves)
    lengths[order] = np.cumsum(depth)[: len(used)]
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then id."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    steps = np.left_shift(np.uint64(1), np.uint64(64) - lengths[order].astype(np.uint64))
    with np.errstate(over="ignore"):  # a complete code ends at 2^64
        left = np.concatenate((np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)[:-1]))
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = left[: len(order)]
    return codes  # aligned to the top of 64 bits


def compress(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` and the bit offset of every ``STRIDE``-th of them."""
    if not len(ids):
        return b"", np.zeros(0, "<u8")
    size = lengths[ids].astype(np.int64)
    if not size.all():
        raise ValueError("an id has no code")
    ends = np.cumsum(size)
    starts = ends - size
    words = np.zeros(int(ends[-1] + 63) // 64 + 1, np.uint64)
    at, shift = starts >> 6, (starts & 63).astype(np.uint64)
    code = codes[ids]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    words[at[first]] = np.bitwise_or.reduceat(code >> shift, first)
    # At most one code begins in a word and ends in the next.
    over = np.flatnonzero((starts & 63) + size > 64)
    words[at[over] + 1] |= code[over] << (np.uint64(64) - shift[over])
    return words.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], starts[::STRIDE].astype("<u8")


def decoding_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every string of ``limit`` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    spans = np.left_shift(1, limit - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << limit, np.uint32), np.zeros(1 << limit, np.uint8)
    n = int(spans.sum())
    ids[:n], sizes[:n] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, sizes


def decompress(
    bits: bytes, marks: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], limit: int = LIMIT
) -> np.ndarray:
    """The ``n`` ids of a block: all stretches between marks are decoded side by side."""
    ids, sizes = table
    data = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
    # The 32 bits from each byte on.
    wide = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = marks.astype(np.int64)
    out = np.zeros((STRIDE, len(at)), np.uint32)
    live = len(at)
    tail = n - (live - 1) * STRIDE if live else 0
    mask = np.uint32((1 << limit) - 1)
    for step in range(min(STRIDE, n)):
        if step == tail:  # the last stretch may be shorter
            live -= 1
            at = at[:live]
        window = (wide[at >> 3] >> (32 - limit - (at & 7)).astype(np.uint32)) & mask
        out[step, :live] = ids[window]
        at = at + sizes[window]
    return out.T.reshape(-1)[:n]


def token_ids(
    docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None
) -> DataFrame:
    """(id, ids, range, start) of whole texts with an end id, range-sorted by id and parked;
    ``start``: ids of the range before the document."""

    def run(batches):
        encoder = library_encoder(path)
        end = pa.scalar(int(end_id).to_bytes(encoder.width, "little"))
        before = 0
        for batch in portions(batches, 1, remember=True):
            ids = pc.binary_join_element_wise(encoder.encode_array(plain(batch.column(1))), end, b"")
            n = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // encoder.width
            start = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, batch.column(2), pa.array(start)],
                names=["id", "ids", "range", "start"],
            )

    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(partitions, "id")
        .sortWithinPartitions("id", F.xxhash64("text"))
        .withColumn("range", F.spark_partition_id())
    )
    return park(ranged.mapInArrow(run, "id long, ids binary, range int, start long"))


def id_counts(tokens: DataFrame, width: int, vocabulary: int) -> np.ndarray:
    """Occurrences of each id over all rows; the driver gets one row per id at most."""

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{width}")
            total += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["id", "n"])

    partial = tokens.select("ids").mapInArrow(run, "id int, n long")
    out = np.zeros(vocabulary, np.int64)
    for r in partial.groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r[0]] = r[1]
    return out


SCHEMA = "range int, start long, docs array<long>, counts array<long>, n long, marks binary, bits binary, code binary"


def blocks_of(tokens: DataFrame, width: int, lengths: np.ndarray) -> DataFrame:
    """The block table of range-sorted ``tokens``."""
    code = tokens.sparkSession.sparkContext.broadcast((lengths, canonical(lengths)))

    def run(batches) -> Iterator[pa.RecordBatch]:
        sizes, codes = code.value
        held: list[tuple[int, np.ndarray]] = []
        part, start, size = 0, 0, 0

        def block() -> pa.RecordBatch:
            docs, ids = zip(*held)
            stream = np.concatenate(ids)
            bits, marks = compress(stream, codes, sizes)
            values = [part, start, list(docs), [len(x) for x in ids], len(stream), marks.tobytes(), bits, sizes.astype(np.uint8).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names
            )

        for batch in batches:
            for doc, data, its_range, its_start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (its_range != part or size >= BLOCK):
                    yield block()
                    held, size = [], 0
                if not held:
                    part, start = its_range, its_start
                held.append((doc, np.frombuffer(data, f"<u{width}")))
                size += len(held[-1][1])
        if held:
            yield block()

    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int64(), longs, longs, pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["range", "start", "docs", "counts", "n", "marks", "bits", "code"]
    return tokens.select("id", "ids", "range", "start").mapInArrow(run, SCHEMA)


def write(
    docs: DataFrame, path: str, target: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, np.ndarray]:
    """Encode ``docs`` and write the files in ascending id order: the block table, in
    ``target`` or the shared checkpoint folder.

    Returns the table as written and the code lengths of all ids, which each block holds too
    (one byte an id; equal values share one dictionary entry of a file). Ids must be integers. A null
    or empty text is its end id alone; a null id sorts first; repeated rows are written one by
    one; an empty table gives no blocks; other columns are not read. A document is never split
    over blocks; a block holds about ``BLOCK`` tokens, or one longer document.
    """
    tokenizer = library_encoder(path)
    tokens = token_ids(docs, path, end_id, id_col, text_col)
    vocabulary = max(tokenizer.vocabulary, end_id + 1)
    lengths = code_lengths(id_counts(tokens, tokenizer.width, vocabulary))
    blocks = blocks_of(tokens, tokenizer.width, lengths)
    if target is None:
        return park(blocks), lengths
    blocks.write.parquet(target)
    return docs.sparkSession.read.parquet(target), lengths


def read(blocks: DataFrame, lengths: np.ndarray | None = None, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document from the written files, with the
    ids themselves as little-endian unsigned 32-bit integers on demand.

    Code lengths come from the files unless they are given.

    The driver holds one total per range, a number set by the partitioning.
    """
    spark = blocks.sparkSession
    totals = dict(map(tuple, blocks.groupBy("range").agg(F.sum("n")).collect()))
    offsets, before = {}, 0
    for part in sorted(totals):
        offsets[part] = before
        before += totals[part]
    known = spark.sparkContext.broadcast((lengths, offsets))

    def run(batches) -> Iterator[pa.RecordBatch]:
        sizes, offset = known.value
        last, table = None, None if sizes is None else decoding_table(sizes)
        for batch in batches:
            for part, start, docs, counts, n, marks, bits, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sizes is None and code != last:
                    last, table = code, decoding_table(np.frombuffer(code, np.uint8).astype(np.int64))
                ids = decompress(bits, np.frombuffer(marks, "<u8"), n, table).astype("<u4")
                ends = np.cumsum(counts)
                each = [ids[end - size : end] for end, size in zip(ends, counts, strict=True)]
                columns = [
                    pa.array(docs, pa.int64()),
                    pa.array(offset[part] + start + ends - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(x) for x in each], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.tobytes() for x in each], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    columns = ["range", "start", "docs", "counts", "n", "marks", "bits"]
    columns.append("code" if lengths is None else F.lit(None).cast("binary").alias("code"))
    return blocks.select(*columns).mapInArrow(run, schema)
