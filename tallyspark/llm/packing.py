"""Best-fit packing of token sequences, bulk-synchronous."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import park, plain, portions
from .pieces import library_encoder


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole ones at the end, a shorter first."""
    head = n % capacity
    out = [(0, head)] if head else []
    return out + [(start, capacity) for start in range(head, n, capacity)]


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's tokens and end id, cut only
    where longer than ``capacity``."""

    def run(batches):
        encoder = library_encoder(path)
        end = int(end_id).to_bytes(encoder.width, "little")
        kind = np.dtype(f"<u{encoder.width}")
        for batch in portions(batches, 1, remember=True):
            rows, out = [], []
            for row, ids in enumerate(encoder.encode_array(plain(batch.column(1))).to_pylist()):
                tokens = np.frombuffer(ids + end, kind).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(tokens), capacity)):
                    rows.append(row)
                    out.append((piece, start, length, zlib.crc32(tokens[start : start + length])))
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *columns],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    )


def match(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, documents, first sequence, offset) that place all documents.

    Documents of one length are interchangeable, and so are sequences with one gap, so both
    sorted lists are held as runs: documents (length, ranks), sequences (gap, ids). Each round
    opens the sequences that must be opened, then every waiting document proposes to its
    successor, the smallest gap that takes it. Of the documents that propose to one gap the
    longest, then those of lowest rank, get its sequences; the gaps are updated and the others
    propose again. Work and state depend on ``capacity``, not on the number of documents.
    """
    next_rank = dict.fromkeys(counts, 0)
    waiting = {length: n for length, n in counts.items() if n}
    gaps: dict[int, list[list[int]]] = defaultdict(list)  # gap -> runs [first sequence, how many]
    placed: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, first: int, n: int, gap: int) -> None:
        placed.append((length, next_rank[length], n, first, capacity - gap))
        next_rank[length] += n
        waiting[length] -= n
        if not waiting[length]:
            del waiting[length]
        if gap > length:
            gaps[gap - length].append([first, n])

    while waiting:
        sizes = sorted((g for g, runs in gaps.items() if runs), reverse=True)
        widest = sizes[0] if sizes else 0
        # Two documents above half the capacity never share a sequence. Below that, a
        # sequence is opened only for documents that no gap takes, longest first, and for no
        # more of them at once than their tokens fill.
        alone = sorted((x for x in waiting if x > widest and 2 * x > capacity), reverse=True)
        for length in alone:
            n = waiting[length]
            place(length, opened, n, capacity)
            opened += n
        if not alone and max(waiting) > widest:
            length = max(waiting)
            rest = sum(x * n for x, n in waiting.items())
            n = min(waiting[length], max(1, rest // capacity))
            place(length, opened, n, capacity)
            opened += n
        sizes = sorted(g for g, runs in gaps.items() if runs)
        proposals: dict[int, list[int]] = defaultdict(list)
        for length in sorted(waiting, reverse=True):
            at = np.searchsorted(sizes, length)
            if at < len(sizes):
                proposals[sizes[at]].append(length)
        for gap, lengths in proposals.items():
            runs, gaps[gap] = gaps[gap], []
            for length in lengths:
                while runs and length in waiting:
                    first, n = runs[-1]
                    take = min(n, waiting[length])
                    if take == n:
                        runs.pop()
                    else:
                        runs[-1] = [first + take, n - take]
                    place(length, first, take, gap)
            gaps[gap] += runs
    return placed


def _ranked(found: DataFrame, id_col: str, partitions: int) -> DataFrame:
    """``found`` range-sorted by (length, id, piece) with the place of each row among those of
    its length in its range (``__range``, ``__place``), parked, so that both stay as they are."""

    def run(batches):
        seen: Counter[int] = Counter()
        for batch in batches:
            place = []
            for length in batch.column("length").to_pylist():
                place.append(seen[length])
                seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "__place"]
            )

    keys = ["length", id_col, "piece", "ids_crc32"]
    ranged = (
        found.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__range", F.spark_partition_id())
    )
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    return park(ranged.mapInArrow(run, f"{names}, __place long"))


def assign(found: DataFrame, capacity: int, id_col: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """``found`` with sequence_id and offset.

    The driver holds one count per range and length (ranges plus ``capacity`` rows at most)
    and the runs of ``match``; documents stay on the executors. A length that a third of all
    rows share is spread over ranges by id.
    """
    spark = found.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = _ranked(found, id_col, partitions)
    counted = sorted(map(tuple, ranked.groupBy("__range", "length").count().collect()))
    total: Counter[int] = Counter()
    before: dict[tuple[int, int], int] = {}
    for part, length, n in counted:
        before[part, length] = total[length]
        total[length] += n
    runs = sorted(match(dict(total), capacity))
    # Runs of all lengths in one sorted table: key = length and rank in one number.
    shift = max(total.values(), default=0) + 1
    table = spark.sparkContext.broadcast(
        (
            np.array([length * shift + rank for length, rank, *_ in runs], np.int64),
            np.array([first - rank for _, rank, _, first, _ in runs], np.int64),
            np.array([offset for *_, offset in runs], np.int64),
            before,
        )
    )

    def run(batches):
        keys, first, offset, starts = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            ranges = batch.column("__range").to_numpy()
            rank = batch.column("__place").to_numpy() + np.fromiter(
                map(starts.__getitem__, zip(ranges.tolist(), length.tolist())), np.int64, len(length)
            )
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            kept = [c for c in batch.schema.names if not c.startswith("__")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(first[at] + rank), pa.array(offset[at])],
                names=[*kept, "sequence_id", "offset"],
            )

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return ranked.mapInArrow(run, f"{names}, sequence_id long, offset long")


def pack(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A null or empty text is its end id alone; texts of any length are cut into whole
    sequences, the first piece the shorter; repeated rows are packed one by one; an empty
    table gives no rows; other columns are not read.
    """
    # Parked, since the range sort reads its input twice.
    return assign(park(pieces(docs, path, capacity, end_id, id_col, text_col)), capacity, id_col)
