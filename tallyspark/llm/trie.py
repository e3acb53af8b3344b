"""Prefix trie of conversations with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its key is the depth and a 128-bit sum of hashes
of (place, turn), so that keys come from running sums of range-sorted turns, whatever the
length of a conversation. Totals go from children to parents in reverse level order, through a
queue that gives each node its children's messages at the moment the node is read: first within
shards (subtrees of bounded size), then across the roots of the shards.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from .common import park

#: Nodes with more members than this, and than one in ``TOP`` of all rows, lie above the shards,
#: so there are at most ``TOP`` of them (and the root).
LIGHT, TOP = 64, 4096
QUEUE, CHUNK = 1 << 18, 4096
KEY = ["depth", "k1", "k2"]
PARENT = ["p1", "p2"]
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def digested(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, h1, h2, words) of each turn: two hashes of role and text, and its words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def running(df: DataFrame, group: str, order: Sequence[str], sums: dict[str, str], partitions: int | None = None) -> DataFrame:
    """``df`` with, for each ``name: (column)`` of ``sums``, the sum of the column over the rows of
    the same group up to this one (``name``) and before it (``before_name``), modulo 2^64, and
    whether the row is the last of its group (``last``).

    Rows are range-sorted by group and order, so a group of any size is spread over tasks; one
    row for each task tells what its last group sums to, and what the next task starts from.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order]
    names = df.columns
    extra = [f for name in sums for f in (name, f"before_{name}")]
    at, columns = names.index(group), [names.index(c) for c in sums.values()]

    def local(batches):
        context = TaskContext.get()
        part, row, carried, held = context.partitionId(), 0, None, None
        totals = [np.uint64(0)] * len(columns)

        def emit(table: pa.Table, last: np.ndarray):
            nonlocal row, carried, totals
            ids = table.column(at).to_numpy()
            starts = np.concatenate(([True], ids[1:] != ids[:-1]))
            first = np.flatnonzero(starts)
            of = np.cumsum(starts) - 1
            more = []
            for c, place in enumerate(columns):
                values = table.column(place).to_numpy().view(np.uint64)
                with np.errstate(over="ignore"):
                    total = np.cumsum(values, dtype=np.uint64)
                    base = (total - values)[first]
                    if carried is not None and ids[0] == carried:
                        base[0] -= totals[c]
                    up_to = total - base[of]
                    more += [pa.array(up_to.view(np.int64)), pa.array((up_to - values).view(np.int64))]
                    totals[c] = up_to[-1]
            carried = ids[-1]
            rows = np.arange(row, row + len(ids))
            row += len(ids)
            return pa.Table.from_arrays(
                [*table.columns, *more, pa.array(last), pa.array(np.full(len(ids), part, np.int32)), pa.array(rows)],
                names=[*names, *extra, "last", "__part", "__row"],
            ).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            ids = table.column(at).to_numpy()
            held = table.slice(len(ids) - 1)  # whether it is the last shows when the next is read
            if len(ids) > 1:
                yield from emit(table.slice(0, len(ids) - 1), ids[1:] != ids[:-1])
        if held is not None:
            yield from emit(held, np.array([True]))

    added = [StructField(n, LongType()) for n in extra]
    schema = StructType([*df.schema, *added, StructField("last", BooleanType())])
    marks = [StructField("__part", IntegerType()), StructField("__row", LongType())]
    sorted_rows = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    parked = park(sorted_rows.mapInArrow(local, StructType([*schema, *marks])))

    # One row for each task of the range sort.
    borders = (
        parked.groupBy("__part")
        .agg(
            F.min_by(group, "__row").alias("first"),
            F.max_by(F.struct(F.col(group).alias("group"), *sums), "__row").alias("end"),
            F.max("__row").alias("row"),
        )
        .orderBy("__part")
        .collect()
    )
    start: dict[int, tuple[object, list[int]]] = {}
    open_row: dict[int, int] = {}
    for before, here in zip(borders[:-1], borders[1:], strict=True):
        if before.end.group != here.first:
            continue
        open_row[before["__part"]] = before.row
        have = [before.end[name] for name in sums]
        if before["__part"] in start and start[before["__part"]][0] == before.end.group:
            have = [x + y for x, y in zip(have, start[before["__part"]][1], strict=True)]
        start[here["__part"]] = (here.first, [x % (1 << 64) for x in have])
    known = spark.sparkContext.broadcast((start, open_row))
    width, n = len(names), len(extra)

    def joined(batches):
        start, open_row = known.value
        for batch in batches:
            parts, rows = batch.column(width + n + 1).to_numpy(), batch.column(width + n + 2).to_numpy()
            ids = batch.column(at).to_numpy()
            last = batch.column(width + n).to_numpy(zero_copy_only=False).copy()
            more = [batch.column(width + i).to_numpy().view(np.uint64).copy() for i in range(n)]
            for part in np.unique(parts).tolist():
                here = parts == part
                if part in open_row:
                    last[here & (rows == open_row[part])] = False
                if part in start:
                    group, have = start[part]
                    these = here & (ids == group)
                    with np.errstate(over="ignore"):
                        for i, column in enumerate(more):
                            column[these] += np.uint64(have[i // 2])
            columns = [*batch.columns[:width], *[pa.array(c.view(np.int64)) for c in more], pa.array(last)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *extra, "last"])

    return parked.mapInArrow(joined, schema)


def ranked(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, depth, h1, h2, words, last): the turns of each conversation, numbered from 1.

    Turns are ordered by turn, null first; equal turns by a hash of role and text. A null role or
    text is empty; a turn without a conversation id belongs to no conversation and is left out.
    """
    # Parked, since the range sort reads its input twice; the row number spreads equal rows.
    parked = park(digested(turns, conv_col, turn_col, role_col, text_col))
    rows = parked.withColumns({"one": F.lit(1).cast("long"), "row": F.monotonically_increasing_id()})
    placed = running(rows, "conv", ["turn", "h1", "h2", "row"], {"depth": "one"})
    return placed.select("conv", "depth", "h1", "h2", "words", "last")


def shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations c of ``ranked`` rebuilt: the first h turns of conversation c - c % every (all
    if it has fewer, none if it is absent), then c's own turns after its first h, where h is crc32
    of c's decimal text modulo ``most``. The rows as of ``ranked`` without ``last``, and the ids
    of all rebuilt conversations, those without turns included."""
    sizes = turns.where("last").select("conv", F.col("depth").alias("n"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    base = F.col("conv") - F.pmod("conv", F.lit(every))
    bases = sizes.where(F.pmod("conv", F.lit(every)) == 0).select(F.col("conv").alias("base"), F.col("n").alias("has"))
    convs = park(
        sizes.select("conv", h.alias("h"), base.alias("base"))
        .join(bases, "base", "left")
        .withColumn("k", F.least("h", F.coalesce("has", F.lit(0))))
    )
    heads = turns.where((F.pmod("conv", F.lit(every)) == 0) & (F.col("depth") < most)).withColumnRenamed("conv", "base")
    taken = convs.where("k > 0").join(heads, "base").where(F.col("depth") <= F.col("k"))
    moved = convs.where("k < h").select("conv", (F.col("h") - F.col("k")).alias("up"))
    own = turns.where(F.col("depth") > h).join(moved, "conv", "left")
    columns = ["conv", "depth", "h1", "h2", "words"]
    rows = own.withColumn("depth", F.col("depth") - F.coalesce("up", F.lit(0))).select(columns)
    return rows.unionByName(taken.select(columns)), convs.select("conv")


class SpillingQueue:
    """A priority queue of tuples that keeps ``most`` in memory: when it is full, what it holds is
    written as one sorted run to Spark's own scratch folder of this executor, a file without a
    name that goes with the task, and read back in order."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.heads, self.runs = most, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        self.heap.sort()
        for start in range(0, len(self.heap), 1024):
            pickle.dump(self.heap[start : start + 1024], file)
        self.heap = []
        file.seek(0)
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        if item is not None:
            heapq.heappush(self.heads, (item, run))

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)

    def first(self) -> tuple | None:
        ends = [q[0] for q in (self.heap,) if q] + [q[0][0] for q in (self.heads,) if q]
        return min(ends, default=None)

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


#: What a node starts with before its children's messages: children, leaves, saved tokens.
TOTALS = ["n_children", "n_leaves", "saved_tokens"]


def time_forward(nodes: DataFrame, most: int = QUEUE) -> DataFrame:
    """``nodes``, sorted within each partition by shard and reverse level (deepest first, then by
    key), with ``TOTALS`` of their subtrees; a node's totals so far are its own.

    A node without children, sent or known before, is one leaf. Each node sends its totals to its
    parent's place in the order; parents outside the shard get nothing here.
    """
    names = nodes.columns
    place = {c: names.index(c) for c in ["shard", *KEY, *PARENT, "top", *TOTALS]}

    def run(batches):
        queue, shard = SpillingQueue(most), None
        for batch in batches:
            read = {c: batch.column(i).to_pylist() for c, i in place.items()}
            found = {c: [] for c in TOTALS}
            for s, d, k1, k2, p1, p2, top, children, leaves, saved in zip(*read.values(), strict=True):
                if s != shard:
                    if len(queue):
                        raise RuntimeError("a message has no node")
                    shard = s
                key = (-d, k1, k2)
                while (head := queue.first()) is not None and head[:3] == key:
                    _, _, _, more, given = queue.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + given
                leaves = leaves or 1
                for c, value in zip(TOTALS, (children, leaves, saved), strict=True):
                    found[c].append(value)
                if not top:
                    queue.push((1 - d, p1, p2, leaves, saved))
            columns = [
                pa.array(found[c], pa.int64()) if c in found else batch.column(i) for i, c in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if len(queue):
            raise RuntimeError("a message has no node")

    return nodes.mapInArrow(run, nodes.schema)


def ends_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(depth, k1, k2, sha): SHA-256 of the comma-joined ids of each key, ascending.

    Ids are range-sorted over tasks and joined to chunks of text there. The digest itself reads a
    key's chunks in order, one after another in one task with one state: it cannot be split, but
    its task reads chunks, not rows, and holds one batch of them.
    """
    keys = [*KEY, "conv"]

    def chunks(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k = [batch.column(i).to_numpy() for i in range(3)]
            new = np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in k])))
            first = np.flatnonzero(new)
            starts = np.concatenate([np.arange(a, b, chunk) for a, b in zip(first, [*first[1:], len(new)], strict=True)])
            stops = np.append(starts[1:], len(new)).tolist()
            ids = batch.column(3).to_pylist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts.tolist(), stops, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(starts)) for c in batch.columns], pa.array(texts)], names=[*keys, "ids"]
            )

    def hashed(batches):
        key, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for d, k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (d, k1, k2) != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (d, k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*KEY, "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=[*KEY, "sha"])

    partitions = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ends = ends.select(keys).repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    texts = sorted_ends.mapInArrow(chunks, "depth long, k1 long, k2 long, conv long, ids string")
    return texts.repartition(*KEY).sortWithinPartitions(*keys).mapInArrow(hashed, "depth long, k1 long, k2 long, sha string")


def nodes(turns: DataFrame, members: DataFrame, light: int = LIGHT, most: int = QUEUE) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, depth from 1 without gaps, h1, h2, words) and the
    conversations ``members`` (conv), with or without turns:

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves and
    saved_tokens (words of the last turn, once for each member but one) over the subtree, and
    ends_sha256 of the members that end at the node. Without members there is no node.
    """
    lanes = {f"x{i}": F.xxhash64(F.lit(i), "depth", "h1", "h2") for i in (1, 2)}
    placed = park(turns.withColumns(lanes).select("conv", "depth", "words", "x1", "x2"))
    paths = running(placed, "conv", ["depth"], {"k1": "x1", "k2": "x2"})
    paths = park(
        paths.select(
            "conv", F.col("depth").cast("long").alias("depth"), "words", "k1", "k2",
            F.col("before_k1").alias("p1"), F.col("before_k2").alias("p2"), "last",
        )
    )
    grouped = paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if("last").alias("n_ends"),
        F.min(F.when(F.col("last"), F.col("conv"))).alias("end"),
        *[F.min(c).alias(c) for c in ("words", *PARENT)],
    )
    turnless = members.join(paths.where("last"), "conv", "left_anti").select("conv")
    zero = F.lit(0).cast("long")
    either = members.select("conv", F.lit(True).alias("all")).unionByName(turnless.select("conv", F.lit(False).alias("all")))
    ends_here = ~F.col("all")
    root = either.agg(
        F.min(F.when(F.col("all"), F.col("conv"))).alias("conv_id"),
        F.count_if("all").alias("n_convs"),
        F.count_if(ends_here).alias("n_ends"),
        F.min(F.when(ends_here, F.col("conv"))).alias("end"),
    )
    root = root.where("n_convs > 0").withColumns({c: zero for c in (*KEY, *PARENT, "words")})
    found = park(grouped.unionByName(root.select(grouped.columns)))
    top = found.where("depth = 0").select("conv_id", "n_convs").collect()
    if not top:
        return _named(_empty(found))
    total = paths.count()
    limit = max(light, total // TOP)

    # Parents: the root is known; a parent with many children is a skewed key that Spark splits.
    parents = found.where("depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"),
    )
    deep = found.where("depth > 1").join(parents, ["depth", *PARENT])
    one = {"parent_conv_id": F.lit(top[0].conv_id), "parent_n": F.lit(top[0].n_convs).cast("long")}
    none = {c: F.lit(None).cast("long") for c in one}
    all_nodes = found.where("depth = 1").withColumns(one).unionByName(found.where("depth = 0").withColumns(none))
    all_nodes = park(deep.unionByName(all_nodes))

    # Below a node of one member lies a single path: one leaf, nothing shared.
    alone, path = F.col("n_convs") == 1, (F.col("n_convs") == 1) & (F.col("parent_n") == 1)
    own = {
        "n_children": F.when(alone & (F.col("depth") > 0), 1 - F.col("n_ends")).otherwise(0).cast("long"),
        "n_leaves": F.when(alone & (F.col("depth") > 0), 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
    }
    all_nodes = all_nodes.withColumns(own)
    tails = all_nodes.where(F.coalesce(path, F.lit(False)) & (F.col("depth") > 1))
    trunk = all_nodes.where(~(F.coalesce(path, F.lit(False)) & (F.col("depth") > 1)))
    heavy = (F.col("n_convs") > limit) | (F.col("depth") == 0)

    # The shard of a conversation: its first node that is not above the shards. The nodes
    # above are TOP at most, for each holds more than one in TOP of all rows.
    above = F.broadcast(found.where(heavy).select(KEY))
    shards = paths.join(above, KEY, "left_anti").groupBy("conv").agg(
        F.min_by(F.xxhash64(*KEY), "depth").alias("shard")
    )
    below = trunk.where(~heavy).join(shards, F.col("conv_id") == F.col("conv")).drop("conv")
    below = below.withColumn("top", (F.col("parent_n") > limit) | (F.col("depth") == 1))
    order = ["shard", F.desc("depth"), "k1", "k2"]
    below = park(time_forward(below.repartition("shard").sortWithinPartitions(*order), most))

    # What the roots of the shards send, summed for each node above them.
    sent = (
        below.where("top")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    )
    rest = trunk.where(heavy).join(sent, KEY, "left")
    for name, given in zip(TOTALS, ("c", "l", "s"), strict=True):
        rest = rest.withColumn(name, F.col(name) + F.coalesce(given, F.lit(0)))
    rest = rest.drop("c", "l", "s").withColumns({"shard": zero, "top": F.col("depth") == 0})
    rest = time_forward(rest.repartition(1).sortWithinPartitions(*order), most)  # TOP + 1 rows at most

    columns = all_nodes.columns
    done = tails.unionByName(below.select(columns)).unionByName(rest.select(columns))
    ends = paths.where("last").select("conv", *KEY).unionByName(turnless.select("conv", *[zero.alias(c) for c in KEY]))
    many = ends.join(found.where("n_ends > 1").select(KEY), KEY, "left_semi")
    few = done.where("n_ends <= 1").withColumn(
        "sha", F.coalesce(F.sha2(F.col("end").cast("string").cast("binary"), 256), F.lit(NOTHING))
    )
    return _named(few.unionByName(done.where("n_ends > 1").join(ends_digests(many), KEY).select(few.columns)))


def _empty(found: DataFrame) -> DataFrame:
    more = {c: F.lit(0).cast("long") for c in ("parent_conv_id", *TOTALS)}
    return found.where("false").withColumns({**more, "sha": F.lit("")})


def _named(found: DataFrame) -> DataFrame:
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("sha").alias("ends_sha256")
    )


def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes (see ``nodes``) of a table of conversations, ordered as in ``ranked``.

    Repeated rows are turns of their own; an empty table gives no nodes; texts of any length count
    whole; other columns are not read. Ids of conversations are whole numbers.
    """
    placed = ranked(turns, conv_col, turn_col, role_col, text_col)
    return nodes(placed.drop("last"), placed.where("last").select("conv"))
