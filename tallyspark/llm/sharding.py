"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from tallyspark.operators.ranks import row_numbers

from .common import park


def ring(shards: int, replicas: int, slots: int) -> tuple[list[int], list[int]]:
    """The shard owning each arc, clockwise, and the arc of each ring slot.

    A virtual node owns the slots after its predecessor up to its own. Nodes that hash to a
    taken slot move to the next free one.
    """
    if shards * replicas > slots:
        raise ValueError("more virtual nodes than slots")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(replicas):
            digest = hashlib.blake2b(f"{shard}/{replica}".encode(), digest_size=8).digest()
            slot = int.from_bytes(digest, "big") % slots
            while slot in taken:
                slot = (slot + 1) % slots
            taken[slot] = shard
    nodes = sorted(taken)
    arc_of, arc = [], 0
    for slot in range(slots):
        if arc < len(nodes) and slot > nodes[arc]:
            arc += 1
        arc_of.append(arc % len(nodes))
    return [taken[node] for node in nodes], arc_of


def walk(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, first rank, length, shard, first place in the shard).

    In each step every arc offers its waiting runs to its owner, which takes them up to its
    room; what does not fit goes on to the next arc clockwise. The number of runs is bounded
    by arcs and shards, not by keys.
    """
    if sum(counts.values()) > sum(room):
        raise ValueError("the shards have no room for all keys")
    room, used, out = list(room), [0] * len(room), []
    waiting = {arc: [(arc, 0, n)] for arc, n in counts.items() if n}
    while waiting:
        onward = defaultdict(list)
        for arc in sorted(waiting):
            shard = owners[arc]
            for home, first, n in waiting[arc]:
                take = min(n, room[shard])
                if take:
                    out.append((home, first, take, shard, used[shard]))
                    used[shard] += take
                    room[shard] -= take
                if take < n:
                    onward[(arc + 1) % len(owners)].append((home, first + take, n - take))
        waiting = onward
    return out


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may take: the mean times 1 + slack; without slack, counts that differ
    by at most one and add up to ``rows``."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def shard(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    replicas: int = 32,
    slots: int = 4096,
    slack: float = 0.0,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row.

    A row's place on the ring is a hash of its id. Rows wait for their arc's shard in ring
    order (hash, id, text checksum, size); those beyond its capacity continue clockwise. With
    ``slack=0`` shard sizes differ by at most one row; with more slack fewer rows move when
    shards are added. The driver sees one count per arc (``shards * replicas`` at most). Ranks
    come from range-sorted slices, so an arc, an id or a text with a third of all rows fills
    many of them; a tie-breaker parts even equal rows, whose ranks do not matter.

    A null text has no bytes (size 16, checksum 0); a null id is a key like any other;
    repeated rows are placed one by one; an empty table gives no rows; other columns are not
    read.
    """
    spark = docs.sparkSession
    owners, arc_of = ring(shards, replicas, slots)
    place = F.xxhash64(F.col(id_col))
    arcs = F.split(F.lit(",".join(map(str, arc_of))), ",").cast("array<int>")
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = park(
        docs.select(
            F.col(id_col).alias("__id"),
            F.element_at(arcs, F.pmod(place, F.lit(slots)).cast("int") + 1).alias("__arc"),
            place.alias("__place"),
            (F.octet_length(data).cast("long") + 16).alias("__size"),
            F.crc32(data).alias("__crc"),
            F.monotonically_increasing_id().alias("__tie"),
        )
    )
    counts = {r[0]: r[1] for r in rows.groupBy("__arc").count().collect()}
    runs = walk(counts, owners, capacities(sum(counts.values()), shards, slack))
    table = spark.createDataFrame(runs, "arc int, first long, n long, shard int, slot0 long")
    order = [F.col(c).asc_nulls_first() for c in ("__place", "__id", "__crc", "__size", "__tie")]
    rows = row_numbers(rows, ["__arc"], order, "__rank").withColumn("__rank", F.col("__rank").cast("long") - 1)
    here = (
        (F.col("__arc") == F.col("arc"))
        & (F.col("__rank") >= F.col("first"))
        & (F.col("__rank") < F.col("first") + F.col("n"))
    )
    # The runs are bounded by the ring, so this side may always be broadcast.
    return rows.join(F.broadcast(table), here).select(
        F.col("__id").alias(id_col),
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        "shard",
        (F.col("slot0") + F.col("__rank") - F.col("first")).alias("slot"),
    )
