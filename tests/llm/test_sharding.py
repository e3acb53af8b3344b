import zlib
from collections import Counter

from tallyspark.llm import sharding

from . import cases


def check(rows, found, shards):
    """The law of the query: sizes, checksums, counts and gapless slots."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    counts = Counter(r.shard for r in found)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert sorted((r.shard, r.slot) for r in found) == [(s, k) for s in range(shards) for k in range(sizes[s])]


def test_ring_has_an_arc_for_every_slot():
    owners, arc_of = sharding.ring(5, 8, 256)
    assert len(owners) == 40 and Counter(owners) == Counter({s: 8 for s in range(5)})
    assert len(arc_of) == 256 and set(arc_of) == set(range(40))
    steps = [b - a for a, b in zip(arc_of, arc_of[1:])]
    assert set(steps) <= {0, 1, -39}


def test_overflow_continues_clockwise():
    # Arc 0 holds everything; its shard takes two keys, the next owner clockwise the others.
    runs = sharding.walk({0: 5}, owners=[1, 0, 2], room=[2, 2, 1])
    assert sorted(runs) == [(0, 0, 2, 1, 0), (0, 2, 2, 0, 0), (0, 4, 1, 2, 0)]


def test_slack_moves_few_rows_and_only_overflow_moves_else(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    place = {n: {r.doc_id: r.shard for r in sharding.shard(docs, n, slack=0.25).collect()} for n in (10, 11)}
    loads = Counter(place[10].values())
    assert max(loads.values()) <= 500
    moved = sum(place[10][k] != place[11][k] for k in place[10])
    assert moved < 0.35 * 4000  # a modulus would move ten elevenths


def test_odd_rows(spark):
    check(cases.ODD, sharding.shard(cases.odd(spark), 4).collect(), 4)
    check(cases.ODD, sharding.shard(cases.odd(spark, extra=False), 40).collect(), 40)
    assert sharding.shard(cases.empty(spark), 40).count() == 0


def test_one_text_for_a_third_of_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(600)]
    check(rows, sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect(), 7)


def brute(rows, shards, replicas=32, slots=4096):
    """(id, size, checksum, shard, slot) by walking the ring row by row. ``rows``: (id, text, place)."""
    owners, arc_of = sharding.ring(shards, replicas, slots)
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    kept = sorted(
        (
            (place, -1 if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16, i)
            for i, t, place in rows
        ),
        key=lambda r: r[:4],
    )
    waiting = {arc: [] for arc in range(len(owners))}
    for r in kept:
        waiting[arc_of[r[0] % slots]].append(r)
    filled, out = [0] * shards, []
    while any(waiting.values()):
        onward = {arc: [] for arc in waiting}
        for arc in sorted(waiting):
            for place, _, crc, size, i in waiting[arc]:
                shard = owners[arc]
                if filled[shard] < room[shard]:
                    out.append((i, size, crc, shard, filled[shard]))
                    filled[shard] += 1
                else:
                    onward[(arc + 1) % len(owners)].append((place, -1 if i is None else i, crc, size, i))
        waiting = onward
    return out


def test_every_row_against_a_walk_of_single_rows(spark):
    rows = [(None if i % 3 == 0 else i % 250, f"t{i % 11}" if i % 5 else None) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = [tuple(r) for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id)").collect()]
    for shards in (7, 40):
        found = Counter(tuple(r) for r in sharding.shard(docs, shards).collect())
        assert found == Counter(brute(placed, shards))


def test_rows_of_one_id_fill_many_slices(spark):
    rows = [(5 if i % 3 == 0 else i, "same" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(rows, sharding.shard(docs, 7).collect(), 7)


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op10_sharding

    found = op10_sharding(spark, cases.DATA).collect()
    check(cases.documents(spark), found, 40)
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
