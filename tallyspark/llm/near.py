"""Near-duplicate documents by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyspark.operators.skew import heavy_keys, skew_join

from .common import chained, hashed, mixed, park, plain, portions, words_of
from .components import components

SHINGLE, PERCENT = 5, 80
#: A pair at similarity 0.8 shares no band with probability (1 - 0.8^7)^48, about 1e-5.
ROWS, BANDS = 7, 48
COORDINATES = ROWS * BANDS
#: Coordinates compared before verification, one byte each, and how many must agree: 0.62 is
#: more than five standard deviations below 0.8.
COMPARED, AGREE = 128, 79


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct ``size``-word shingles of each text as sorted 64-bit hashes; fewer words
    make one shingle, no words none."""
    words, index, counts = words_of(texts)
    if not len(words):
        return [np.zeros(0, np.uint64)] * len(counts)
    hashes = hashed(words)[index]
    n = len(hashes)
    joined = mixed(hashes, size)
    for k in range(1, size):
        joined[: n - k] = chained(joined[: n - k], hashes[k:])
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(np.unique(joined[at : at + count - size + 1]))
        elif count:
            whole = mixed(hashes[at : at + 1], count)
            for k in range(1, count):
                whole = chained(whole, hashes[at + k : at + k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row each.

    Round i throws every element into a bin by its i-th hash; a bin keeps the smallest
    (round, hash). After ``coordinates`` rounds of random bins, round ``coordinates`` + k throws
    all elements into bin k, so every coordinate is filled after twice as many rounds. A set
    whose bins are full takes no part in later rounds: they could not change it.
    """
    t = coordinates
    out = np.full((len(sets), t), np.iinfo(np.uint64).max)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    free = np.iinfo(np.uint64).max
    for i in range(2 * t):
        if not len(elements):
            break
        h = mixed(elements, i + 1)
        bins = (h & np.uint64(0xFFFF)).astype(np.int64) % t if i < t else i - t
        value = (np.uint64(i) << np.uint64(48)) | (h >> np.uint64(16))
        np.minimum.at(out.reshape(-1), owner * t + bins, value)
        if i < 8 or i % 8 == 7:
            active = np.unique(owner)
            open_ = np.zeros(len(sets), bool)
            open_[active[(out[active] == free).any(axis=1)]] = True
            keep = open_[owner]
            elements, owner = elements[keep], owner[keep]
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, n, high, low, bands, sketch): size and digest of each set, a hash for each band,
    and the bytes compared before verification."""

    def run(batches):
        for batch in portions(batches, 1):
            sets = shingle_sets(plain(batch.column(1)), size)
            full = [s for s in sets if len(s)]
            drawn = sketches(full)
            bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS))
            for k in range(ROWS):
                bands = chained(bands, drawn[:, k::ROWS])
            short = (mixed(drawn[:, :COMPARED]) >> np.uint64(56)).astype(np.uint8)
            bands, short, digest = iter(bands.view(np.int64)), iter(short), [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([d >> 64 for d in digest], np.uint64).view(np.int64)),
                    pa.array(np.array([d & 0xFFFFFFFFFFFFFFFF for d in digest], np.uint64).view(np.int64)),
                    pa.array([next(bands) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    pa.array([next(short).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ],
                names=["id", "n", "high", "low", "bands", "sketch"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(
        run, "id long, n long, high long, low long, bands array<long>, sketch binary"
    )


def _close_sizes(one: str, other: str, percent: int) -> F.Column:
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """(a, b, x, y): parked ``pairs`` with the ``value`` of either end. The centre of a large group
    is ``a`` of very many pairs; they are dealt to several tasks, with its value for each."""
    x, y = (values.select(F.col("id").alias(end), F.col("value").alias(v)) for end, v in (("a", "x"), ("b", "y")))
    return skew_join(pairs, x, "a", ["b"]).join(y, "b")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches agree often enough."""

    def run(batches):
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COMPARED) for c in (2, 3)
            )
            yield batch.filter(pa.array((x == y).sum(1) >= AGREE)).select([0, 1])

    both = _both(pairs, nodes.select("id", F.col("sketch").alias("value")))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. Texts are fetched only for documents in
    pairs; both sets of a pair are built where the pair is."""

    def run(batches):
        for batch in portions(batches, 2, 2 << 20):
            x, y = (shingle_sets(plain(batch.column(c)), size) for c in (2, 3))
            hit = []
            for s, o in zip(x, y, strict=True):
                both = len(np.intersect1d(s, o, assume_unique=True))
                hit.append(100 * both >= percent * (len(s) + len(o) - both))
            yield batch.filter(pa.array(hit, pa.bool_())).select([0, 1])

    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("value"))
    both = _both(pairs, park(texts.join(ids, "id", "left_semi")))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _rare_pairs(
    members: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int
) -> DataFrame:
    """Pairs (a, b) of ``members`` (id, label) with different labels that may be similar enough.

    Of two similar sets of a <= b shingles, ranked alike, the smaller shares one of its rarest
    a - ceil(1.6 a / 1.8) + 1 with the rarest b - ceil(0.8 b) + 1 of the larger (at 80 percent).
    Ranked by their number of members, shingles that only one text holds come first: variants
    of one template whose own words are more than a ninth of the text meet nobody, where
    comparing them would cost the square of their number. Where members of one large component
    share a shingle, only the others are paired with them.
    """

    def run(batches):
        for batch in portions(batches, 1):
            sets = shingle_sets(plain(batch.column(1)), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) >> 1 for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([len(s) + 1 + -len(s) * percent // 100 for s in sets], pa.int64()),
                    pa.array([len(s) + 1 + -2 * len(s) * percent // (100 + percent) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "set", "n", "large", "small", "shingles"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(members.select("id"), "id", "left_semi")
    schema = "id long, set long, n long, large long, small long, shingles array<long>"
    sets = park(texts.mapInArrow(run, schema).dropDuplicates(["id", "set"]))
    each = sets.select("id", "set", "n", "large", "small", F.explode("shingles").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    alone = F.col("n") - F.size("known")  # shingles of this text only: the rarest
    rare = (
        each.join(held, "s")
        .groupBy("id", "set", "n", "large", "small")
        .agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("known"))
        .select("id", "n", "known", alone.alias("alone"), (F.col("large") - alone).cast("int").alias("large"), "small")
        .where("large > 0")
        .select("id", "n", "alone", "small", F.posexplode(F.slice("known", F.lit(1), F.col("large"))).alias("at", "k"))
        .select("id", "n", F.col("k.s").alias("s"), "small", (F.col("alone") + F.col("at")).alias("rank"))
        .select("id", "n", "s", (F.col("rank") < F.col("small")).alias("small"), (F.col("n") - F.col("rank")).alias("rest"))
    )
    rare = park(rare.join(members, "id"))
    # Counted by shingle and label first: no task holds all labels of a common shingle.
    of_label = rare.groupBy("s", "label").agg(F.count("*").alias("c"))
    most = F.max_by("label", F.struct(F.col("c"), -F.col("label"))).alias("main")
    main = of_label.groupBy("s").agg(most, F.count("*").alias("labels"))
    # A shingle of very many rows is dealt to several tasks in both joins.
    rare = park(skew_join(rare, main.where("labels > 1").select("s", "main"), "s", ["id"]))
    heavy = heavy_keys(rare, "s", 0.5 / int(rare.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = rare.where("small").select("s", *[F.col(c).alias(f"x_{c}") for c in ("id", "n", "label", "rest", "main")])
    y = rare.select("s", *[F.col(c).alias(f"y_{c}") for c in ("id", "n", "label", "rest", "main")])
    across = (
        (F.col("x_label") != F.col("y_label"))
        & (F.col("x_n") <= F.col("y_n"))
        & (100 * F.col("x_n") >= percent * F.col("y_n"))
        # From their first common shingle on, both must hold enough for the overlap needed.
        & ((100 + percent) * F.least("x_rest", "y_rest") >= percent * (F.col("x_n") + F.col("y_n")))
    )
    ends = F.col("x_id").alias("id"), F.col("y_id").alias("b")
    found = skew_join(y, x.where("x_label <> x_main"), "s", ["y_id"], heavy=heavy).where(across).select(*ends)
    others = skew_join(x, y.where("y_label <> y_main"), "s", ["x_id"], heavy=heavy).where(across).select(*ends)
    found = found.unionByName(others)
    return found.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def links(
    nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int
) -> DataFrame:
    """Verified links (a, b) whose components are those of all pairs that share a band.

    First every member of a bucket is compared with the bucket's lowest id, which joins most of
    a large group of near copies with one comparison each. Then the documents of buckets that
    still hold several components are compared across components, by their rarest shingles.
    Pairs inside one component are never listed: they cannot change it.
    """
    banded = nodes.select("id", "n", F.explode("bands").alias("band"))
    centres = (
        banded.groupBy("band")
        .agg(F.count("*").alias("members"), F.min(F.struct("id", "n")).alias("centre"))
        .where("members > 1")
        .select("band", F.col("centre.id").alias("a"), F.col("centre.n").alias("m"))
    )
    shared = park(banded.join(centres, "band"))
    stars = (
        shared.where((F.col("id") != F.col("a")) & _close_sizes("n", "m", percent))
        .select("a", F.col("id").alias("b"))
        .distinct()
    )
    stars = park(_likely(park(stars), nodes))
    first = park(_verified(stars, docs, id_col, text_col, size, percent))
    labels = components(first).withColumnRenamed("node", "id")
    labelled = shared.select("band", "id").join(labels, "id", "left")
    labelled = labelled.select("band", "id", F.coalesce("component", "id").alias("label"))
    several = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    members = park(labelled.join(several, "band", "left_semi").select("id", "label").distinct())
    pairs = _rare_pairs(members, docs, id_col, text_col, size, percent).join(stars, ["a", "b"], "left_anti")
    pairs = park(_likely(park(pairs), nodes))
    return first.unionByName(_verified(pairs, docs, id_col, text_col, size, percent))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Documents are linked where ``100 * |A and B| >= percent * |A or B|`` for their shingle
    sets; a component is named by its smallest id, and that document is kept. Documents with
    equal sets are one node, so a large group of copies costs no comparisons.

    Ids must be integers. Null, empty and word-less texts are linked with nothing; so are rows
    without an id (component null, kept); rows that repeat an id are one document with all
    their texts and share its component; texts of any length are compared whole; an empty
    table gives no rows; other columns are not read. Bands and sketches are made for 80 percent
    and more; a smaller ``percent`` is refused.
    """
    if percent < PERCENT:
        raise ValueError(f"percent must be at least {PERCENT}: the bands miss links below it")
    found = park(signatures(docs, id_col, text_col, size))
    full = found.where("id IS NOT NULL AND n > 0")
    classes = park(full.groupBy("high", "low").agg(F.min("id").alias("node")))
    same_id = full.select(F.col("id").alias("a"), "high", "low").join(classes, ["high", "low"])
    mine = F.col("id") == F.col("node")
    nodes = park(full.join(classes, ["high", "low"]).where(mine).drop("node").dropDuplicates(["id", "high", "low"]))
    found_links = links(nodes, docs.where(F.col(id_col).isNotNull()), id_col, text_col, size, percent)
    # Labels are worked out between nodes; copies take the label of theirs.
    labels = components(found_links.unionByName(_several(same_id)))
    label = F.coalesce("component", "node")
    of_copy = (
        same_id.join(labels, "node", "left").groupBy(F.col("a").alias("id")).agg(F.min(label).alias("component_id"))
    )
    own = found.select("id", F.col("n").alias("n_shingles"))
    return own.join(of_copy, "id", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def _several(same_id: DataFrame) -> DataFrame:
    """Links between the nodes of ids that belong to several: rows that repeat an id with
    another text."""
    each = same_id.select("a", F.col("node").alias("b")).distinct()
    split = each.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a")
    return each.join(split, "a").where("a <> b")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__id"]), "left_semi")
