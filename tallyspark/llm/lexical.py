"""Ranked lexical search over a length-stratified index.

Documents of one normaliser form a stratum, cut into slices of a bounded number of documents.
Inside a slice a term's postings are grouped by term frequency, highest first: what an
occurrence adds to a score depends on the term, the stratum and the frequency alone, so it is
computed once for each frequency of a slice. The highest group of each term bounds what any
document of the slice can score, and slices are visited in the order of these bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import mixed, park, plain, portions, words_of

SLICE = 512
ITEM_BYTES = 4 << 20

_TERM = np.full(256, 0x20, np.uint8)  # separators become spaces, A-Z become a-z
_TERM[0x30:0x3A] = np.arange(0x30, 0x3A)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms, the index of each occurrence, and the number of terms of each text."""
    _, offsets, data = texts.buffers()
    if data is None:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    mapped = pa.py_buffer(_TERM[np.frombuffer(data, np.uint8)])
    cleaned = pa.Array.from_buffers(texts.type, len(texts), [None, offsets, mapped], offset=texts.offset)
    return words_of(cleaned, lower=False)


@dataclass(frozen=True)
class Items:
    """A block of queries: their terms as numbers of ``vocabulary``, with repeats as counts."""

    ids: list
    vocabulary: pa.Array
    terms: np.ndarray
    times: np.ndarray
    ends: np.ndarray


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: int = ITEM_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``most`` bytes of text, which is what one pass over the
    documents broadcasts. Rows that repeat an id and a text count once; several texts of one id
    are one item with the terms of all."""
    rows = items.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / most))
    for block in range(blocks):
        found = rows.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).orderBy("i", "t").collect()
        ids = list(dict.fromkeys(r.i for r in found))
        number = {i: at for at, i in enumerate(ids)}
        vocabulary, index, counts = terms_of(pa.array([r.t for r in found], pa.string()))
        of = np.repeat(np.array([number[r.i] for r in found], np.int64), counts)
        keys, times = np.unique(of * max(1, len(vocabulary)) + index, return_counts=True)
        ends = np.searchsorted(keys, np.arange(1, len(ids) + 1) * max(1, len(vocabulary)))
        yield Items(ids, vocabulary, keys % max(1, len(vocabulary)), times, ends)


def counted(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs, salt) of each document with a term: n counts all terms with repeats;
    terms and tfs are those of ``vocabulary``. Parked, since salts must stay as they are."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        listed, size = known.value, max(1, len(known.value))
        context, row = TaskContext.get(), 0
        first = (context.partitionId() if context else 0) << 40
        for batch in portions(batches, 1):
            words, index, counts = terms_of(plain(batch.column(1)))
            at = pc.fill_null(pc.index_in(words, value_set=listed), -1).to_numpy().astype(np.int64)[index]
            owner = np.repeat(np.arange(len(counts)), counts)
            keys, tfs = np.unique((owner * size + at)[at >= 0], return_counts=True)
            offsets = np.searchsorted(keys, np.arange(len(counts) + 1) * size).astype(np.int32)
            salts = (mixed(np.arange(first + row, first + row + len(counts), dtype=np.uint64)) >> np.uint64(33)).astype(np.int32)
            row += len(counts)
            found = pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array((keys % size).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
                    pa.array(salts),
                ],
                names=["id", "n", "terms", "tfs", "salt"],
            )
            yield found.filter(pa.array(counts > 0))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return park(rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>, salt int"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches as tables of whole slices, at least one batch at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        m, part = (batch.column(c).to_numpy() for c in (0, 1))
        before = np.flatnonzero((m != m[-1]) | (part != part[-1]))
        cut = int(before[-1]) + 1 if len(before) else 0
        if held and cut == 0 and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (m[0], part[0]):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table) -> list[tuple[int, int]]:
    m, part = (table.column(c).to_numpy() for c in (0, 1))
    starts = np.concatenate(([0], np.flatnonzero((m[1:] != m[:-1]) | (part[1:] != part[:-1])) + 1, [len(m)]))
    return list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in a row, and where each list starts and the last ends."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def index(rows: DataFrame, n_docs: int, n_terms: int, size: int = SLICE) -> DataFrame:
    """The postings of ``counted`` rows by (m, slice, term): ``tfs`` falling, ``ends`` of their
    groups in ``places``; the row of term -1 has the ids by place, ascending.

    A stratum is cut by a random salt into slices of about ``size`` documents, so one length
    that a third of all documents share fills many slices.
    """
    held = rows.where(F.size("terms") > 0).withColumn("m", F.expr(f"75 + (25 * n * {n_docs}L) div {max(1, n_terms)}L"))
    strata = held.groupBy("m").agg(F.ceil(F.count("*") / size).alias("slices"))
    dealt = held.join(strata, "m").withColumn("slice", F.pmod("salt", F.col("slices")).cast("int"))
    dealt = dealt.select("m", "slice", "id", "terms", "tfs")

    def run(batches):
        for table in _blocks(batches):
            (terms, at), (tfs, _) = _flat(table.column(3)), _flat(table.column(4))
            terms, tfs = terms.to_numpy().astype(np.int64), tfs.to_numpy().astype(np.int64)
            for start, end in _bounds(table):
                term, tf = terms[at[start] : at[end]], tfs[at[start] : at[end]]
                place = np.repeat(np.arange(end - start), np.diff(at[start : end + 1]))
                order = np.lexsort((place, -tf, term))
                term, tf, place = term[order], tf[order], place[order]
                new_term = np.concatenate(([True], term[1:] != term[:-1]))
                new_group = new_term | np.concatenate(([True], tf[1:] != tf[:-1]))
                first, groups = np.flatnonzero(new_term), np.flatnonzero(new_group)
                ends = np.append(groups[1:], len(term)) - first[np.cumsum(new_term)[groups] - 1]
                in_groups = np.append(np.searchsorted(groups, first), len(groups)).astype(np.int32)
                in_places = np.append(first, len(term)).astype(np.int32)
                ids = table.column(2).slice(start, end - start).combine_chunks()
                zero = np.zeros(1, np.int32)
                n = len(first) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, table.column(0)[start].as_py())),
                        pa.array(np.full(n, table.column(1)[start].as_py(), np.int32)),
                        pa.array(np.append(-1, term[first]).astype(np.int32)),
                        pa.ListArray.from_arrays(np.append(zero, in_groups), pa.array(tf[groups].astype(np.int32))),
                        pa.ListArray.from_arrays(np.append(zero, in_groups), pa.array(ends.astype(np.int32))),
                        pa.ListArray.from_arrays(np.append(zero, in_places), pa.array(place.astype(np.int32))),
                        pa.ListArray.from_arrays(
                            np.append(zero, np.full(n, len(ids), np.int32)), ids if isinstance(ids, pa.Array) else ids.chunk(0)
                        ),
                    ],
                    names=["m", "slice", "term", "tfs", "ends", "places", "ids"],
                )

    schema = "m long, slice int, term int, tfs array<int>, ends array<int>, places array<int>, ids array<long>"
    return park(dealt.repartition("m", "slice").sortWithinPartitions("m", "slice", "id").mapInArrow(run, schema))


class _Best:
    """The ``k`` highest of (score, id), ties by ascending id, an id that is null first."""

    def __init__(self, k: int):
        self.k, self.floor = k, 0
        self.scores, self.known, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        s, n, i = (np.concatenate(x) for x in ((self.scores, scores), (self.known, known), (self.ids, ids)))
        order = np.lexsort((i, n, -s))[: self.k]
        self.scores, self.known, self.ids = s[order], n[order], i[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


class _Slice:
    """A slice's postings with what each adds to a score."""

    def __init__(self, m: int, terms: np.ndarray, tfs: np.ndarray, tf_at: np.ndarray, ends: np.ndarray, places: np.ndarray, at: np.ndarray, ids: pa.Array, weights: np.ndarray):
        self.terms, self.places, self.at = terms, places, at
        self.known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy()
        distinct, which = np.unique(tfs, return_inverse=True)
        impacts = (1_000_000_000 * distinct) // (1000 * distinct + 12 * m)
        of = np.repeat(np.arange(len(terms)), np.diff(tf_at))
        added = weights[terms][of] * impacts[which]
        first = np.zeros(len(tfs), bool)
        first[tf_at[:-1]] = True
        sizes = np.where(first, ends, np.diff(ends, prepend=0))
        self.added = np.repeat(added, sizes)
        self.most = added[tf_at[:-1]]

    def scores(self, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.ids), np.int64)
        found = np.searchsorted(self.terms, terms)
        there = found < len(self.terms)
        there[there] = self.terms[found[there]] == terms[there]
        for f, n in zip(found[there].tolist(), times[there].tolist(), strict=True):
            start, end = self.at[f], self.at[f + 1]
            total[self.places[start:end]] += n * self.added[start:end]  # a place occurs once in a term
        return total


def _slices(table: pa.Table, weights: np.ndarray) -> list[_Slice]:
    m, term = table.column(0).to_numpy(), table.column(2).to_numpy()
    (tfs, tf_at), (ends, _), (places, at), (ids, id_at) = (_flat(table.column(c)) for c in (3, 4, 5, 6))
    tfs, ends, places = (x.to_numpy().astype(np.int64) for x in (tfs, ends, places))
    out = []
    for start, end in _bounds(table):
        a, b = start + 1, end  # the row of ids comes first
        out.append(
            _Slice(
                int(m[start]), term[a:b].astype(np.int64),
                tfs[tf_at[a] : tf_at[b]], tf_at[a : b + 1] - tf_at[a], ends[tf_at[a] : tf_at[b]],
                places[at[a] : at[b]], at[a : b + 1] - at[a],
                ids.slice(id_at[start], id_at[start + 1] - id_at[start]), weights,
            )
        )
    return out


def best(found: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """(item, id, score): of each task's slices the ``k`` best documents of each item. A slice is
    skipped only where its bound is below the score of the k-th found so far; the slices of a
    batch are visited from the highest bound down."""
    shared = found.sparkSession.sparkContext.broadcast((items.terms, items.times, items.ends, weights))

    def run(batches):
        terms, times, ends, weights = shared.value
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
        tops = [_Best(k) for _ in ends]
        asked = [i for i in range(len(ends)) if starts[i] < ends[i]]
        for table in _blocks(batches):
            slices = _slices(table, weights)
            bounds = np.zeros((len(slices), len(ends)), np.int64)
            most = np.zeros(len(weights), np.int64)
            for s, one in enumerate(slices):
                most[:] = 0
                most[one.terms] = one.most
                # Sums over each item's terms; items without terms stay at 0.
                total = np.concatenate(([0], np.cumsum(most[terms] * times)))
                bounds[s] = total[ends] - total[starts]
            for i in asked:
                top = tops[i]
                asks, often = terms[starts[i] : ends[i]], times[starts[i] : ends[i]]
                for s in np.argsort(-bounds[:, i], kind="stable").tolist():
                    if bounds[s, i] < max(top.floor, 1):
                        break
                    scores = slices[s].scores(asks, often)
                    hits = np.flatnonzero(scores >= max(top.floor, 1))
                    if len(hits):
                        top.add(scores[hits], slices[s].known[hits], slices[s].ids[hits])
        for i, top in enumerate(tops):
            if len(top.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(top.scores), i, np.int64)),
                        pa.array(top.ids, mask=~top.known),
                        pa.array(top.scores),
                    ],
                    names=["item", "id", "score"],
                )

    sorted_rows = found.repartition("m", "slice").sortWithinPartitions("m", "slice", "term")
    return sorted_rows.mapInArrow(run, "item long, id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = SLICE,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(item, rank, document, score): each item's ``k`` best documents, exactly.

    Terms are runs of letters and digits, and of all that is not ASCII, with A-Z in small
    letters. Ids of documents are whole numbers. A null or empty text has no term: such a
    document is not counted and such an item finds nothing. Texts of any length count whole.
    Equal scores are ordered by id, null first. Rows that repeat a document id are documents of
    their own; rows that repeat an item id are one item with the terms of all its distinct texts.
    Empty tables give no rows; other columns are not read.

    All documents are indexed, under the terms of the items at hand; items come in blocks of
    ``item_bytes`` of text, and every block is answered by all documents.
    """
    spark = docs.sparkSession
    out_schema = StructType(
        [StructField("__item", LongType(), False), StructField(item_col, items.schema[item_col].dataType, True)]
    )
    answers = None
    for block in item_blocks(items, item_col, item_text, item_bytes):
        rows = counted(docs, block.vocabulary, id_col, text_col)
        n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = index(rows, n_docs, n_terms, size)
        holders = found.where("term >= 0").groupBy("term").agg(F.sum(F.size("places")).alias("df")).collect()
        weights = np.zeros(max(1, len(block.vocabulary)), np.int64)
        for r in holders:  # one row for each term of the block of items
            weights[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
        names = spark.createDataFrame(list(enumerate(block.ids)), out_schema)
        top = best(found, block, weights, k)
        # Each task gives at most k rows an item, and each map task passes on at most k.
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_first())
        top = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        answer = top.join(F.broadcast(names), top["item"] == names["__item"]).select(
            names[item_col], "rank", F.col("id").alias(id_col), "score"
        )
        answers = answer if answers is None else answers.unionByName(answer)
    return answers
