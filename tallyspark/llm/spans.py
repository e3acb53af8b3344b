"""Substring dedup by sliding spans of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tallyspark.operators.ranks import row_numbers

from .common import chained, park, plain, portions

#: Ends of sentences: white space after a stop, or a line break.
ENDS = re.compile(r"((?<=[.!?])[ \t\r\f\v]+|[ \t\r\f\v]*\n\s*)")
WORDS = re.compile(r"\s*\S+\s*")
LONGEST, SPAN = 12, 3
#: A span that more than one in so many occurrences of repeated spans belong to is joined in
#: slices. There can be no more such spans than this, so their list is broadcast.
SLICES = 10_000


def cuts(words: list[str], longest: int = LONGEST) -> list[int]:
    """Ends of the parts of a sentence, none of more than ``longest`` words.

    In every window of ``longest`` words the pair of words with the least hash is followed by a
    cut, so cuts inside a passage depend on its own words and are the same in all its copies,
    from the first ``longest`` words of the passage to the last. Where equal pairs share the
    least hash, the one already cut after stays, so that one repeated word is cut seldom; there
    copies may be cut alike only later.
    """
    n = len(words)
    if n < longest:
        return [n]
    digest, width = xxhash.xxh3_64_intdigest, longest - 1
    pairs = [digest(f"{a} {b}") for a, b in zip(words, words[1:])]
    out, first = [], 0
    while first + width <= n - 1:
        window = pairs[first : first + width]
        least = min(window)
        at = first + width - 1 - window[::-1].index(least)
        out.append(at + 2)
        after = at + 1
        while after < min(at + width, n - 1):
            if pairs[after] < least:
                at, least = after, pairs[after]
                out.append(at + 2)
            after += 1
        first = at + 1
    if out[-1] < n:
        out.append(n)
    return out


def divided(text: str, longest: int = LONGEST) -> Iterator[tuple[str, str, list[str], list[int]]]:
    """Each sentence, the white space after it, its words and the ends of its parts."""
    split = ENDS.split(text)
    for at in range(0, len(split), 2):
        words = split[at].split()
        yield split[at], split[at + 1] if at + 1 < len(split) else "", words, cuts(words, longest) if words else []


def sentences(text: str, longest: int = LONGEST) -> tuple[list[str], list[int]]:
    """The parts of ``text`` (joined, they give it back) and the words in each.

    A part is a sentence with the white space after it; a sentence of ``longest`` words or more
    is cut where its words say so. Leading white space belongs to the first part.
    """
    parts, sizes, lead = [], [], ""
    for sentence, gap, found, ends in divided(text, longest):
        if not ends:
            if parts:
                parts[-1] += sentence + gap
            else:
                lead += sentence + gap
            continue
        first = len(parts)
        if len(ends) == 1:
            parts.append(sentence)
            sizes.append(len(found))
        else:
            words = WORDS.findall(sentence)
            for start, end in zip([0, *ends], ends):
                parts.append("".join(words[start:end]))
                sizes.append(end - start)
        parts[first] = lead + parts[first]
        parts[-1] += gap
        lead = ""
    if lead:
        parts.append(lead)
        sizes.append(0)
    return parts, sizes


def span_hashes(text: str, span: int = SPAN) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of parts that hold words, and two 64-bit hashes of every run of ``span`` of
    them; white space does not count."""
    digest, one = xxhash.xxh3_64_intdigest, []
    for _, _, words, ends in divided(text):
        one += [digest(" ".join(words[start:end])) for start, end in zip([0, *ends], ends)]
    if len(one) < span:
        return len(one), np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = np.array(one, np.uint64)
    n = len(one) - span + 1
    high, low = one[:n], one[:n] ^ np.uint64(0x5851F42D4C957F2D)
    for k in range(1, span):
        high, low = chained(high, one[k : n + k]), chained(one[k : n + k], low)
    return len(one), high.view(np.int64), low.view(np.int64)


def removed(starts: list[int], sizes: list[int], span: int = SPAN, least_words: int = 0) -> np.ndarray:
    """Which parts go: those under repeated spans, where the joined spans hold at least
    ``least_words`` words."""
    covered = np.zeros(len(sizes) + 1, bool)
    for start in starts:
        covered[start : start + span] = True
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
    for begin, end in zip(edges[::2], edges[1::2]):
        if sum(sizes[begin:end]) < least_words:
            covered[begin:end] = False
    return covered[:-1]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with columns ``c0``, ``c1``, ... in place of its own names, and ``id`` and ``tag``:
    rows that share an id are told apart by a hash of their text."""
    at = docs.columns.index
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    tag = F.xxhash64(F.coalesce(F.col(f"c{at(text_col)}"), F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1))
    return rows.withColumns({"id": F.col(f"c{at(id_col)}"), "tag": tag.cast("int")})


def spans(rows: DataFrame, text_col: str, span: int = SPAN) -> DataFrame:
    """(id, tag, parts, spans): for every text of ``keyed`` rows the number of its parts and the
    (high, low) hashes of its spans in order."""

    def run(batches):
        for batch in portions(batches, 2):
            parts, high, low = [], [], []
            for text in plain(batch.column(2)).to_pylist():
                n, a, b = span_hashes(text, span)
                parts.append(n)
                high.append(a)
                low.append(b)
            ends = np.concatenate(([0], np.cumsum([len(a) for a in high]))).astype(np.int32)
            pairs = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (high, low)]
            each = pa.StructArray.from_arrays(pairs, names=["high", "low"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(parts, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), each)],
                names=["id", "tag", "parts", "spans"],
            )

    pair = T.StructType().add("high", T.LongType()).add("low", T.LongType())
    out = T.StructType().add("id", rows.schema["id"].dataType).add("tag", T.IntegerType()).add("parts", T.IntegerType()).add("spans", T.ArrayType(pair))
    return rows.select("id", "tag", text_col).mapInArrow(run, out)


def repeats(parted: DataFrame) -> DataFrame:
    """(id, tag, at): the spans of each text that occurred before, in an earlier text by id or
    earlier in the same one. ``parted``: what ``spans`` gives, parked, as it is read twice.

    Counts and first places are combined before the shuffle, so a span that a third of all
    texts hold costs one row per task. Where it is joined back to its texts, it is cut into
    slices of at most about one ``SLICES``-th of all occurrences each.
    """
    found = parted.select("id", "tag", F.posexplode("spans").alias("at", "pair"))
    found = found.select("id", "tag", "at", "pair.high", "pair.low")
    place = F.struct("id", "tag", "at")
    counted = found.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    firsts = park(counted.where("n > 1"))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    slices = F.ceil(F.col("n") / max(1.0, total / SLICES)).cast("int")
    firsts = firsts.withColumn("slices", slices)
    common = firsts.where("slices > 1").select("high", "low", "slices")
    dealt = found.join(F.broadcast(common), ["high", "low"], "left")  # fewer rows than SLICES
    dealt = dealt.withColumn("slice", F.coalesce(F.pmod(F.xxhash64("id", "tag", "at"), F.col("slices")).cast("int"), F.lit(0)))
    copies = firsts.select("high", "low", "first", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    later = dealt.join(copies, ["high", "low", "slice"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("id", "tag", "at")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    report: bool = False,
    least_words: int = 0,
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` without the sentences under any non-first repeated span; with ``report``, also
    ``n_sentences``, ``n_removed`` and ``words_removed``; with ``drop_emptied``, without the rows
    whose whole text was removed.

    The first of equal spans is that of the lowest id, then of the earliest place. Spans that
    overlap or touch are joined; with ``least_words``, joined runs of fewer words stay. A null
    text stays null; texts shorter than a span stay as they are; texts of any length are taken
    whole; of rows that repeat an id and its text one is the first and the others lose what it
    holds; an empty table stays empty. Other columns, of any name and type, pass through; with
    ``report``, columns of those three names are replaced.
    """
    extra = ["n_sentences", "n_removed", "words_removed"] if report else []
    kept = [i for i, c in enumerate(docs.columns) if c not in extra]
    names = [docs.columns[i] for i in kept]
    place = names.index(text_col)
    text = f"c{kept[place]}"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in (docs.schema[i] for i in kept)])
    for name in extra:
        schema = schema.add(name, T.IntegerType())

    def run(batches):
        for batch in batches:
            texts, numbers, stay = [], [], []
            given = zip(*(batch.column(i).to_pylist() for i in (place, len(kept), len(kept) + 1)), strict=True)
            for now, parts, starts in given:
                numbers.append((parts or 0, 0, 0))
                stay.append(True)
                if starts:
                    pieces, sizes = sentences(now)
                    gone = removed(starts, sizes, least_words=least_words)
                    now = "".join(p for p, g in zip(pieces, gone, strict=True) if not g)
                    numbers[-1] = (len(pieces), int(gone.sum()), int(np.dot(gone, sizes)))
                    stay[-1] = bool(now) or not drop_emptied
                texts.append(now)
            columns = batch.columns[: len(kept)]
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            if report:
                columns += [pa.array(c, pa.int32()) for c in (zip(*numbers) if numbers else [()] * 3)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(stay, pa.bool_()))

    rows = keyed(docs, id_col, text_col)
    parted = park(spans(rows, text))
    later = repeats(parted)
    if report:
        later = later.withColumn("parts", F.lit(None).cast("int")).unionByName(
            parted.select("id", "tag", F.lit(None).cast("int").alias("at"), "parts")
        )
    else:
        later = later.withColumn("parts", F.lit(None).cast("int"))
    found = later.groupBy("id", "tag").agg(F.max("parts").alias("parts"), F.collect_set("at").alias("starts"))

    def joined(some: DataFrame) -> DataFrame:
        same = some["id"].eqNullSafe(found["id"]) & (some["tag"] == found["tag"])
        return some.join(found, same, "left").select(*[some[f"c{i}"] for i in kept], found["parts"], found["starts"])

    twins = park(parted.groupBy("id", "tag").agg(F.count("*").alias("n"), F.max("parts").alias("parts")).where("n > 1"))
    if twins.isEmpty():
        return joined(rows).mapInArrow(run, schema)
    twin = rows["id"].eqNullSafe(twins["id"]) & (rows["tag"] == twins["tag"])
    single = rows.join(twins, twin, "left_anti")
    several = rows.join(twins, twin).select(*[rows[c] for c in rows.columns], twins["parts"])
    several = several.withColumn("order", F.monotonically_increasing_id())
    several = park(row_numbers(several, ["id", "tag"], [F.col("order")], "number"))
    whole = F.when(F.col("parts") >= SPAN, F.sequence(F.lit(0), F.col("parts") - SPAN))
    copies = several.where("number > 1").select(*[f"c{i}" for i in kept], "parts", whole.alias("starts"))
    return joined(single).unionByName(joined(several.where("number = 1"))).unionByName(copies).mapInArrow(run, schema)
