"""Quality scores by Bradley-Terry pairwise ranking, cut at a quantile of the scores."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import park, plain, portions, words_of

#: Rows one task learns from, and bytes of their features; more rows are learned by more tasks.
BITS, GROUP_ROWS, GROUP_BYTES = 16, 20_000, 256 << 20
#: Documents of the rarer class each of these tasks should meet.
LEAST_RIVALS = 100

#: Steps of the measured shares and sizes of a text. A text has one feature for each step
#: that it reaches, so that the weights form a step function of the measure.
SHARES = np.array([0.005, 0.01, 0.02, 0.04, 0.06, 0.09, 0.13, 0.18, 0.25, 0.35, 0.5, 0.7, 0.9])
SIZES = np.array([1, 3, 6, 12, 20, 35, 60, 100, 200, 400, 1000, 3000, 10000])
LENGTHS = np.array([2.0, 3.0, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 8.0, 9.0, 11.0, 15.0])
STEPS = (SHARES,) * 7 + (SIZES,) * 2 + (LENGTHS,)
MEASURES = sum(map(len, STEPS))

_CLASS = np.zeros(256, np.uint8)  # 1 upper case, 2 digit, 3 other printable ASCII, 4 line end
_CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x0A] = 1, 2, 4
_CLASS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = 3
_RUN = re.compile(r"(.)\1+", re.S)
_FOREIGN = re.compile(r"[^\x00-\x7f]+")
_KINDS = str.maketrans(
    {**{chr(c): "A" for c in range(0x41, 0x5B)}, **{chr(c): "a" for c in range(0x61, 0x7B)}, **dict.fromkeys("0123456789", "0")}
)


def _bucket(text: str, kind: str, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{text}") >> (64 - bits)


def _shapes(words: list[str], bits: int) -> np.ndarray:
    """The bucket of each word's shape: letters and digits as their kind (what is not ASCII as
    small letters), runs of one kind as one character."""
    known: dict[str, int] = {}

    def found(word: str) -> int:
        kinds = word.translate(_KINDS)
        if not kinds.isascii():
            kinds = _FOREIGN.sub("a", kinds)
        at = known.get(kinds)
        if at is None:
            at = known[kinds] = _bucket(_RUN.sub(r"\1", kinds), "s", bits)
        return at

    return np.fromiter(map(found, words), np.int64, len(words))


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive stretches of ``counts`` values."""
    ends = np.cumsum(counts)
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[ends - counts]


def _repeats(index: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: how many of its items equal an earlier one, and how often its most
    frequent item occurs."""
    rows = np.repeat(np.arange(len(counts)), counts)
    most = int(index.max(initial=0)) + 1
    pairs, times = np.unique(rows * most + index, return_counts=True)
    at = pairs // most
    frequent = np.zeros(len(counts), np.int64)
    np.maximum.at(frequent, at, times)
    return counts - np.bincount(at, minlength=len(counts)), frequent


def measures(texts: pa.Array, index: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Of each text the shares of upper case, digits, symbols, repeated words, the most frequent
    word, repeated lines and line ends; words, words a line, and bytes a word."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    kinds = _CLASS[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data else np.zeros(0, np.uint8)
    sizes = np.diff(offsets).astype(np.int64)
    upper, digits, symbols, ends = (_per_text(kinds == k, sizes) for k in (1, 2, 3, 4))
    lists = pc.split_pattern(texts, "\n")
    starts = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    n_lines = np.diff(starts)
    again, _ = _repeats(lines.indices.to_numpy().astype(np.int64), n_lines)
    repeated, frequent = _repeats(index, counts)
    chars, words, held = np.maximum(sizes, 1), np.maximum(counts, 1), np.maximum(n_lines, 1)
    return [
        upper / chars,
        digits / chars,
        symbols / chars,
        repeated / words,
        np.where(counts > 1, frequent / words, 0.0),
        again / held,
        ends / chars,
        counts,
        counts / held,
        (sizes - counts) / words,
    ]


def features(texts: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Indices and values of each text: a 1 for every step its measures reach, and the square
    roots of the shares of its words, and of their shapes, by hash."""
    words, index, counts = words_of(texts, lower=False)
    listed = words.to_pylist()
    shapes = MEASURES + _shapes(listed, bits)
    names = np.fromiter((MEASURES + _bucket(w.lower(), "w", bits) for w in listed), np.int64, len(listed))
    rows = np.repeat(np.arange(len(texts)), counts)
    size = MEASURES + (1 << bits)
    keys, times = np.unique(
        np.concatenate((rows * size + shapes[index], rows * size + names[index])) if len(listed) else np.zeros(0, np.int64),
        return_counts=True,
    )
    at, hashed = keys // size, (keys % size).astype(np.int32)
    values = np.sqrt(times / np.maximum(counts, 1)[at]).astype(np.float32)
    bounds = np.searchsorted(at, np.arange(len(texts) + 1))
    reached, first = [], 0
    for steps, found in zip(STEPS, measures(texts, index, counts), strict=True):
        reached.append((np.searchsorted(steps, found, side="right"), first))
        first += len(steps)
    out = []
    for i, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        steps = np.concatenate([np.arange(first, first + n[i], dtype=np.int32) for n, first in reached])
        out.append((np.append(steps, hashed[start:end]), np.append(np.ones(len(steps), np.float32), values[start:end])))
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the features; the score ``threshold`` becomes ``cut`` after scaling."""

    used: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float
    cut: float
    bits: int


@dataclass(frozen=True)
class BradleyTerry:
    """P(one document is preferred to another) = sigmoid(score - score), scores linear in the
    features: logistic loss on the differences of the two feature vectors, minimised with a rate
    for each weight. In every epoch each labelled document meets ``rivals`` of the other class;
    the documents of the smaller class recur as often as needed."""

    rate: float = 0.1
    l2: float = 1e-4
    epochs: int = 4
    rivals: int = 1
    bits: int = BITS
    seed: int = 11

    def pairs(self, better: int, worse: int) -> np.ndarray:
        """(preferred, other) of one epoch after another, a fixed sequence for given counts."""
        rng = np.random.default_rng(self.seed)
        n = max(better, worse) * self.rivals
        rounds = []
        for _ in range(self.epochs):
            drawn = [
                np.concatenate([rng.permutation(size) for _ in range(-(-n // size))])[:n] for size in (better, worse)
            ]
            rounds.append(np.stack(drawn, axis=1))
        return np.concatenate(rounds)

    def fit(self, rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
        """Weights; all zero where a class is missing, as there is no pair then."""
        weights = np.zeros(MEASURES + (1 << self.bits))
        squares = np.full(len(weights), 1e-6)
        better, worse = np.flatnonzero(labels > 0), np.flatnonzero(labels <= 0)
        if not len(better) or not len(worse):
            return weights
        for i, j in self.pairs(len(better), len(worse)).tolist():
            (xi, vi), (xj, vj) = rows[better[i]], rows[worse[j]]
            lead = weights[xi] @ vi - weights[xj] @ vj
            push = 1.0 / (1.0 + np.exp(np.clip(lead, -40.0, 40.0)))
            if push < 1e-3:
                continue
            place, at = np.unique(np.concatenate((xi, xj)), return_inverse=True)
            step = push * np.bincount(at, np.concatenate((vi, -vj))) - self.l2 * weights[place]
            squares[place] += step * step
            weights[place] += self.rate * step / np.sqrt(squares[place])
        return weights


def _middle(low: float, high: float) -> float:
    return float(np.quantile(np.array([low, high]), 0.5, method="midpoint"))


def scaled(
    weights: np.ndarray, threshold: float, better: float, worse: float, learner: BradleyTerry, cut: float
) -> Model:
    """The model of ``weights`` from its threshold and the median scores of both classes."""
    used = np.flatnonzero(weights)
    apart = better - worse
    scale = 6.0 / apart if apart > 0 else 1.0
    return Model(used.astype(np.int32), weights[used].astype(np.float32), threshold, scale, cut, learner.bits)


def fitted(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, learner: BradleyTerry, cut: float, level: float | None
) -> Model:
    """The ranking, and the score below which the share ``level`` of the learned rows lies
    (by default the share that is not preferred)."""
    weights = learner.fit(rows, labels)
    if not weights.any():
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0, 0.0, cut, learner.bits)
    scores = np.array([weights[x] @ v for x, v in rows])
    below = float(np.mean(labels <= 0)) if level is None else level
    threshold = float(np.quantile(scores, below, method="midpoint"))
    return scaled(
        weights, threshold, float(np.median(scores[labels > 0])), float(np.median(scores[labels <= 0])), learner, cut
    )


def mean_weights(rows: DataFrame, learner: BradleyTerry, groups: int, copies: dict[bool, int]) -> np.ndarray | None:
    """The mean of the weights learned by each of ``groups`` tasks from its share of all rows
    (label, place, x, v); None where no task met both classes.

    A row belongs to the group of its place; rows of a class with several ``copies`` also to the
    groups after it. A group that repeated ids make larger than twice its bounds is learned in
    parts.
    """

    def learn(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        labels: list[int] = []
        group, size = None, 0

        def models():
            weights = learner.fit(held, np.array(labels))
            used = np.flatnonzero(weights)
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(weights[used], 1.0))],
                    names=["feature", "weight"],
                )

        for batch in batches:
            for its, label, x, v in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True):
                if held and (its != group or len(held) >= 2 * GROUP_ROWS or size > 2 * GROUP_BYTES):
                    yield from models()
                    held, labels, size = [], [], 0
                group = its
                held.append((np.frombuffer(x, np.int32), np.frombuffer(v, np.float32)))
                labels.append(label)
                size += len(x) + len(v)
        if held:
            yield from models()

    steps = F.when(F.col("label") > 0, F.lit(copies[True])).otherwise(F.lit(copies[False]))
    member = F.transform(F.sequence(F.lit(0), steps - 1), lambda i: F.pmod(F.col("place") + i, F.lit(groups)).cast("int"))
    dealt = (
        rows.select(F.explode(member).alias("group"), "label", "place", "x", "v")
        .repartitionById(groups, F.col("group"))
        .sortWithinPartitions("group", "place", "x", "v")
    )
    # Sorted before they are added, so that the mean does not depend on the order of tasks.
    total = F.aggregate(F.sort_array(F.collect_list("weight")), F.lit(0.0), lambda a, w: a + w)
    found = park(dealt.mapInArrow(learn, "feature int, weight double")).groupBy("feature").agg(total.alias("weight"))
    table = found.toArrow()  # one row a feature
    feature, weight = (table.column(c).to_numpy() for c in ("feature", "weight"))
    if not len(feature):
        return None
    weights = np.zeros(MEASURES + (1 << learner.bits))
    weights[feature[feature >= 0]] = weight[feature >= 0]
    return weights / weight[feature < 0][0]


def values_at(scored: DataFrame, places: dict[str, Sequence[int]]) -> dict[str, list[float]]:
    """Exact values at 0-based ``places`` of the sorted ``raw``, where the column of that name
    counts the rows of a value.

    Distinct values are sorted by ranges, whose totals say in which range a place lies; only
    these ranges are sorted through.
    """
    spark, kinds = scored.sparkSession, list(places)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = park(scored.repartitionByRange(parts, "raw").withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(*[F.sum(k).alias(k) for k in kinds]).orderBy("part").collect()
    before = dict.fromkeys(kinds, 0)
    wanted = []
    for row in totals:
        for kind in kinds:
            wanted += [(kind, at, row.part, at - before[kind]) for at in places[kind] if 0 <= at - before[kind] < row[kind]]
            before[kind] += row[kind]
    order = Window.partitionBy("part").orderBy("raw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.where(F.col("part").isin(*{part for _, _, part, _ in wanted})).select(
        "part", "raw", *[F.sum(k).over(order).alias(k) for k in kinds]
    )
    found = summed.agg(
        *[F.min(F.when((F.col("part") == part) & (F.col(k) > inside), F.col("raw"))) for k, _, part, inside in wanted]
    ).first()
    known = {(k, at): value for (k, at, _, _), value in zip(wanted, found, strict=True)}
    return {k: [known[k, at] for at in places[k]] for k in kinds}


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learner: BradleyTerry = BradleyTerry(),
    cut: float = 0.7,
    level: float | None = None,
    sample_rows: int | None = None,
    sample_bytes: int | None = None,
) -> Model:
    """A ranking learned from all labelled documents.

    Features are taken on the executors and parked. Up to ``GROUP_ROWS`` rows are learned by one
    task; of more, each task learns from its share by hash, meeting documents of both classes,
    and the weights are averaged. The threshold and the scale come from the scores that all
    learned rows have by these weights. A caller may bound the rows, or the bytes of the features
    of whole documents in hash order, by ``sample_rows`` and ``sample_bytes``.

    An id with several labels has the highest; rows with a null id or label, and ids without a
    document, are not used; rows that repeat an id are all used. Without rows of both classes
    there is no pair: every score is 0.5 then.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("__label"))
        .withColumn("__order", F.xxhash64("__id"))
    )
    if sample_rows is not None:
        chosen = chosen.orderBy("__order", "__id").limit(sample_rows)
    bits = learner.bits
    none = Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0, 0.0, cut, bits)

    def extract(batches):
        for batch in portions(batches, 0):
            rows = features(plain(batch.column(0)), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([x.tobytes() for x, _ in rows], pa.binary()),
                    pa.array([v.tobytes() for _, v in rows], pa.binary()),
                ],
                names=["label", "place", "x", "v"],
            )

    # Labels grow with the documents, so they are not broadcast; each task hashes its few of them.
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        chosen.hint("shuffle_hash"), "__id"
    )
    rows = park(
        texts.select("__text", "__label", "__order").mapInArrow(extract, "label int, place long, x binary, v binary")
    )
    size = F.length("x") + F.length("v")
    if sample_bytes is not None:
        rows = _first_bytes(rows, size, sample_bytes)
    better = F.count_if(F.col("label") > 0)
    n, n_better, n_bytes = rows.agg(F.count("*"), better, F.coalesce(F.sum(size), F.lit(0))).first()
    if not 0 < n_better < n:
        return none
    groups = max(-(-n // GROUP_ROWS), -(-n_bytes // GROUP_BYTES))
    copies = {
        kind: min(groups, -(-LEAST_RIVALS * groups // count)) for kind, count in ((True, n_better), (False, n - n_better))
    }
    weights = mean_weights(rows, learner, groups, copies)
    if weights is None:
        return none
    known = docs.sparkSession.sparkContext.broadcast(weights)

    def raw(batches):
        weights = known.value
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            scores = [float(weights[np.frombuffer(x, np.int32)] @ np.frombuffer(v, np.float32)) for x, v in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["label", "raw"])

    scored = (
        rows.select("label", "x", "v").mapInArrow(raw, "label int, raw double")
        .groupBy("raw")
        .agg(F.count("*").alias("n"), better.alias("better"), F.count_if(F.col("label") <= 0).alias("worse"))
    )
    middles = {"n": (n - n_better) / n if level is None else level, "better": 0.5, "worse": 0.5}
    places = {
        kind: [int(np.floor((count - 1) * middles[kind])), int(np.ceil((count - 1) * middles[kind]))]
        for kind, count in (("n", n), ("better", n_better), ("worse", n - n_better))
    }
    found = {kind: _middle(*pair) for kind, pair in values_at(scored, places).items()}
    return scaled(weights, found["n"], found["better"], found["worse"], learner, cut)


def _first_bytes(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """The rows in hash order while their features fill ``most`` bytes, the first in any case:
    a bound its caller asked for, so one task may count it out."""
    order = Window.orderBy("place", "x", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({"__held": F.sum(size).over(order), "__nth": F.row_number().over(order)}).where(
        (F.col("__held") <= most) | (F.col("__nth") == 1)
    ).drop("__held", "__nth")


def probabilities(raw: np.ndarray, model: Model) -> np.ndarray:
    """Raw scores on the scale 0 to 1, on which the threshold is the model's ``cut``."""
    if not len(model.used):
        return np.full(len(raw), 0.5)
    shift = np.log(model.cut / (1.0 - model.cut))
    return 1.0 / (1.0 + np.exp(-np.clip(shift + (raw - model.threshold) * model.scale, -40.0, 40.0)))


def score(docs: DataFrame, model: Model, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the quality score in column ``to`` (replaced if it is there).

    The order of the scores is the ranking; texts of at least the model's ``cut`` are those above
    the learned quantile. A null or empty text has no feature and gets the score of that; texts of
    any length count whole; repeated rows get equal scores; an empty table stays empty; other
    columns pass through whatever their names.
    """
    kept = [f for f in docs.schema if f.name != to]
    names = [f.name for f in kept]
    place = names.index(text_col)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = known.value
        dense = np.zeros(MEASURES + (1 << model.bits), np.float64)
        dense[model.used] = model.weights
        for batch in portions(batches, place):
            raw = np.array([dense[x] @ v for x, v in features(plain(batch.column(place)), model.bits)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(probabilities(raw, model), pa.float64())], names=[*names, to]
            )

    schema = StructType([*kept, StructField(to, DoubleType())])
    return docs.select(*[F.col(f"`{n.replace('`', '``')}`") for n in names]).mapInArrow(run, schema)
