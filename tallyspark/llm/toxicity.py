"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import chained, hashed, mixed, plain, portions, release, words_of

BITS, SAMPLE_ROWS = 20, 20_000


def features(texts: pa.Array, bits: int = BITS) -> list[np.ndarray]:
    """Distinct hashed features of each text: words without outer punctuation, pairs of
    neighbours, and pairs with one or two words between."""
    words, index, counts = words_of(texts)
    bare = [w.strip(punctuation) for w in words.to_pylist()]
    hashes = hashed(pa.array(bare, pa.string()))[index] if len(bare) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - bits)
    out, at = [], 0
    for n in counts.tolist():
        h = hashes[at : at + n]
        at += n
        grams = [mixed(h, 1)]
        for gap in (1, 2, 3):
            if n > gap:
                grams.append(mixed(chained(h[:-gap], h[gap:]), gap + 1))
        out.append(np.unique((np.concatenate(grams) >> shift).astype(np.int32)))
    return out


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates ``alpha / (beta + sqrt(sum of squared gradients))``; ``l1`` keeps
    coordinates at zero until their evidence exceeds it."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.05
    epochs: int = 3
    bits: int = BITS

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Indices and values of the weights that are not zero, and the bias."""
        size = (1 << self.bits) + 1  # the last coordinate is the bias
        z, n = np.zeros(size), np.zeros(size)
        rows = [np.append(x, size - 1) for x in rows]
        for _ in range(self.epochs):
            for x, y in zip(rows, labels.tolist(), strict=True):
                zx, nx = z[x], n[x]
                w = self._weights(zx, nx)
                w[-1] = -zx[-1] / ((self.beta + np.sqrt(nx[-1])) / self.alpha)  # no penalty on the bias
                g = sigmoid(w.sum()) - y
                root = np.sqrt(nx + g * g)
                z[x] += g - (root - np.sqrt(nx)) / self.alpha * w
                n[x] += g * g
        bias = -z[-1] / ((self.beta + np.sqrt(n[-1])) / self.alpha)
        weights = self._weights(z[:-1], n[:-1])
        used = np.flatnonzero(weights)
        return used.astype(np.int32), weights[used].astype(np.float32), float(bias)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        push = np.maximum(np.abs(z) - self.l1, 0.0)
        return -np.sign(z) * push / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    learner: Ftrl = Ftrl(),
    sample_rows: int = SAMPLE_ROWS,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights learned from at most ``sample_rows`` labelled documents, a hash sample.

    Features are taken on the executors; one task, whose input that bound limits, runs the
    sequential updates, so it alone is repeated if its executor is lost. Rows with a null id
    or label, and ids without a document, are not used; without any row the weights are empty
    and the bias 0.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("__label"))
        .withColumn("__order", F.xxhash64("__id"))
        .orderBy("__order", "__id")
        .limit(sample_rows)
    )
    bits = learner.bits

    def extract(batches):
        for batch in portions(batches, 0):
            rows = features(plain(batch.column(0)), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([x.tobytes() for x in rows], pa.binary())],
                names=["label", "place", "x"],
            )

    def learn(batches):
        rows, labels = [], []
        for batch in batches:
            rows += [np.frombuffer(x, np.int32) for x in batch.column(2).to_pylist()]
            labels += batch.column(0).to_pylist()
        used, weights, bias = learner.fit(rows, np.array(labels, np.float64))
        del rows, labels
        release()
        yield pa.RecordBatch.from_arrays(
            [pa.array([used.tobytes()]), pa.array([weights.tobytes()]), pa.array([bias])], names=["used", "weights", "bias"]
        )

    # The sample's ids are bounded by sample_rows, so they may be broadcast.
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")
    rows = sample.select("__text", "__label", "__order").mapInArrow(extract, "label int, place long, x binary")
    one = rows.repartition(1).sortWithinPartitions("place", "x")
    found = one.mapInArrow(learn, "used binary, weights binary, bias double").collect()
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0
    return np.frombuffer(found[0].used, np.int32), np.frombuffer(found[0].weights, np.float32), found[0].bias


def score(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", to: str = "score", bits: int = BITS
) -> DataFrame:
    """``docs`` with the probability of the label in column ``to`` (replaced if it is there).

    A null or empty text gets the probability of the bias; texts of any length count whole;
    repeated rows get equal scores; an empty table stays empty; other columns pass through.
    """
    fields = [f for f in docs.schema if f.name != to]
    kept = [f.name for f in fields]
    place = kept.index(text_col)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        used, weights, bias = known.value
        dense = np.zeros(1 << bits, np.float32)
        dense[used] = weights
        for batch in portions(batches, place):
            rows = features(plain(batch.column(place)), bits)
            scores = [sigmoid(bias + float(dense[x].sum(dtype=np.float64))) for x in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*kept, to])

    schema = StructType([*fields, StructField(to, DoubleType())])
    return docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in kept]).mapInArrow(run, schema)
