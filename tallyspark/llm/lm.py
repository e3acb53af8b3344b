"""Language-model scoring with a weighted backoff automaton.

The corpus is read in blocks of documents. A block asks for the corpus counts of all n-grams in
its texts and adds its own training counts to the request; requests meet in buckets by n-gram
hash, which answer with the sums. With the answers each block first adds what its training texts
say of escapes, by corpus counts; then it builds the part of the automaton its texts can reach
and scores them. So counts and questions travel in one shuffle, packed, and no task ever holds
the model of the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import chained, hashed, mixed, park, plain, release, words_of

ORDER = 3
#: Bytes of text in a block and for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
#: Hashes of the end of a text and of its beginning; words hold no spaces.
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (" end", " begin"))
BINS = 48
LOW40 = np.uint64((1 << 40) - 1)


@dataclass
class Grams:
    """N-grams of a block's texts, orders 1 to ``order``.

    Texts stand one after another as begin, words, end. ``ids[k]``: for each place the index of
    its (k+1)-gram among ``keys[k]``, -1 where the text has too few tokens before. ``text``: the
    text of each place; ``predicted``: not a beginning.
    """

    ids: list[np.ndarray]
    keys: list[np.ndarray]
    counts: list[np.ndarray]
    text: np.ndarray
    predicted: np.ndarray


def distincts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and the place of each value among them."""
    order = np.argsort(values)
    ranged = values[order]
    first = np.ones(len(values), bool)
    np.not_equal(ranged[1:], ranged[:-1], out=first[1:])
    places = np.empty(len(values), np.int64)
    places[order] = np.cumsum(first) - 1
    return ranged[first], places


def grams(texts: list[str], train: np.ndarray, order: int) -> Grams:
    words, index, lengths = words_of(plain(pa.array(texts, pa.string())))
    n_words, n_texts = len(words), len(texts)
    total = len(index) + 2 * n_texts
    ends = np.cumsum(lengths + 2)
    first, last = ends - lengths - 2, ends - 1
    tokens = np.empty(total, np.int64)
    inner = np.ones(total, bool)
    inner[first] = inner[last] = False
    tokens[inner], tokens[first], tokens[last] = index, n_words, n_words + 1
    text = np.repeat(np.arange(n_texts), lengths + 2)
    hashes = np.concatenate((hashed(words), np.array([BEGIN, END], np.uint64)))
    weight = np.asarray(train, np.float64)[text]
    ids, keys = [tokens], [mixed(hashes, 1)]
    counts = [np.bincount(tokens, weights=weight, minlength=len(hashes)).astype(np.int64)]
    depth = np.arange(total) - first[text]
    for k in range(1, order):
        before = np.full(total, -1)
        before[1:] = ids[-1][:-1]
        there = (depth >= k) & (before >= 0)
        pair = before[there] * len(hashes) + tokens[there]
        distinct, inverse = distincts(pair)
        here = np.full(total, -1)
        here[there] = inverse
        ids.append(here)
        keys.append(chained(keys[-1][distinct // len(hashes)], mixed(hashes, k + 1)[distinct % len(hashes)]))
        counts.append(np.bincount(inverse, weights=weight[there], minlength=len(distinct)).astype(np.int64))
    return Grams(ids, keys, counts, text, depth > 0)


def contexts(found: Grams, k: int) -> np.ndarray:
    """For each (k+1)-gram of the block, k >= 1, the index of its first k tokens."""
    out = np.zeros(len(found.keys[k]), np.int64)
    at = np.flatnonzero(found.ids[k] >= 0)
    out[found.ids[k][at]] = found.ids[k - 1][at - 1]
    return out


def singletons(found: Grams, counts: list[np.ndarray]) -> np.ndarray:
    """By order and by magnitude of a context's count in the corpus: the block's training tokens
    after such contexts, and those of them that the corpus holds once there. A token that is
    alone in the corpus is in one block, so the sums over blocks do not depend on the blocks."""
    out = np.zeros((len(found.keys), BINS, 2), np.int64)
    for k in range(1, len(found.keys)):
        seen = found.counts[k] > 0
        bins = np.log2(counts[k - 1][contexts(found, k)[seen]]).astype(int)
        out[k, :, 0] = np.bincount(bins, weights=found.counts[k][seen], minlength=BINS)[:BINS]
        out[k, :, 1] = np.bincount(bins, weights=counts[k][seen] == 1, minlength=BINS)[:BINS]
    return out


def falling(rates: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted least-squares fit of ``rates`` that never rises (pooled neighbours)."""
    pools: list[list[float]] = []
    for rate, weight in zip(rates, weights, strict=True):
        pools.append([rate, weight, 1])
        while len(pools) > 1 and pools[-2][0] < pools[-1][0]:
            (r, w, n), (s, v, m) = pools[-2:]
            pools[-2:] = [[(r * w + s * v) / (w + v), w + v, n + m]]
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def escape_curve(histogram: np.ndarray) -> np.ndarray:
    """Probability that a context's next token is new there, by magnitude of its count.

    Leave-one-out: of a context with one token taken away, the token taken is new with the
    share of singletons. The shares of all magnitudes that occur, each weighted by its tokens,
    are fitted by a curve that never rises; beyond them it goes on as the power law of its last
    ones. Without any context of two tokens it is one half.
    """
    curve = np.full(histogram.shape[:2], 0.5)
    for k in range(1, len(histogram)):
        tokens, single = histogram[k, :, 0].astype(float), histogram[k, :, 1].astype(float)
        known = np.flatnonzero((tokens > 0) & (np.arange(BINS) >= 1))
        if not len(known):
            continue
        weight = tokens[known] + 1.0
        rate = falling((single[known] + 0.5) / weight, weight)
        log = np.interp(np.arange(BINS), known, np.log(rate))
        if len(known) > 1:
            last = slice(-4, None)
            slope = min(0.0, float(np.polyfit(known[last], np.log(rate[last]), 1, w=np.sqrt(weight[last]))[0]))
            beyond = np.arange(BINS) > known[-1]
            log[beyond] = np.log(rate[-1]) + slope * (np.arange(BINS)[beyond] - known[-1])
        curve[k] = np.clip(np.exp(log), 1e-6, 0.999)
    return curve


class Automaton:
    """Contexts of up to ``order - 1`` tokens are states; a seen n-gram is an arc that reads
    its last token with a probability; every state but the root has a failure arc to the state
    one token shorter, which reads nothing and costs the escape probability."""

    def __init__(self, found: Grams, counts: list[np.ndarray], tokens: int, kinds: int, curve: np.ndarray) -> None:
        self.known = [c > 0 for c in counts]
        first = (counts[0] + 1.0) / (tokens + kinds + 1.0)
        self.log, self.failure = [np.log10(first)], [np.zeros(len(first))]
        below = first
        for k in range(1, len(counts)):
            context = contexts(found, k)
            size = counts[k - 1][context].astype(float)
            bins = np.minimum(np.log2(np.maximum(size + 1, 1)).astype(int), BINS - 1)
            escape = np.where(size > 0, curve[k][bins], 1.0)
            below = below[self._shorter(found, k)]
            share = np.divide(counts[k], size, out=np.zeros(len(size)), where=size > 0)
            # Arcs carry the interpolated probability; where there is no arc the value is that
            # of the failure arc and what follows it.
            below = np.where(self.known[k], (1 - escape) * share, 0.0) + escape * below
            self.log.append(np.log10(below))
            self.failure.append(np.log10(escape))

    @staticmethod
    def _shorter(found: Grams, k: int) -> np.ndarray:
        """For each (k+1)-gram, the index of its last k tokens."""
        out = np.zeros(len(found.keys[k]), np.int64)
        at = np.flatnonzero(found.ids[k] >= 0)
        out[found.ids[k][at]] = found.ids[k - 1][at]
        return out

    def traverse(self, found: Grams) -> np.ndarray:
        """log10 probability of every token, read from left to right.

        Before a token the automaton is in the longest state that the tokens before it spell.
        It follows failure arcs, adding their weights, down to the first state with an arc for
        the token, adds that arc's weight, and goes to the longest state that then holds. The
        last ``order - 1`` tokens determine the state, so all places are walked side by side.
        """
        out = np.zeros(len(found.text))
        waiting = found.predicted.copy()
        for k in range(len(self.log) - 1, -1, -1):
            here = np.flatnonzero(waiting & (found.ids[k] >= 0))
            gram = found.ids[k][here]
            if k:
                state = found.ids[k - 1][here - 1]
                in_state = self.known[k - 1][state]
                reads = self.known[k][gram] & in_state
                fails = here[in_state & ~reads]
                out[fails] += self.failure[k][found.ids[k][fails]]
            else:
                reads = np.ones(len(here), bool)
            out[here[reads]] += self.log[k][gram[reads]]
            waiting[here[reads]] = False
        return out


def _packed(values: np.ndarray) -> tuple[bytes, bytes]:
    """Small counts as bytes; larger ones again as (place, value)."""
    large = np.flatnonzero(values > 254)
    small = np.minimum(values, 255).astype(np.uint8).tobytes()
    return small, np.stack((large, values[large]), 1).astype("<i8").tobytes()


def _unpacked(small: bytes, large: bytes) -> np.ndarray:
    values = np.frombuffer(small, np.uint8).astype(np.int64)
    places = np.frombuffer(large, "<i8").reshape(-1, 2)
    values[places[:, 0]] = places[:, 1]
    return values


def _layout(found: Grams, buckets: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """Keys and their order by (bucket, key): for words (whole hashes) and for longer n-grams
    (40 bits of the hash; others name the bucket)."""
    out = []
    longer = np.concatenate(found.keys[1:]) if len(found.keys) > 1 else np.zeros(0, np.uint64)
    for keys, mask in ((found.keys[0], None), (longer, LOW40)):
        bucket = (keys >> np.uint64(40)) % np.uint64(buckets)
        if mask is None:
            order = np.lexsort((keys, bucket))
            inner, bucket = keys[order], bucket[order]
        else:  # a bucket's number fits the upper 24 bits
            both = bucket << np.uint64(40) | keys & mask
            order = np.argsort(both)
            both = both[order]
            inner, bucket = both & mask, both >> np.uint64(40)
        out.append((order, inner, np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))))
    return out


REQUEST = "block int, bucket int, words binary, low binary, high binary, wn binary, wx binary, gn binary, gx binary"
REPLY = "block int, bucket int, wn binary, wx binary, gn binary, gx binary"
_KINDS = {"int": pa.int32(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _requests(texts: list[str], train: list[bool], block: int, order: int, buckets: int) -> pa.RecordBatch:
    found = grams(texts, np.array(train), order)
    (w_order, w_keys, w_cuts), (g_order, g_keys, g_cuts) = _layout(found, buckets)
    w_counts = found.counts[0][w_order]
    g_counts = np.concatenate(found.counts[1:])[g_order] if order > 1 else np.zeros(0, np.int64)
    low, high = (g_keys & np.uint64(0xFFFFFFFF)).astype("<u4"), (g_keys >> np.uint64(32)).astype(np.uint8)
    rows = []
    for b in range(buckets):
        w, g = slice(w_cuts[b], w_cuts[b + 1]), slice(g_cuts[b], g_cuts[b + 1])
        if w.stop > w.start or g.stop > g.start:
            rows.append(
                (block, b, w_keys[w].astype("<u8").tobytes(), low[g].tobytes(), high[g].tobytes(), *_packed(w_counts[w]), *_packed(g_counts[g]))
            )
    return _batch(REQUEST, rows)


def _answers(bucket: int, rows: list[dict], order: int) -> pa.RecordBatch:
    """Corpus counts for every request of a bucket, and the bucket's totals (block -1)."""
    words = [np.frombuffer(r["words"], "<u8") for r in rows]
    longer = [
        np.frombuffer(r["low"], "<u4").astype(np.uint64) | (np.frombuffer(r["high"], np.uint8).astype(np.uint64) << np.uint64(32))
        for r in rows
    ]

    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        distinct, inverse = distincts(np.concatenate(keys))
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        return distinct, total, np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1])

    known, total, w = summed(words, [_unpacked(r["wn"], r["wx"]) for r in rows])
    _, _, g = summed(longer, [_unpacked(r["gn"], r["gx"]) for r in rows])
    real = known != mixed(np.array([BEGIN]), 1)[0]
    totals = np.array([total[real].sum(), (total[real] > 0).sum()], "<i8")
    out = [(-1, bucket, totals.tobytes(), b"", b"", b"")]
    out += [(r["block"], bucket, *_packed(a), *_packed(b)) for r, a, b in zip(rows, w, g, strict=True)]
    return _batch(REPLY, out)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that follow each other with one key. A list is emptied when the next is asked for."""
    held, now = [], None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and keys[start] != now:
                yield now, held
                held.clear()
                release()
            now = int(keys[start])
            held += batch.slice(start, end - start).to_pylist()
    if held:
        yield now, held
    held.clear()
    release()


RESULT = "train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _answered(held: list[dict], order: int, buckets: int) -> tuple[list[dict], Grams, list[np.ndarray]]:
    """A block's texts, which stand before the answers to its questions, their n-grams and the
    corpus counts of these."""
    replies = [r for r in held if r["bucket"] is not None]
    own = [r for r in held if r["bucket"] is None]
    found = grams([r["text"] for r in own], np.array([r["train"] for r in own]), order)
    w_order, g_order = (part[0] for part in _layout(found, buckets))
    w, g = np.empty(len(w_order), np.int64), np.empty(len(g_order), np.int64)
    if replies:
        w[w_order] = np.concatenate([_unpacked(r["wn"], r["wx"]) for r in replies])
        g[g_order] = np.concatenate([_unpacked(r["gn"], r["gx"]) for r in replies])
    return own, found, [w, *np.split(g, np.cumsum([len(k) for k in found.keys[1:]])[:-1])] if order > 1 else [w]


def _scored(
    held: list[dict], order: int, buckets: int, tokens: int, kinds: int, curve: np.ndarray, id_col: str, id_type: pa.DataType
) -> pa.RecordBatch:
    """Scores of a block's texts. What the block builds is freed on return, before the next
    block is read."""
    own, found, counts = _answered(held, order, buckets)
    automaton = Automaton(found, counts, tokens, kinds, curve)
    logs = automaton.traverse(found)
    base = np.where(found.predicted, automaton.log[0][found.ids[0]], 0.0)
    seen = found.predicted & (counts[0][found.ids[0]] > 0)
    n = len(own)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["id"] for r in own]).cast(id_type),
            pa.array([r["train"] for r in own], pa.bool_()),
            pa.array(np.bincount(found.text, weights=found.predicted, minlength=n).astype(np.int64)),
            pa.array(np.bincount(found.text, weights=seen, minlength=n).astype(np.int64)),
            pa.array(np.full(n, tokens, np.int64)),
            pa.array(np.bincount(found.text, weights=base, minlength=n)),
            pa.array(np.bincount(found.text, weights=logs, minlength=n)),
        ],
        names=[id_col, *[f.split()[0] for f in RESULT.split(", ")]],
    )


def score(
    docs: DataFrame,
    train: Column,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model is learned from the rows where ``train`` (a condition over ``docs``; null: not)
    holds. Tokens are lower-cased words and one end for each text. ``base_score``: add-one
    unigram model; ``score``: the automaton; both log10 probabilities.

    A null or empty text is its end alone; a block holds whole texts, so one that is longer
    than a block makes a larger one; repeated rows are scored, and counted, one by one; an
    empty table gives no rows; without training rows all probabilities are those of an
    unknown token; other columns are not read. Words are told apart by 64-bit hashes, longer
    n-grams by 40 bits within their bucket.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.select(F.sum(F.octet_length(text) + 64)).collect()[0][0] or 0
    blocks, buckets = (max(1, -(-size // b)) for b in (block_bytes, bucket_bytes))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(blocks)).cast("int").alias("block"),
    )

    def ask(batches):
        for block, held in _groups(batches, "block"):
            yield _requests([r["text"] for r in held], [r["train"] for r in held], block, order, buckets)

    def answer(batches):
        for bucket, held in _groups(batches, "bucket"):
            yield _answers(bucket, held, order)

    asked = rows.drop("id").repartition("block").sortWithinPartitions("block").mapInArrow(ask, REQUEST)
    answered = park(asked.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(answer, REPLY))
    tokens = kinds = 0
    for r in answered.where("block < 0").select("wn").toLocalIterator():
        values = np.frombuffer(r.wn, "<i8")
        tokens, kinds = tokens + int(values[0]), kinds + int(values[1])
    both = rows.unionByName(answered.where("block >= 0"), allowMissingColumns=True)
    both = both.repartition("block").sortWithinPartitions("block", "bucket")

    def census(batches):
        total = np.zeros((order, BINS, 2), np.int64)
        for _, held in _groups(batches, "block"):
            total += singletons(*_answered(held, order, buckets)[1:])
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["counted"])

    histogram = np.zeros((order, BINS, 2), np.int64)
    if order > 1:
        for r in park(both.mapInArrow(census, "counted binary")).toLocalIterator():
            histogram += np.frombuffer(r.counted, "<i8").reshape(histogram.shape)
    curve = escape_curve(histogram)
    kind = docs.schema[id_col].dataType

    def evaluate(batches):
        for _, held in _groups(batches, "block"):
            yield _scored(held, order, buckets, tokens, kinds, curve, id_col, id_type)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    return both.mapInArrow(evaluate, f"`{id_col}` {kind.simpleString()}, {RESULT}")
