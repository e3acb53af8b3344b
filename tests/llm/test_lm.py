import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import lm

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [" end"]


def brute(rows, order, curve):
    """Scores by recursive interpolation over dictionaries; ``rows``: (id, text, train)."""
    counts = [Counter() for _ in range(order)]
    for _, text, train in rows:
        if train:
            seq = [" begin", *tokens(text)]
            for i in range(len(seq)):
                for k in range(order):
                    if i - k >= 0:
                        counts[k][tuple(seq[i - k : i + 1])] += 1
    words = {g: n for g, n in counts[0].items() if g != (" begin",)}
    total, kinds = sum(words.values()), len(words)

    def p(gram):
        if len(gram) == 1:
            return (words.get(gram, 0) + 1) / (total + kinds + 1)
        context, k = counts[len(gram) - 2][gram[:-1]], len(gram) - 1
        if not context:
            return p(gram[1:])
        escape = curve[k][int(math.log2(context + 1))]
        return (1 - escape) * counts[k][gram] / context + escape * p(gram[1:])

    out = []
    for doc, text, train in rows:
        seq = [" begin", *tokens(text)]
        score = sum(math.log10(p(tuple(seq[max(0, i - order + 1) : i + 1]))) for i in range(1, len(seq)))
        base = sum(math.log10(p((w,))) for w in seq[1:])
        out.append((doc, train, len(seq) - 1, sum((w,) in words for w in seq[1:]), total, base, score))
    return out


def same(found, want):
    key = lambda r: (str(r[:5]), round(r[5], 3))
    assert len(found) == len(want)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


def scored(spark, rows, order, monkeypatch, **sizes):
    kept = {}
    real = lm.escape_curve
    monkeypatch.setattr(lm, "escape_curve", lambda h: kept.setdefault("curve", real(h)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = lm.score(docs, F.col("train"), order, **sizes).collect()
    return found, brute(rows, order, kept["curve"])


def sample(spark, n):
    docs = cases.documents(spark)[:n]
    return [(i, t[:1500], zlib.crc32(str(i).encode()) % 7 != 2) for i, t in docs]


@cases.needs_data
@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force_over_many_blocks_and_buckets(spark, order, monkeypatch):
    rows = sample(spark, 60)
    rows += [(1000 + i, "the same words again and again the same words", True) for i in range(300)]
    found, want = scored(spark, rows, order, monkeypatch, block_bytes=20_000, bucket_bytes=10_000)
    same(found, want)


@cases.needs_data
def test_scores_do_not_depend_on_blocks(spark):
    docs = spark.createDataFrame(sample(spark, 120), "doc_id long, text string, train boolean")
    one, many = (
        sorted(map(tuple, lm.score(docs, F.col("train"), block_bytes=size).collect())) for size in (8 << 20, 10_000)
    )
    assert one and [r[:5] for r in one] == [r[:5] for r in many]
    assert [r[5:] for r in many] == [pytest.approx(r[5:], rel=1e-9) for r in one]


def test_odd_rows(spark, monkeypatch):
    rows = [(i, t, k % 3 != 0) for k, (i, t) in enumerate(cases.ODD)]
    found, want = scored(spark, rows, 3, monkeypatch)
    same(found, want)
    assert lm.score(cases.odd(spark), F.lit(True)).count() == len(rows)
    none = lm.score(cases.odd(spark), F.lit(None).cast("boolean")).collect()
    assert all(r.train_tokens == 0 and r.score == 0.0 for r in none)
    assert lm.score(cases.empty(spark), F.lit(True)).count() == 0


def test_probabilities_of_a_state_add_up_to_one():
    texts = ["a b a b a c", "a b b b", "c a"]
    curve = np.full((3, lm.BINS), 0.3)
    vocabulary = ["a", "b", "c", "unknown"]
    for before in (["a"], ["b", "a"], ["c", "zzz"], ["zzz"]):
        total = 0.0
        for word in [*vocabulary, None]:
            probe = " ".join(before + ([word] if word else []))
            found = lm.grams([*texts, probe], np.array([True] * 3 + [False]), 3)
            words = found.keys[0] != lm.mixed(np.array([lm.BEGIN]), 1)[0]
            n, kinds = found.counts[0][words].sum(), (found.counts[0][words] > 0).sum()
            logs = lm.Automaton(found, found.counts, int(n), int(kinds), curve).traverse(found)
            at = np.flatnonzero(found.text == 3)[1 + len(before)]
            total += 10 ** logs[at]
        assert total == pytest.approx(1.0)


def test_large_counts_survive_packing():
    values = np.array([0, 1, 254, 255, 256, 10**12])
    assert lm._unpacked(*lm._packed(values)).tolist() == values.tolist()


@cases.needs_data
def test_query_beats_the_base_on_held_out_texts(spark):
    from tallyspark.llm.queries import op1_lm_scores

    found = op1_lm_scores(spark, cases.DATA).collect()
    rows = cases.documents(spark)
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    totals = defaultdict(float)
    for r in found:
        totals[r.held_out, "base"] += r.base_score
        totals[r.held_out, "score"] += r.score
    assert totals[True, "score"] > totals[True, "base"] and totals[False, "score"] > totals[False, "base"]
    count = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(t))
    n, v = sum(count.values()), len(count)
    for i, t in rows:
        r = next(x for x in found if x.doc_id == i)
        words = tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)


def test_the_escape_curve_treats_all_sizes_alike():
    rates, weights = np.array([0.5, 0.6, 0.2, 0.3, 0.3, 0.1]), np.array([9.0, 1.0, 4.0, 4.0, 8.0, 2.0])
    fit = lm.falling(rates, weights)
    assert fit == pytest.approx([0.51, 0.51, 0.275, 0.275, 0.275, 0.1])
    counted = np.zeros((2, lm.BINS, 2), np.int64)
    counted[1, 1:9, 0], counted[1, 1:9, 1] = 64, [32, 30, 33, 20, 16, 12, 8, 4]
    small, large = lm.escape_curve(counted)[1], lm.escape_curve(counted * 1000)[1]
    assert np.abs(small - large).max() < 0.02
    for curve in (small, large):
        assert (np.diff(curve) <= 0).all() and 0 < curve[-1] < curve[8]
    assert (lm.escape_curve(np.zeros((3, lm.BINS, 2), np.int64)) == 0.5).all()
