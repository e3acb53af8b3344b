import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sequential(lengths, capacity):
    """Sequences of best-fit decreasing, one document at a time."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps[gaps.index(min(fits))] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


def check(rows, found, capacity=1024):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for piece, (start, n) in enumerate(packing.cuts(len(ids), capacity)):
            want[i, piece, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(sequences) <= 1.01 * sequential([r.length for r in found], capacity) + 1


@pytest.mark.parametrize("seed", range(6))
def test_match_is_as_good_as_best_fit_decreasing(seed):
    rng, capacity = random.Random(seed), 100
    lengths = [min(capacity, int(rng.paretovariate(0.7 + 0.2 * seed) * 3)) for _ in range(3000)]
    counts = Counter(lengths)
    runs = packing.match(dict(counts), capacity)
    placed, used = Counter(), defaultdict(list)
    for length, rank, n, first, offset in runs:
        for k in range(n):
            placed[length, rank + k] += 1
            used[first + k].append((offset, length))
    assert placed == Counter({(x, k): 1 for x, n in counts.items() for k in range(n)})
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(used) <= 1.01 * sequential(lengths, capacity) + 1


def test_cuts():
    assert packing.cuts(1024, 1024) == [(0, 1024)]
    assert packing.cuts(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)]


def test_odd_rows(spark):
    check(cases.ODD, packing.pack(cases.odd(spark), PATH).collect())
    assert packing.pack(cases.empty(spark), PATH).count() == 0


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op9_packing

    check(cases.documents(spark), op9_packing(spark, cases.DATA).collect())
