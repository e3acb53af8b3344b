import hashlib
import random

import numpy as np

from tallyspark.llm import fingerprint as fp

from . import cases


def plain_order_minhash(maker, text):
    """The definition, one k-mer at a time."""
    grams = maker._hashes(text).tolist()
    seen, numbered = {}, []
    for g in grams:
        seen[g] = seen.get(g, -1) + 1
        salted = fp.mixed(np.array([seen[g]], np.uint64), 5)
        numbered.append(int(fp.mixed(np.array([g], np.uint64) ^ salted)[0]))
    out = []
    for salt in maker.salts.tolist():
        draw = [(x * salt) % 2**64 for x in numbered]
        draw = [d ^ (d >> 31) for d in draw]
        least = sorted(sorted(range(len(draw)), key=lambda i: draw[i])[: maker.length])
        h = fp.mixed(np.array([numbered[least[0]]], np.uint64), 9)
        for i in least[1:]:
            h = fp.chained(h, np.array([numbered[i]], np.uint64))
        out.append(int(h[0]) >> 32)
    return out


def brute(rows):
    maker = fp.Fingerprints()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        new = text[: len(text) - cut] + following[:cut]
        a, b, c = maker.of(text), maker.of(new), maker.of(following)
        out.append(
            (doc, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.written(a), fp.written(b), (a == b).mean(), (a == c).mean())
        )
    return out


def test_equals_the_definition():
    rng, maker = random.Random(2), fp.Fingerprints(tuples=16)
    for n in (1, 2, 3, 40):
        text = " ".join(rng.choices("abcdef", k=n))
        assert maker.of(text).tolist() == plain_order_minhash(maker, text)
    long = " ".join(f"w{i % 900}" for i in range(60_000))
    assert maker.of(long).tolist() == plain_order_minhash(maker, long)


def test_order_matters_and_equal_texts_are_equal():
    maker = fp.Fingerprints()
    words = [f"w{i}" for i in range(200)]
    text = " ".join(words)
    moved = " ".join(words[100:] + words[:100])
    near = " ".join(["other", *words[1:]])
    assert (maker.of(text) == fp.Fingerprints().of(text)).all()
    assert fp.likeness(maker.of(text), maker.of(near)) > 0.9
    # Nearly the same set of pairs in another order: a set sketch would call it equal.
    assert 0.2 < fp.likeness(maker.of(text), maker.of(moved)) < 0.8
    assert fp.likeness(maker.of(""), maker.of(" ")) == 0.0 and fp.likeness(maker.of(""), maker.of("")) == 1.0


def test_odd_rows(spark):
    found = fp.neighbours(cases.odd(spark), partitions=3).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(cases.ODD), key=str)
    one = fp.neighbours(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == brute([(4, "a b c d")])
    assert fp.neighbours(cases.empty(spark)).count() == 0
    alone = fp.fingerprint(cases.odd(spark)).collect()
    texts = {w[0]: w[3] for w in brute(cases.ODD)}
    assert all(r.fingerprint == texts[r.doc_id] for r in alone)


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op8_fingerprints

    found = op8_fingerprints(spark, cases.DATA).collect()
    assert sorted(map(tuple, found)) == brute(cases.documents(spark))
    mean = lambda c: sum(r[c] for r in found) / len(found)
    assert mean("near_edited") > 0.3 > mean("near_next")
