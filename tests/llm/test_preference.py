import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import preference

from . import cases


def test_measures_by_hand():
    text = "Ab 12!\nAb 12!\nc"
    index, counts = np.array([0, 1, 0, 1, 2]), np.array([5])
    found = [float(x[0]) for x in preference.measures(pa.array([text]), index, counts)]
    assert found == pytest.approx([2 / 15, 4 / 15, 2 / 15, 2 / 5, 2 / 5, 1 / 3, 2 / 15, 5, 5 / 3, 2.0])


def test_features_are_steps_words_and_shapes():
    (none, _), (x, v), (y, w) = preference.features(pa.array(["", "Ab cd", "Ab cd Ab cd"]))
    assert not len(none)
    hashed = v[x >= preference.MEASURES]
    assert len(hashed) == 4 and np.allclose(hashed, math.sqrt(0.5))
    # Shares stay equal when the text is repeated; only measures differ.
    assert np.array_equal(x[x >= preference.MEASURES], y[y >= preference.MEASURES])


def test_pairs_meet_the_other_class():
    learner = preference.BradleyTerry(epochs=3)
    pairs = learner.pairs(5, 2)
    assert pairs.shape == (15, 2)
    for epoch in pairs.reshape(3, 5, 2):
        assert sorted(epoch[:, 0]) == [0, 1, 2, 3, 4] and set(epoch[:, 1]) == {0, 1}


def test_fit_equals_the_loss_on_dense_differences():
    """The sparse steps against dense vectors, one pair after another."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(30):
        x = np.sort(rng.choice(40, 6, replace=False)).astype(np.int32)
        rows.append((x, rng.random(6).astype(np.float32)))
        labels.append(int(3 in x))
    labels = np.array(labels)
    learner = preference.BradleyTerry(epochs=2, bits=4)
    found = learner.fit(rows, labels)
    size = len(found)
    dense = np.zeros((30, size))
    for i, (x, v) in enumerate(rows):
        dense[i, x] = v
    w, squares = np.zeros(size), np.full(size, 1e-6)
    better, worse = np.flatnonzero(labels > 0), np.flatnonzero(labels <= 0)
    for i, j in learner.pairs(len(better), len(worse)):
        a, b = dense[better[i]], dense[worse[j]]
        push = 1 / (1 + math.exp(w @ (a - b)))
        if push < 1e-3:
            continue
        touched = (a != 0) | (b != 0)
        step = np.where(touched, push * (a - b) - learner.l2 * w, 0.0)
        squares += step * step
        w += learner.rate * step / np.sqrt(squares)
    assert np.allclose(found, w, atol=1e-9)


def test_the_quantile_becomes_the_cut():
    rows = [(np.array([i % 2], np.int32), np.array([1 + i / 100], np.float32)) for i in range(40)]
    labels = np.array([i % 2 for i in range(40)])
    for level, below in ((None, 20), (0.25, 10), (0.75, 30)):
        model = preference.fitted(rows, labels, preference.BradleyTerry(bits=4), 0.7, level)
        dense = np.zeros(preference.MEASURES + 16)
        dense[model.used] = model.weights
        scores = preference.probabilities(np.array([dense[x] @ v for x, v in rows]), model)
        assert int((scores < 0.7).sum()) == below


def planted(n):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('klmnopq')}{rng.randrange(300)}" for _ in range(60)]
        if i % 5 == 0:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * 40 + words[:20]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 != 0)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = planted(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = preference.train(docs, spark.createDataFrame(labels[:600], "doc_id long, quality int"))
    found = {r.doc_id: r.score for r in preference.score(docs, model).collect()}
    assert np.mean([(found[i] >= model.cut) == bool(y) for i, y in labels[600:]]) > 0.97


def test_the_sample_is_bounded_and_repeatable(spark):
    rows, labels = planted(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    one, two = (
        preference.train(docs, t, sample_rows=100) for t in (table, table.orderBy(table.doc_id.desc()).repartition(3))
    )
    assert one.used.tolist() == two.used.tolist() and one.threshold == two.threshold
    few, more = (preference.train(docs, table, sample_bytes=b) for b in (20_000, 1 << 28))
    assert 0 < len(few.used) < len(more.used)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 1), (6, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    model = preference.train(cases.odd(spark), labels)
    rows = preference.score(cases.odd(spark), model).collect()
    assert len(rows) == len(cases.ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "")}) == 1
    assert len({r.score for r in rows if r.doc_id == 7}) == 1
    one_class = preference.train(cases.odd(spark), labels.where("quality = 1"))
    assert {r.score for r in preference.score(cases.odd(spark), one_class).collect()} == {0.5}
    assert preference.score(cases.empty(spark), model).count() == 0


def test_columns_of_any_name_pass_through(spark):
    docs = spark.sql("select 1L doc_id, 'a b' text, 2 `my col`, named_struct('a b', 1, 'c`d', 2) `meta:url`, 'x' __text, 1 label")
    model = preference.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    scored = preference.score(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    assert scored.first()[:6] == docs.first()[:6]


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op11_quality_classifier

    found = op11_quality_classifier(spark, cases.DATA).collect()
    assert {r.doc_id: r.held_out for r in found} == {
        i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in cases.documents(spark)
    }
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)


@pytest.mark.skipif(not cases.Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_query_ranks_held_out_rows(spark):
    from tallyspark.llm.queries import op11_quality_classifier

    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in op11_quality_classifier(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    good, bad = ([r.score for r in rows if labels[r.doc_id] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.93


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    """Groups of 50 rows: words that only the last rows by hash hold have weights, the threshold
    is the quantile of all rows' scores, and a rare class is met by every group."""
    rows, labels = planted(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    monkeypatch.setattr(preference, "GROUP_ROWS", 50)
    seen = []
    real = preference.mean_weights
    monkeypatch.setattr(preference, "mean_weights", lambda r, b, g, c: seen.append((r.count(), g, c)) or real(r, b, g, c))
    model, again = (preference.train(docs, t) for t in (table, table.orderBy("quality").repartition(3)))
    assert seen[0][:2] == (400, 8) and seen[0][2][False] == 8 and seen[0] == seen[1]
    assert model.used.tolist() == again.used.tolist() and model.weights.tolist() == again.weights.tolist()
    used = set(model.used.tolist())
    for x, _ in preference.features(pa.array([text for _, text in rows])):
        assert used.intersection(x[x >= preference.MEASURES].tolist())
    found = {r.doc_id: r.score for r in preference.score(docs, model).collect()}
    assert abs(sum(s < model.cut for s in found.values()) - 80) <= 1
    assert np.mean([(found[i] >= model.cut) == bool(y) for i, y in labels]) > 0.97


def test_places_of_values_are_exact(spark):
    rng = random.Random(4)
    values = [(rng.choice([rng.random(), 0.25]), rng.randrange(1, 4), rng.randrange(2)) for _ in range(200)]
    table = spark.createDataFrame(values, "raw double, n long, few long").groupBy("raw").agg(
        *[F.sum(c).alias(c) for c in ("n", "few")]
    )
    each, some = (sorted(v[0] for v in values for _ in range(v[k])) for k in (1, 2))
    places = {"n": [0, 7, len(each) - 1], "few": [3, len(some) // 2]}
    assert preference.values_at(table, places) == {
        "n": [each[i] for i in places["n"]], "few": [some[i] for i in places["few"]]
    }
