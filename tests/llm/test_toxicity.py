import math
import random
import zlib

import numpy as np
import pyarrow as pa

from tallyspark.llm import toxicity

from . import cases


def test_features_are_words_pairs_and_skips():
    one, two, three = toxicity.features(pa.array(["a b", "A, b.", ""]))
    assert one.tolist() == two.tolist() and len(one) == 3 and not len(three)
    assert len(toxicity.features(pa.array(["a b c d e"]))[0]) == 5 + 4 + 3 + 2


def test_ftrl_equals_one_coordinate_at_a_time():
    rng = random.Random(4)
    rows = [np.array(sorted(rng.sample(range(16), 4)), np.int32) for _ in range(60)]
    labels = np.array([int(3 in x.tolist()) for x in rows], float)
    f = toxicity.Ftrl(l1=0.2, epochs=2, bits=4)
    used, weights, bias = f.fit(rows, labels)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        l1, l2 = (f.l1, f.l2) if i < 16 else (0.0, 0.0)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((f.beta + math.sqrt(n[i])) / f.alpha + l2)

    for _ in range(f.epochs):
        for x, y in zip(rows, labels):
            x = [*x.tolist(), 16]
            w = [weight(i) for i in x]
            g = 1 / (1 + math.exp(-sum(w))) - y
            for i, wi in zip(x, w):
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / f.alpha * wi
                n[i] += g * g
    assert abs(bias - weight(16)) < 1e-9
    assert dict(zip(used.tolist(), np.round(weights, 5).tolist())) == {
        i: round(np.float32(weight(i)).item(), 5) for i in range(16) if weight(i)
    } or np.allclose(weights, [weight(i) for i in used.tolist()], atol=1e-5)


def planted(n):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words, bad = [f"w{rng.randrange(300)}" for _ in range(30)], i % 4 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["vile", "Rotten,"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = planted(1200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels[:800], "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    right = [(found[i] >= 0.5) == bool(y) for i, y in labels[800:]]
    assert np.mean(right) > 0.98 and len(model[0]) < 2000


def test_the_sample_is_bounded_and_repeatable(spark):
    rows, labels = planted(400)
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    one, two = (toxicity.train(docs, t, sample_rows=100) for t in (table, table.orderBy(table.doc_id.desc())))
    assert one[0].tolist() == two[0].tolist() and one[2] == two[2]


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 1), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(cases.odd(spark), labels)
    scored = toxicity.score(cases.odd(spark), model)
    rows = scored.collect()
    assert len(rows) == len(cases.ODD) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if not (r.text or "").split()}
    assert len(blank) == 1
    nothing = toxicity.train(cases.odd(spark), labels.where("doc_id > 1000"))
    assert {r.score for r in toxicity.score(cases.odd(spark), nothing).collect()} == {0.5}
    assert toxicity.score(cases.empty(spark), model).count() == 0


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op6_toxicity

    found = op6_toxicity(spark, cases.DATA).collect()
    assert {r.doc_id: r.held_out for r in found} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in cases.documents(spark)
    }
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_columns_of_any_name_pass_through(spark):
    docs = spark.sql("select 1L doc_id, 'a b' text, 2 `my col`, named_struct('a b', 1, 'c`d', 2) `meta:url`, 'x' __text")
    scored = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")))
    assert scored.columns == [*docs.columns, "score"] and scored.first()[:5] == docs.first()[:5]
