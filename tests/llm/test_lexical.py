import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tallyspark.llm import lexical

from . import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, text in set(items):
        asked[i] = asked.get(i, Counter()) + Counter(terms(text))
    out = []
    for item, counts in asked.items():
        scored = []
        for i, c, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in counts.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, i is not None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_terms():
    texts = ["Ab,cD_e 1\x00é–Ü", "", "　x\x7fY", "!!"]
    array = pa.array(["skipped", *texts]).slice(1)
    words, index, counts = lexical.terms_of(array)
    listed, at = [words[i].as_py() for i in index.tolist()], 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert listed[at : at + n] == terms(text)
        at += n


def some(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([5, 5, 5, 9, 30, 80])))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 8)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("size,k", [(4, 20), (64, 3), (512, 1000)])
def test_search_against_brute_force(spark, size, k):
    docs, items = some(400, size)
    tables = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(*tables, k=k, size=size)) == brute(docs, items, k)


def test_items_in_blocks(spark):
    docs, items = some(100, 9)
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    blocks = list(lexical.item_blocks(tables[1], "item_id", "text", most=60))
    assert len(blocks) > 2 and sorted(i for b in blocks for i in b.ids) == [i for i, _ in items]
    assert found(lexical.search(*tables, item_bytes=100)) == brute(docs, items, 20)


def test_one_length_and_copies_fill_many_slices(spark):
    """All documents in one stratum, a third of them copies: equal scores by ascending id."""
    docs = [(i, "a b c" if i % 3 else f"a x{i} y") for i in range(900)]
    table, items = spark.createDataFrame(docs, "doc_id long, text string"), [(1, "a c"), (2, "x3 y y"), (3, "nowhere")]
    block = next(lexical.item_blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text"))
    rows = lexical.counted(table, block.vocabulary, "doc_id", "text")
    index = lexical.index(rows, 900, 2700, size=50)
    sizes = [r.n for r in index.where("term = -1").selectExpr("size(ids) as n").collect()]
    assert sum(sizes) == 900 and len(sizes) == 18 and max(sizes) < 100
    got = found(lexical.search(table, spark.createDataFrame(items, "item_id long, text string"), size=50))
    assert got == brute(docs, items, 20)


def test_odd_rows(spark):
    items = [(1, "the fox"), (1, "the fox"), (1, "one"), (None, "viktor über"), (2, None), (3, ""), (4, "漢字 x B"), (5, "die the " * 3000)]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as i", "2 as rank", "'x' as `my col`")
    for docs in (cases.odd(spark), cases.odd(spark, extra=False).repartition(5)):
        assert found(lexical.search(docs, table)) == brute(cases.ODD, items, 20)
    assert lexical.search(cases.empty(spark), table).count() == 0
    assert lexical.search(cases.odd(spark), table.where("false")).count() == 0


@cases.needs_data
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    from tallyspark.llm.queries import op13_lexical_search

    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet").select(i, "text").collect()]
        for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    assert found(op13_lexical_search(spark, f"/root/testdata/{sf}")) == brute(docs, items, 20)
