import corpus_pipeline as pipeline
from tallyspark.llm import packing

from . import cases
from .test_near import brute as near_brute
from .test_packing import check as packing_check
from .test_quality import brute as quality_brute
from .test_spans import brute as spans_brute


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


@cases.needs_data
def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{cases.DATA}/documents.parquet")
    start = docs
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality", "near_dedup", "substring_dedup", "packing"]

    calm = pipeline.park(stages["toxicity"](spark, docs, cases.DATA))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{cases.DATA}/labels.parquet").collect()}
    gone = {i for i, _ in rows_of(start)} - {i for i, _ in rows_of(calm)}
    assert gone and sum(labels.get(i, 1) for i in gone) >= 0.9 * len(gone)

    good = pipeline.park(stages["quality"](spark, calm, cases.DATA))
    kept = set(rows_of(good))
    assert not any(quality_brute(t)[-1] for _, t in kept)
    assert {r for r in rows_of(calm) if not quality_brute(r[1])[-1]} >= kept

    single = pipeline.park(stages["near_dedup"](spark, good, cases.DATA))
    verdict = near_brute(rows_of(good), 5, 80)
    assert [i for i, _ in rows_of(single)] == sorted(r[0] for r in verdict if r[3])

    clean = pipeline.park(stages["substring_dedup"](spark, single, cases.DATA))
    want = spans_brute(rows_of(single))
    assert rows_of(clean) == sorted((i, t) for i, _, t in want if t)
    assert all(r.n_chars == len(r.text) for r in clean.collect())

    for stage in (calm, good, single, clean):
        assert stage.columns == docs.columns

    packed = stages["packing"](spark, clean, cases.DATA)
    packing_check(rows_of(clean), packed.collect())

    whole = pipeline.run(spark, cases.DATA)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, packed.collect()))


def test_odd_rows_pass_every_filter(spark):
    docs = cases.odd(spark, extra=False)
    for name, stage in pipeline.STAGES[1:]:
        assert stage(spark, docs, cases.DATA).count() >= 0, name
    assert packing.pack(docs, pipeline.TOKENIZER).count() > 0


def test_only_texts_emptied_by_the_stage_go(spark):
    docs = cases.odd(spark, extra=False)
    left = dict(pipeline.STAGES)["substring_dedup"](spark, docs, cases.DATA).collect()
    assert {1: None, 2: ""}.items() <= {r.doc_id: r.text for r in left}.items()
    assert sorted(str(r.doc_id) for r in left) == sorted([*(str(i) for i, _ in cases.ODD if i not in (7, 9)), "7"])
