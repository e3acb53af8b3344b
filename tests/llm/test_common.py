import pyarrow as pa

from tallyspark.llm import common


def test_portions_are_bounded_in_rows_and_bytes():
    texts = ["x" * 10] * 5000 + ["y" * 3000] * 3 + [None, "", "z" * 90_000, "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    found = list(common.portions(iter([batch, batch.slice(0, 0)]), 1, most=40_000, rows=2000))
    assert [i for p in found for i in p.column(0).to_pylist()] == list(range(len(texts)))
    for p in found:
        size = sum(len(t or "") for t in p.column(1).to_pylist())
        assert p.num_rows <= 2000 and (size <= 40_000 or p.num_rows == 1)


def test_other_work_gives_up_what_encoders_remember():
    held = {"a": 1}
    common.CACHES.append(held)
    batch = pa.RecordBatch.from_arrays([pa.array(["a"])], names=["text"])
    assert len(list(common.portions(iter([batch]), 0, remember=True))) == 1 and held
    assert len(list(common.portions(iter([batch]), 0))) == 1 and not held
