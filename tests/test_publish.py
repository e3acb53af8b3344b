import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.sources import files, history, publish, readers, writers

from .conftest import by

ROWS = "day string, seg string, v int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def failing(frame, *more):
    """Fails when one of its rows is computed."""
    df = frame(ROWS, *[("d1", "a", i) for i in range(5)], *more).repartition(2)
    bad = F.raise_error(F.lit("broken on the way")).cast("int")
    return df.withColumn("v", F.when(F.col("v") == 3, bad).otherwise(F.col("v")))


@pytest.mark.parametrize("parts", [[], ["day"], ["day", "seg"]])
def test_a_failed_write_leaves_the_former_version(spark, frame, tmp_path, parts):
    path = str(tmp_path / "t")
    first = frame(ROWS, ("d1", "a", 1), ("d2", "b", 2))
    publish.publish(first, path, parts)
    for replace in publish.REPLACE:
        with pytest.raises(Exception, match="broken on the way"):
            publish.publish(failing(frame), path, parts, replace)
        assert rows(publish.read(spark, path)) == rows(first) and publish.numbers(spark, path) == [1]


def test_a_fault_between_writing_and_committing_publishes_nothing(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.publish(frame(ROWS, ("d1", "a", 1)), path)
    monkeypatch.setattr(files, "create", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError):
        publish.publish(frame(ROWS, ("d1", "a", 2)), path)
    assert rows(publish.read(spark, path)) == [("d1", "a", 1)]


def test_versions_replace_partitions_or_add(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(frame(ROWS, ("d1", "a", 1), ("d2", "a", 2), ("d2", "b c:é", 3)), path, ["day", "seg"])
    publish.publish(frame(ROWS, ("d2", "b c:é", 30), ("d3", "a+b%", 4)), path, ["day", "seg"], "partitions", run_id="r")
    assert rows(publish.read(spark, path)) == [("d1", "a", 1), ("d2", "a", 2), ("d2", "b c:é", 30), ("d3", "a+b%", 4)]
    publish.publish(frame(ROWS, ("d1", "a", 1)), path, ["day", "seg"], "nothing")
    assert publish.read(spark, path).where("day = 'd1'").count() == 2
    assert publish.read(spark, path, run_id="r").count() == 4 and publish.read(spark, path, number=1).count() == 3
    assert [r.row_count for r in publish.history(spark, path).orderBy("number").collect()] == [3, 2, 1]
    with pytest.raises(ValueError, match="columns"):
        publish.publish(frame("day string, seg string, w int", ("d1", "a", 1)), path, ["day", "seg"], "partitions")
    publish.publish(frame("x int", (1,)), path)
    assert publish.read(spark, path).columns == ["x"]


def test_types_and_column_order_come_back(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select '2024-01' period, 1.5d a, null n, timestamp'2024-01-01 10:00:00' t, array(1, null) l, 2 last").drop("n")
    publish.publish(df, path, ["period"])
    back = publish.read(spark, path)
    assert back.dtypes == df.dtypes and back.first() == df.first()
    publish.publish(df.where("false"), path, ["period"])
    assert publish.read(spark, path).dtypes == df.dtypes and publish.read(spark, path).count() == 0


def test_of_two_writers_one_wins(spark, frame, tmp_path, monkeypatch):
    """The second commits while the first is still writing."""
    path = str(tmp_path / "t")
    publish.publish(frame(ROWS, ("d0", "a", 0)), path)
    real, inner = publish.stage, frame(ROWS, ("d0", "a", 1))

    def slow(df, *args):
        monkeypatch.setattr(publish, "stage", real)
        publish.publish(inner, path)
        return real(df, *args)

    monkeypatch.setattr(publish, "stage", slow)
    with pytest.raises(publish.Conflict):
        publish.publish(frame(ROWS, ("d0", "a", 2)), path)
    assert rows(publish.read(spark, path)) == [("d0", "a", 1)]
    monkeypatch.setattr(publish, "stage", slow)
    publish.publish(frame(ROWS, ("d0", "a", 3)), path, replace="nothing")  # added to the other's version
    assert rows(publish.read(spark, path)) == [("d0", "a", 1), ("d0", "a", 3)]


def test_a_name_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    (tmp_path / "log").mkdir()
    files.create(spark, path, "{é}")
    with pytest.raises(FileExistsError):
        files.create(spark, path, "other")
    assert files.read_text(spark, path) == "{é}"
    assert set(files.modified(spark, str(tmp_path / "log"))) == {"1.json"}


def test_damage_is_found_level_by_level(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(frame(ROWS, *[(f"d{i % 3}", "a", i) for i in range(30)]).coalesce(1), path, ["day"])
    assert publish.damage(spark, path).count() == 0
    other = tmp_path / "other"
    frame("seg string, v int", ("a", 99)).coalesce(1).write.parquet(str(other))
    part = next(iter(sorted((tmp_path / "t" / "data").glob("write=*/day=d1/*.parquet"))))
    part.write_bytes(next(other.glob("*.parquet")).read_bytes())
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    lost = next(iter((tmp_path / "t" / "data").glob("write=*/day=d2/*.parquet")))
    lost.unlink()
    found = publish.damage(spark, path).collect()
    assert [r.level for r in found] == ["table", "partition", "partition", "file", "file"]
    status = {r.name: r.status for r in found}
    assert status["day=d1"] == "changed" and status["day=d2"] == "missing" and "day=d0" not in status
    assert any(n.endswith(part.name) and s == "changed" for n, s in status.items())


def test_a_table_that_was_not_stored_as_meant_is_not_published(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(quality.GateFailed, match="stored_as_meant"):
        publish.publish(frame(ROWS, ("", "a", 1)), path, ["day"])  # Spark stores an empty value as NULL
    assert not publish.is_published(spark, path)


def test_old_versions_go_when_told(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        publish.publish(frame(ROWS, ("d1", "a", i), (f"e{i}", "a", i)), path, ["day"], "partitions")
    with pytest.raises(Exception):
        publish.publish(failing(frame), path, ["day"])
    assert publish.drop_versions(spark, path, keep=2, abandoned_after=3600) == []  # all are still referred to
    publish.publish(frame(ROWS, ("z", "a", 9)), path, ["day"])
    assert len(publish.drop_versions(spark, path, abandoned_after=0)) == 5
    assert rows(publish.read(spark, path)) == [("z", "a", 9)] and publish.numbers(spark, path) == [5]
    with pytest.raises(ValueError):
        publish.drop_versions(spark, path, keep=0)


def test_snapshot_table_survives_a_failing_rewrite(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setitem(writers.TABLES, "snap", writers.Table(["day", "seg", "v"], ["seg"], snapshot=True))
    path = str(tmp_path / "t")
    writers.write_table(frame(ROWS, ("d1", "a", 1), ("d1", "b", 2)), "snap", path)
    with pytest.raises(Exception, match="broken"):
        writers.write_table(failing(frame), "snap", path)
    assert readers.read_table(spark, path).count() == 2


def test_history_of_runs_and_gate_on_the_change(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert history.read(spark, path).count() == 0
    assert history.check_change(spark, path, "load", {"rows": 0.5})
    for i, (run, value) in enumerate((("r1", 100.0), ("r2", 120.0), ("r10", 30.0))):
        history.record(spark, path, "load", run, {"rows": value, "empty": 0.0}, datetime(2024, 1, i + 1))
    history.record(spark, path, "other", "r1", {"rows": 7}, datetime(2024, 1, 9))
    got = by(history.changes(history.read(spark, path), limit=0.5), "job", "metric", "run_id")
    assert got["load", "rows", "r2"]["change"] == 0.2 and not got["load", "rows", "r2"]["breach"]
    assert got["load", "rows", "r10"]["change"] == -0.75 and got["load", "rows", "r10"]["breach"]
    assert got["load", "empty", "r2"]["change"] is None and got["other", "rows", "r1"]["previous"] is None
    with pytest.raises(quality.GateFailed, match="rows_change"):
        history.check_change(spark, path, "load", {"rows": 0.5})
    assert not history.check_change(spark, path, "load", {"rows": 0.5}, on_fail="warn")


def test_the_log_is_plain_text(spark, frame, tmp_path):
    path = tmp_path / "t"
    made = publish.publish(frame(ROWS, ("d1", "a", 1)), str(path), metrics={"total": 1.0})
    logged = json.loads((path / "log" / f"{1:020d}.json").read_text())
    assert logged["metrics"] == {"total": 1.0} and logged["row_count"] == made.row_count == 1


def test_names_of_files_are_worked_out_once_a_file(spark, tmp_path):
    path = str(tmp_path / "t")
    made = publish.publish(spark.sql("SELECT id, id % 2 AS part FROM range(40)"), path, ["part"])
    write = next(iter(made.writes))
    nodes = publish._file_nodes(publish._load(spark, path, made.struct, {write: [""]}), write)
    plan = nodes._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "url_decode" not in plan[plan.index("Aggregate") :]
    assert {r.partition for r in nodes.collect()} == {"part=0", "part=1"}
    assert sum(r.row_count for r in nodes.collect()) == 40
