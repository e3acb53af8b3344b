import random
from datetime import datetime, timedelta

import pytest

from tallyspark.operators import ledger
from tallyspark.plans import incremental
from tallyspark.schemas import ACCOUNT_METADATA, BILLING_EVENTS, LEDGER_COLUMNS
from tallyspark.sources import publish, readers

KINDS = [*ledger.EVENT_TYPES, "usage_report"]


def some_events(n, seed):
    """Several events a day, accounts that pass subscriptions on, trials, rows without a key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2023, 1, 1) + timedelta(days=rng.randrange(150), hours=rng.randrange(24))
        sub = rng.choice([None, *[f"s{k}" for k in range(12)]])
        rows.append((f"e{i:04d}", sub, rng.choice([None, "a0", "a1", "a2", "a3"]), rng.choice(KINDS), at,
                     rng.randrange(5) * 100, rng.randrange(5) * 100, "p", "annual", "US", at, rng.random() < 0.1))
    return rows


def same_rows(found, want):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(r) for r in found.select(*LEDGER_COLUMNS).collect()), key=key) == sorted(
        (tuple(r) for r in want.select(*LEDGER_COLUMNS).collect()), key=key
    )


@pytest.mark.parametrize("keep", ["first", "last"])
def test_batches_in_any_order_equal_one_run(spark, frame, tmp_path, keep):
    rows = some_events(260, 3)
    random.Random(9).shuffle(rows)  # late events in every batch
    meta = frame(ACCOUNT_METADATA, ("a0", "gold", "kim", "retail", "EU", "2022-05-05"), ("a1", "basic", "lee", "tech", "US", None))
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    for part in (rows[:120], rows[120:125], rows[100:130], rows[130:]):  # one of them repeats events
        incremental.apply_batch(spark, frame(BILLING_EVENTS, *part), state, out, meta, keep)
    same_rows(readers.read_table(spark, out), ledger.mrr_ledger(frame(BILLING_EVENTS, *rows), meta, keep))


def event(i, sub, account, at, after=100):
    return (f"e{i}", sub, account, "upgrade", at, 0, after, "p", "monthly", "US", at, False)


def test_only_touched_months_are_rewritten(spark, frame, tmp_path):
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    first = [event(i, f"s{i % 3}", f"a{i % 3}", datetime(2023, 1 + i, 5)) for i in range(6)]
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *first), state, out)
    late = [event(9, "s2", "a2", datetime(2023, 4, 7), 300)]  # a2 has paid since March
    counts = incremental.apply_batch(spark, frame(BILLING_EVENTS, *late), state, out)
    assert counts["touched_periods"] == 1 and counts["changed_accounts"] == 0
    months = sorted(list(publish.latest(spark, out).writes.values()), key=len)
    assert months == [["billing_period=2023-04"], [f"billing_period=2023-0{m}" for m in (1, 2, 3, 5, 6)]]
    read = incremental._stored(spark, f"{state}/days", None, ["2023-04"])
    assert all("2023-04" in f for f in read.inputFiles()) or read.where("billing_period <> '2023-04'").count() == 0
    same_rows(readers.read_table(spark, out), ledger.mrr_ledger(frame(BILLING_EVENTS, *first, *late)))


def test_an_earlier_first_event_moves_the_cohort_of_all_months(spark, frame, tmp_path):
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    first = [event(i, "s", "a", datetime(2023, 3 + i, 5)) for i in range(3)] + [event(7, "t", "b", datetime(2023, 5, 5))]
    late = [event(9, "s", "a", datetime(2023, 1, 2))]
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *first), state, out)
    counts = incremental.apply_batch(spark, frame(BILLING_EVENTS, *late), state, out)
    assert counts["changed_accounts"] == 1 and counts["touched_periods"] == 4
    found = readers.read_table(spark, out)
    assert {r.cohort_month for r in found.where("account_id = 'a'").collect()} == {"2023-01"}
    same_rows(found, ledger.mrr_ledger(frame(BILLING_EVENTS, *first, *late)))


def test_a_batch_that_failed_can_be_repeated(spark, frame, tmp_path, monkeypatch):
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    first = [event(i, "s", "a", datetime(2023, 3 + i, 5)) for i in range(3)]
    late = [event(9, "s", "a", datetime(2023, 1, 2))]
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *first), state, out)
    real = publish.publish

    def broken(df, path, *args, **more):
        if path.endswith("accounts"):
            raise OSError("lost")
        return real(df, path, *args, **more)

    monkeypatch.setattr(publish, "publish", broken)
    with pytest.raises(OSError):
        incremental.apply_batch(spark, frame(BILLING_EVENTS, *late), state, out)
    monkeypatch.setattr(publish, "publish", real)
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *late), state, out)
    same_rows(readers.read_table(spark, out), ledger.mrr_ledger(frame(BILLING_EVENTS, *first, *late)))


def test_changed_metadata_reaches_old_months(spark, frame, tmp_path):
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    rows = [event(i, "s", "a", datetime(2023, 3 + i, 5)) for i in range(2)] + [event(5, "t", "b", datetime(2023, 4, 5))]
    old, new = (frame(ACCOUNT_METADATA, ("a", tier, "kim", "retail", "EU", None)) for tier in ("basic", "gold"))
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *rows[:2]), state, out, old)
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *rows[2:]), state, out, new)
    same_rows(readers.read_table(spark, out), ledger.mrr_ledger(frame(BILLING_EVENTS, *rows), new))


def test_rows_are_looked_up_by_account_only(spark, frame, tmp_path, monkeypatch):
    """No wide row of the days or the ledger meets a list of the batch's subscription-months."""
    state, out = str(tmp_path / "state"), str(tmp_path / "ledger")
    first = [event(i, f"s{i % 2}", "a", datetime(2023, 3 + i % 3, 5 + i)) for i in range(9)]
    late = [event(20, "s0", "a", datetime(2023, 3, 2)), event(21, "s9", "b", datetime(2023, 4, 2))]
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *first), state, out)
    kind, joined = type(spark.range(1)), []
    real = kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, how=None: joined.append(on) or real(self, other, on, how))
    incremental.apply_batch(spark, frame(BILLING_EVENTS, *late), state, out)
    assert set(map(str, joined)) == {"account_id"}
    same_rows(readers.read_table(spark, out), ledger.mrr_ledger(frame(BILLING_EVENTS, *first, *late)))
