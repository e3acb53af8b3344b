import pytest

from tallyspark.operators import cohort

from .conftest import by

LEDGER = (
    "subscription_id string, account_id string, billing_period string, net_new_mrr_cents bigint,"
    " cohort_month string, geo_region string"
)
DIMS = ["geo_region"]


def row(sub, account, period, net, cohort_month="2024-01", region="EU"):
    return (sub, account, period, net, cohort_month, region)


def snapshots(df, **kw):
    return by(cohort.arr_snapshots(cohort.cohort_index(df), DIMS, **kw), "account_id", "billing_period")


def test_cohort_key(frame):
    df = frame(
        "account_id string, billing_period string, first_paid_date string",
        ("a", "2024-03", None), ("a", "2024-02", None), ("b", "2024-05", "2024-01-31"),
        ("c", "2024-05", "garbage"),
    )
    got = by(cohort.cohort_key(df), "account_id", "billing_period")
    assert {k: v["cohort_month"] for k, v in got.items()} == {
        ("a", "2024-03"): "2024-02", ("a", "2024-02"): "2024-02",
        ("b", "2024-05"): "2024-01", ("c", "2024-05"): "2024-05",
    }


def test_index_drops_months_before_the_cohort(frame):
    df = frame(LEDGER, row("s", "a", "2023-12", 1), row("s", "a", "2024-01", 1), row("s", "a", "2025-02", 1))
    got = by(cohort.cohort_index(df), "billing_period")
    assert {p: r["cohort_index"] for p, r in got.items()} == {"2024-01": 0, "2025-02": 13}


def test_two_subscriptions_are_one_account_row(frame):
    df = frame(LEDGER, row("s", "a", "2024-01", 100), row("t", "a", "2024-01", 250))
    got = snapshots(df)
    assert len(got) == 1
    assert got["a", "2024-01"]["closing_arr_cents"] == 4200
    assert got["a", "2024-01"]["closing_arr_dollars"] == 42.0
    assert got["a", "2024-01"]["beginning_arr_dollars"] == 0.0


def test_silent_months_are_carried(frame):
    df = frame(LEDGER, row("s", "a", "2023-11", 100, "2023-11"), row("s", "a", "2024-02", 50, "2023-11"),
               row("u", "b", "2024-03", 10, "2024-03"))
    got = snapshots(df)
    a = {p: (r["beginning_arr_dollars"], r["closing_arr_dollars"], r["cohort_index"]) for (k, p), r in got.items() if k == "a"}
    assert a == {
        "2023-11": (0.0, 12.0, 0), "2023-12": (12.0, 12.0, 1), "2024-01": (12.0, 12.0, 2),
        "2024-02": (12.0, 18.0, 3), "2024-03": (18.0, 18.0, 4),
    }
    sparse = snapshots(df, densify=False)
    assert sorted(p for k, p in sparse if k == "a") == ["2023-11", "2024-02"]


def test_through_extends_and_never_cuts(frame):
    df = frame(LEDGER, row("s", "a", "2024-01", 100))
    assert sorted(p for _, p in snapshots(df, through="2024-03")) == ["2024-01", "2024-02", "2024-03"]
    assert sorted(p for _, p in snapshots(df, through="2023-01")) == ["2024-01"]


def test_churn_and_return(frame):
    df = frame(
        LEDGER, row("s", "a", "2024-01", 100), row("s", "a", "2024-02", -100),
        row("s", "a", "2024-05", 70), row("u", "b", "2024-06", 1),
    )
    moved = by(cohort.arr_movement(cohort.arr_snapshots(cohort.cohort_index(df), DIMS)), "account_id", "billing_period")
    labels = {p: r["arr_movement_label"] for (k, p), r in moved.items() if k == "a"}
    assert labels == {  # empty months after the churn are dropped; the return is new ARR
        "2024-01": "new_arr", "2024-02": "churned_arr", "2024-05": "new_arr", "2024-06": "retained_arr",
    }
    assert moved["a", "2024-02"]["arr_delta_dollars"] == -12.0


def test_movement_labels(frame):
    df = frame(
        "beginning_arr_dollars double, closing_arr_dollars double",
        (0.0, 0.0), (0.0, 5.0), (5.0, 0.0), (5.0, 6.1), (5.0, 4.9), (5.0, 5.0),
    )
    rows = cohort.arr_movement(df).collect()
    assert [(r.arr_movement_label, r.arr_delta_dollars) for r in rows] == [
        ("new_arr", 0.0), ("new_arr", 5.0), ("churned_arr", -5.0), ("expansion_arr", 1.1),
        ("contraction_arr", -0.1), ("retained_arr", 0.0),
    ]


def test_matrix_and_nrr(frame):
    df = frame(
        LEDGER,
        row("s", "a", "2024-01", 100), row("s", "a", "2024-02", 50),
        row("t", "b", "2024-01", 200), row("t", "b", "2024-02", -80),
        row("u", "c", "2024-01", 300), row("u", "c", "2024-02", -300),
        row("v", "d", "2024-01", 400),
        row("w", "e", "2024-02", 10, "2024-02", "US"),
    )
    got = by(cohort.build_matrix(df, DIMS), "cohort_month", "billing_period")
    first, second = got["2024-01", "2024-01"], got["2024-01", "2024-02"]
    assert first["account_count"] == 4 and first["new_arr_dollars"] == 120.0
    assert first["net_revenue_retention_rate"] is None  # no beginning ARR
    assert (second["account_count"], second["churned_account_count"]) == (4, 1)
    assert second["expansion_arr_dollars"] == 6.0
    assert second["contraction_arr_dollars"] == -9.6
    assert second["churn_arr_dollars"] == -36.0
    assert second["retained_arr_dollars"] == 48.0
    assert second["total_beginning_arr_dollars"] == 120.0
    assert second["total_closing_arr_dollars"] == 80.4
    assert second["net_revenue_retention_rate"] == 0.67
    assert got["2024-02", "2024-02"]["geo_region"] == "US"


@pytest.mark.parametrize("densify", [True, False])
def test_closing_equals_sum_of_deltas(spark, densify):
    from pyspark.sql import functions as F

    df = spark.range(400).select(
        F.concat(F.lit("s"), F.col("id") % 40).alias("subscription_id"),
        F.concat(F.lit("a"), F.col("id") % 17).alias("account_id"),
        F.concat(F.lit("2024-0"), F.pmod(F.hash("id"), F.lit(9)) + 1).alias("billing_period"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(1000)).cast("bigint").alias("net_new_mrr_cents"),
        F.lit("2024-01").alias("cohort_month"),
        F.lit("EU").alias("geo_region"),
    )
    total = df.agg(F.sum("net_new_mrr_cents")).first()[0] * 12
    last = cohort.arr_snapshots(cohort.cohort_index(df), DIMS, densify).groupBy("account_id").agg(
        F.max_by("closing_arr_cents", "billing_period").alias("c")
    )
    assert last.agg(F.sum("c")).first()[0] == total


@pytest.mark.parametrize("through", [None, "2024-12", "2024-03"])
def test_dense_matrix_equals_the_matrix_of_dense_snapshots(spark, through):
    """Random histories with zero levels, negative levels, churn, returns and zero changes."""
    from pyspark.sql import functions as F

    df = spark.range(900).select(
        F.concat(F.lit("a"), F.col("id") % 61).alias("account_id"),
        F.concat(F.lit("2024-0"), F.pmod(F.hash("id"), F.lit(9)) + 1).alias("billing_period"),
        ((F.pmod(F.hash("id", F.lit(1)), F.lit(5)) - 2) * 1033).cast("bigint").alias("net_new_mrr_cents"),
        F.concat(F.lit("2024-0"), F.col("id") % 61 % 3 + 1).alias("cohort_month"),
        F.element_at(F.array(F.lit("EU"), F.lit("US"), F.lit(None)), (F.col("id") % 61 % 3 + 1).cast("int")).alias("geo_region"),
    )
    indexed = cohort.cohort_index(df)
    slow = cohort.cohort_matrix(cohort.arr_movement(cohort.arr_snapshots(indexed, DIMS, through=through)), DIMS)
    fast = cohort.dense_matrix(indexed, DIMS, through=through)
    assert fast.columns == slow.columns and slow.count() > 15
    assert fast.exceptAll(slow).collect() == [] and slow.exceptAll(fast).collect() == []


def test_intervals_hold_no_month_without_arr(frame):
    rows = [("a", "2023-01", 100), ("a", "2023-03", -100), ("a", "2023-08", 50), ("b", "2023-02", 0), ("c", "2023-02", 10), ("c", "2023-02", -10)]
    indexed = cohort.cohort_index(
        frame("account_id string, billing_period string, net_new_mrr_cents bigint", *rows).selectExpr("*", "'2023-01' AS cohort_month")
    )
    got = {(r.account_id, r.billing_period): r.until_month - r.month for r in cohort.arr_intervals(indexed, [], "2023-12").collect()}
    assert got == {("a", "2023-01"): 2, ("a", "2023-03"): 1, ("a", "2023-08"): 5}
    snapshots = cohort.arr_snapshots(indexed, [], through="2023-12")
    assert snapshots.count() == 8 and "until_month" not in snapshots.columns
    assert snapshots.where("closing_arr_dollars = 0 AND beginning_arr_dollars = 0").count() == 0
