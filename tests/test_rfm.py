from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import rfm
from tallyspark.plans.jobs import segment_customers

from .conftest import by

ORDERS = "order_id string, customer_id string, order_date date, status string, total_amount double"


@pytest.fixture
def orders(frame):
    d = date.fromisoformat
    return frame(
        ORDERS,
        ("1", "a", d("2023-01-01"), "COMPLETED", 10.0),
        ("2", "a", d("2023-05-09"), "SHIPPED", 30.0),  # 128 days later
        ("3", "b", d("2023-06-01"), "DELIVERED", 5.0),
        ("4", "c", d("2023-03-01"), "COMPLETED", 7.0),
        ("5", "c", d("2023-03-01"), "COMPLETED", 7.0),  # same day
        ("5", "c", d("2023-03-01"), "COMPLETED", 1.0),  # the same order again
        ("6", "d", d("2023-12-31"), "CANCELLED", 999.0),
        ("7", "d", d("2023-12-31"), "completed", 999.0),
        ("8", "e", None, "COMPLETED", None),
    )


def test_only_paid_statuses_in_exact_case(orders):
    assert {r.order_id for r in rfm.paid_orders(orders).collect()} == {"1", "2", "3", "4", "5", "8"}


def test_customer_totals(orders):
    got = by(rfm.with_recency(rfm.customer_totals(rfm.paid_orders(orders))), "customer_id")
    a, b, c, e = (got[k] for k in "abce")
    assert (a["order_count"], a["monetary_value"], a["avg_order_value"]) == (2, 40.0, 20.0)
    assert a["stddev_order_value"] == pytest.approx(14.142135623)
    assert (a["recency_days"], b["recency_days"]) == (23, 0)
    assert c["order_count"] == 2 and c["monetary_value"] == 15.0
    assert b["stddev_order_value"] is None
    assert e["recency_days"] is None and e["monetary_value"] is None and e["order_count"] == 1
    assert "d" not in got


def test_unique_orders_option_counts_rows(orders):
    got = by(rfm.customer_totals(orders.filter("customer_id = 'a'"), orders_are_unique=True), "customer_id")
    assert got["a"]["order_count"] == 2


@pytest.mark.parametrize("as_of", ["2023-06-11", date(2023, 6, 11)])
def test_as_of_replaces_the_latest_order(orders, as_of):
    got = by(rfm.with_recency(rfm.customer_totals(rfm.paid_orders(orders)), as_of), "customer_id")
    assert got["b"]["recency_days"] == 10


def test_velocity(orders, frame):
    totals = rfm.customer_totals(rfm.paid_orders(orders))
    got = by(totals.select("customer_id", rfm.purchase_velocity().alias("v")), "customer_id")
    assert got["a"]["v"] == 0.007812  # 1/128, half to even
    assert got["b"]["v"] == 0.0  # single order
    assert got["c"]["v"] == 0.0  # gap under a day
    assert got["e"]["v"] is None  # no dates
    d = date.fromisoformat
    wide = frame("first_order_date date, last_order_date date, order_count bigint",
                 (d("2023-01-01"), d("2023-01-12"), 4))
    assert wide.select(rfm.purchase_velocity()).first()[0] == 0.333333  # 11 // 3 = 3 days


def test_scores_five_is_best(spark):
    metrics = spark.range(10).select(
        F.col("id").alias("customer_id"),
        F.col("id").cast("int").alias("recency_days"),
        F.col("id").alias("order_count"),
        (F.col("id") * 10.0).alias("monetary_value"),
    )
    got = by(rfm.with_quintiles(metrics), "customer_id")
    assert [got[i]["r_score"] for i in range(10)] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [got[i]["f_score"] for i in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [got[i]["m_score"] for i in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


@pytest.mark.parametrize(
    "r, f, m, composite, label",
    [
        (5, 5, 5, 5.0, "Champions"),
        (5, 5, 4, 4.65, "Champions"),
        (4, 4, 4, 4.0, "Loyal"),
        (3, 4, 3, 3.35, "At-Risk"),
        (2, 2, 2, 2.0, "Lost"),
        (1, 1, 2, 1.35, "New"),
    ],
)
def test_composite_and_label(frame, r, f, m, composite, label):
    row = rfm.with_segment(frame("r_score int, f_score int, m_score int", (r, f, m))).first()
    assert (row.rfm_composite, row.rfm_cell, row.rfm_segment) == (composite, f"{r}-{f}-{m}", label)


def test_weights_must_sum_to_one(frame):
    scored = frame("r_score int, f_score int, m_score int", (1, 1, 1))
    with pytest.raises(ValueError, match="sum to 1"):
        rfm.with_segment(scored, (0.5, 0.5, 0.1))
    assert rfm.with_segment(scored, (0.2, 0.3, 0.5)).first().rfm_composite == 1.0


def test_customer_without_orders_gets_defaults(orders, frame):
    customers = frame("customer_id string, country string", *[(k, "X") for k in "abcdz"])
    got = by(segment_customers(orders, customers), "customer_id")
    assert set(got) == set("abcdz")
    z = got["z"]
    assert (z["recency_days"], z["order_count"], z["rfm_cell"], z["rfm_segment"]) == (999, 0, "1-1-1", "New")
    assert z["first_order_date"] is None and z["stddev_order_value"] is None
    assert z["is_high_value"] is False and z["ltv_estimate"] == 0.0
    assert z["churn_risk_score"] == round(5 - 1 + 999 / 365 * 0.5, 4)
    assert got["d"]["order_count"] == 0  # only unpaid orders


def test_derived_scores(frame):
    segments = frame(
        "customer_id string, recency_days int, order_count bigint, monetary_value double,"
        " avg_order_value double, r_score int, f_score int, m_score int, rfm_composite double,"
        " rfm_cell string, rfm_segment string, purchase_velocity double",
        ("a", 73, 2, 100.0, 50.0, 4, 4, 4, 4.0, "4-4-4", "Loyal", 0.1),
    )
    row = rfm.enrich_customers(frame("customer_id string", ("a",)), segments).first()
    assert row.is_high_value is True
    assert row.churn_risk_score == 1.1  # 5 - 4 + 73/365/2
    assert row.ltv_estimate == 96.0  # 100 * 4/5 * 1.2


def test_distribution_and_gate(frame):
    enriched = frame(
        "rfm_segment string, monetary_value double, rfm_composite double, churn_risk_score double,"
        " ltv_estimate double",
        ("Loyal", 10.0, 4.0, 1.0, 5.0), ("Loyal", 20.0, 3.5, 2.0, -1.0), ("New", 1.0, 1.0, 4.0, 0.0),
        (None, 1.0, 0.5, 4.0, 0.0),
    )
    rows = rfm.segment_distribution(enriched).collect()
    assert [r.rfm_segment for r in rows] == ["Loyal", "New", None]
    assert (rows[0].customer_count, rows[0].avg_monetary, rows[0].avg_rfm_score) == (2, 15.0, 3.75)
    assert tuple(enriched.agg(*rfm.gate_metrics()).first()) == (4, 1, 1)
