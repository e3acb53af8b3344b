import pytest
from pyspark.sql import functions as F

from tallyspark.functions import exprs


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_money_sum_is_exact_and_ignores_null(frame):
    df = frame("a double", *[(0.1,)] * 10, (None,))
    row = df.agg(exprs.total("a").alias("s"), exprs.mean("a").alias("m")).first()
    assert row.s == 1.0 and row.m == 0.1


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -1e16])
def test_an_amount_that_does_not_fit_fails_the_sum(frame, bad):
    with pytest.raises(Exception, match="does not fit"):
        frame("a double", (1.0,), (bad,)).agg(exprs.total("a")).collect()


def test_finer_fractions_need_a_larger_scale(frame):
    df = frame("a double", *[(0.00004,)] * 3)
    assert df.agg(exprs.total("a", scale=1_000_000)).first()[0] == 0.00012


def test_mean_without_rows_is_null(frame):
    row = frame("a double", (None,)).agg(exprs.total("a").alias("s"), exprs.mean("a").alias("m")).first()
    assert row.s is None and row.m is None


def test_money_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select((F.col("id") * 0.37 + 1e6).alias("a"))
    sums = {df.repartition(n).agg(exprs.total("a")).first()[0] for n in (1, 3, 7)}
    assert len(sums) == 1


@pytest.mark.parametrize(
    "n, period", [(1995 * 12, "1995-01"), (1995 * 12 + 11, "1995-12"), (2001 * 12 + 8, "2001-09")]
)
def test_period_round_trip(spark, n, period):
    text, back = one(spark, exprs.period_text(F.lit(n)), exprs.month_number(F.lit(period)))
    assert (text, back) == (period, n)


def test_period_of(spark):
    got = one(
        spark,
        exprs.period_of(F.lit("2024-02-29").cast("date")),
        exprs.period_of(F.lit("2024-12-31 23:59:59").cast("timestamp_ntz")),
        exprs.period_of(F.lit(None).cast("date")),
    )
    assert got == ("2024-02", "2024-12", None)


def test_dollars_equal_rounded_division(spark):
    df = spark.range(0, 2_000_000, 7).select(F.col("id").alias("c"))
    assert df.filter(exprs.dollars("c") != F.round(F.col("c") / 100.0, 2)).count() == 0


def test_band_boundaries_and_null(spark):
    steps = ((3.0, "MID"), (8.0, "TOP"))
    got = one(spark, *[exprs.band(F.lit(v).cast("double"), steps, "LOW") for v in (8.0, 7.99, 3.0, 2.9, None)])
    assert got == ("TOP", "MID", "MID", "LOW", "LOW")


def test_ratio_guards(spark):
    ratio = lambda a, b: exprs.positive_ratio(F.lit(a).cast("double"), F.lit(b).cast("double"), 4)
    assert one(spark, ratio(1, 3), ratio(1, 0), ratio(1, -2), ratio(None, 2), ratio(1, None)) == (
        0.3333, None, None, None, None,
    )


def test_pct_of_base_treats_zero_as_one(spark):
    pct = lambda a, b: exprs.pct_of_base(F.lit(a).cast("double"), F.lit(b).cast("double"))
    assert one(spark, pct(5, 0), pct(5, 50), pct(None, None)) == (500.0, 10.0, None)
