import pytest
from pyspark.sql import Window, functions as F

from tallyspark.operators.tiles import with_tiles


def expected(df, key, metric, descending, tiles):
    order = F.col(metric).desc_nulls_first() if descending else F.col(metric).asc_nulls_first()
    return df.select(
        key, F.ntile(tiles).over(Window.orderBy(order, F.col(key).asc())).alias("want")
    )


def assert_same(df, key, metric, descending=False, tiles=5):
    got = with_tiles(df, key, {"got": (metric, descending)}, tiles).select(key, "got")
    both = got.join(expected(df, key, metric, descending, tiles), key, "full")
    assert both.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    assert both.count() == df.count()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows", [1, 2, 4, 5, 6, 11, 1003])
def test_matches_ntile(spark, rows, descending):
    df = spark.range(rows).select(F.col("id").alias("k"), F.pmod(F.hash("id"), F.lit(97)).alias("m"))
    assert_same(df, "k", "m", descending)


def test_a_third_of_the_rows_share_one_value(spark):
    other = F.pmod(F.hash("id"), F.lit(20)) + 0.25
    df = spark.range(3000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 7.5).otherwise(other).alias("m")
    )
    assert_same(df, "k", "m")
    assert_same(df, "k", "m", descending=True)


def test_all_rows_tie(spark):
    assert_same(spark.range(103).select(F.col("id").alias("k"), F.lit(1).alias("m")), "k", "m")


@pytest.mark.parametrize("descending", [False, True])
def test_null_metrics_come_first(spark, descending):
    df = spark.range(200).select(
        F.col("id").alias("k"), F.when(F.col("id") % 4 != 0, F.pmod(F.hash("id"), F.lit(9))).alias("m")
    )
    assert_same(df, "k", "m", descending)


def test_text_keys_and_decimal_metrics(spark):
    df = spark.range(500).select(
        F.concat(F.lit("C"), F.col("id")).alias("k"),
        (F.pmod(F.hash("id"), F.lit(50)) / 8).cast("decimal(18,4)").alias("m"),
    )
    assert_same(df, "k", "m")


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("m"))
    assert with_tiles(df, "k", {"s": ("m", False)}).count() == 0


def test_several_scores_and_sizes(spark):
    df = spark.range(1007).select(
        F.col("id").alias("k"), F.hash("id").alias("a"), F.pmod(F.hash("id"), F.lit(3)).alias("b")
    )
    scored = with_tiles(df, "k", {"x": ("a", True), "y": ("b", False)}, 4)
    for score in ("x", "y"):
        sizes = [r["count"] for r in scored.groupBy(score).count().orderBy(score).collect()]
        assert sizes == [252, 252, 252, 251]


def test_labelling_needs_no_shuffle(spark, capsys):
    df = spark.range(1000).select(F.col("id").alias("k"), F.hash("id").alias("m"))
    with_tiles(df, "k", {"s": ("m", False)}).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Window" not in plan
