import math

from pyspark.sql import functions as F

from cohortlens.functions import columns as C


def _values(frame, column):
    return [r[0] for r in frame.select(column).collect()]


def test_good_number_and_failed(spark):
    rows = [(1.0,), (0.0,), (-1.0,), (float("nan"),), (None,)]
    f = spark.createDataFrame(rows, "v double")
    assert _values(f, C.failed(C.is_good_number("v", strict=True))) == [False, True, True, True, True]
    assert _values(f, C.failed(C.is_good_number("v"))) == [False, False, True, True, True]


def test_ratio_label_zero_base_is_null(spark):
    f = spark.createDataFrame([(3.0, 2.0), (0.1, 2.0), (1.0, 0.0), (None, 1.0)], "p double, b double")
    assert _values(f, C.ratio_label("p", "b", 0.2)) == [1.0, 0.0, None, None]


def test_within_or_null(spark):
    f = spark.createDataFrame([(0.0,), (1.0,), (8.0,), (9.0,), (None,), (float("nan"),)], "v double")
    assert _values(f, C.within_or_null("v", 1, 8)) == [None, 1.0, 8.0, None, None, None]


def test_distance_band_edges(spark):
    rows = [(-1.0,), (1.99,), (2.0,), (5.0,), (200.0,), (200.1,), (None,), (float("nan"),)]
    f = spark.createDataFrame(rows, "v double")
    assert _values(f, C.distance_band("v")) == [
        "0-2 miles", "0-2 miles", "2-5 miles", "5-200 miles", "5-200 miles", *["unknown/outlier"] * 3]


def test_score_bucket_clamps_and_collapses(spark):
    f = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "s double")
    got = _values(f, C.score_bucket(F.col("s"), F.lit(0.0), F.lit(1.0), 10))
    assert got == [0, 5, 9]
    assert _values(f, C.score_bucket(F.col("s"), F.lit(0.3), F.lit(0.3), 10)) == [0, 0, 0]


def test_shift_cycle_wraps(spark):
    f = spark.createDataFrame([("23",), ("8",)], "h string")
    assert _values(f, C.shift_cycle("h", 24)) == ["0", "9"]


def test_day_fold_keeps_days_together(spark):
    f = spark.range(500).select(F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id)").alias("t"))
    for hashed in (True, False):
        folds = f.select(F.to_date("t").alias("d"), C.day_fold("t", 3, hashed=hashed).alias("k"))
        assert folds.groupBy("d").agg(F.count_distinct("k").alias("n")).where("n > 1").count() == 0
        assert {r.k for r in folds.select("k").distinct().collect()} == {0, 1, 2}


def test_draws_do_not_depend_on_partitions(spark):
    a = spark.range(0, 1000, 1, 2).select("id", C.hash_draw("id", seed=5).alias("u"))
    b = spark.range(0, 1000, 1, 7).select("id", C.hash_draw("id", seed=5).alias("u"))
    assert sorted(a.collect()) == sorted(b.collect())
    us = [r.u for r in a.collect()]
    assert 0 <= min(us) and max(us) < 1 and abs(sum(us) / 1000 - 0.5) < 0.05


def test_poisson_weight_has_unit_mean(spark):
    u = spark.range(20000).select(C.poisson_weight(C.hash_draw("id", seed=1)).alias("w"))
    mean, zero = u.agg(F.avg("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert abs(mean - 1) < 0.03 and abs(zero - math.exp(-1)) < 0.02
