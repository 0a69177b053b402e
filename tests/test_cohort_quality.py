import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens import presets
from cohortlens.operators import cohort as K
from cohortlens.operators import marts, quality
from cohortlens.plans import views
from cohortlens.spec import TimeSplit

SCHEMA = ("tpep_pickup_datetime timestamp, payment_type int, PULocationID int, fare_amount double, tip_amount double, "
          "passenger_count double, VendorID int, RatecodeID int, trip_distance double, m int")
NAN = float("nan")
T19, T20 = dt.datetime(2019, 3, 2, 17), dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (T19, 1, 4, 10.0, 3.0, 2.0, 1, 1, 1.5, 1),      # kept, positive
        (T19, 1, 4, 10.0, 1.0, 0.0, None, 1, 3.0, 1),   # kept, bad passenger count, no vendor
        (T19, 2, 4, 10.0, 3.0, 2.0, 1, 1, 1.5, 1),      # not the channel
        (T19, None, 4, 10.0, 3.0, 2.0, 1, 1, 1.5, 1),   # channel unknown
        (T19, 1, 4, -5.0, 3.0, 2.0, 1, 1, 1.5, 1),      # negative fare
        (T19, 1, 4, NAN, 3.0, 2.0, 1, 1, 1.5, 2),       # NaN fare
        (T19, 1, 4, 10.0, NAN, 2.0, 1, 1, 1.5, 2),      # NaN tip
        (T19, 1, 4, 10.0, None, None, 1, None, 1.5, 2), # no tip, no count, no code
        (T20, 1, 4, 10.0, 3.0, 2.0, 1, 1, 1.5, 2),      # outside the window
        (None, 1, 4, 10.0, 3.0, 9.0, 1, 1, 1.5, 2),     # no time, count too high
        (T19, 1, None, 10.0, 3.0, 2.0, 1, 1, 1.5, 2),   # no zone
        (T19, 1, 99, 10.0, 3.0, NAN, 1, 1, 1.5, 2),     # kept, zone absent from the lookup
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(4, "Queens")], "zone_id int, pickup_borough string")


def test_flags_overlap_and_count_nulls(raw):
    got = quality.quality_flags(raw, presets.TRIP_COHORT).first().asDict()
    assert got == {
        "raw_rows": 12, "outside_window": 2, "wrong_channel": 2, "invalid_base": 2, "invalid_part": 2,
        "missing_place": 1, "missing_occupancy": 1, "invalid_occupancy": 3, "missing_vendor": 1, "missing_late_code": 1}


def test_flags_of_nothing_are_zero(raw):
    assert set(quality.quality_flags(raw.limit(0), presets.TRIP_COHORT).first()) == {0}


def test_cohort_rows_and_labels(raw, dim):
    got = K.build_cohort(raw, dim, presets.TRIP_COHORT)
    rows = {(r.pickup_borough, r.label, r.VendorID, r.passenger_count) for r in got.collect()}
    assert rows == {("Queens", 1.0, "1", 2.0), ("Queens", 0.0, "Unknown", None), ("Unknown", 1.0, "1", None)}
    one = got.first()
    assert (one.pickup_hour, one.pickup_dow, one.pickup_month, one.year_month) == ("17", "7", "3", "2019-03")


def test_predicate_reaches_the_reader(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    plan = K.eligible(spark.read.parquet(str(tmp_path / "raw")), presets.TRIP_COHORT)._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(tpep_pickup_datetime", "LessThan(tpep_pickup_datetime", "EqualTo(payment_type,1)",
                 "GreaterThan(fare_amount,0.0)", "GreaterThanOrEqual(tip_amount,0.0)"):
        assert part in pushed


def test_staged_split_prunes_partitions(spark, raw, dim, tmp_path):
    from cohortlens.sources import dimension, sinks

    sinks.write_partitioned(K.build_cohort(raw, dim, presets.TRIP_COHORT), str(tmp_path / "s"), "year_month", ["pickup_date"])
    back = dimension.read_staged(spark, str(tmp_path / "s"))
    assert dict(back.dtypes)["year_month"] == "string" and back.count() == 3
    plan = K.split_frames(back, presets.TRIP_SPLIT)["test"]._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    with pytest.raises(FileNotFoundError):
        dimension.read_staged(spark, str(tmp_path / "absent"))


def test_long_table_adds_up(raw):
    rows = quality.quality_table(raw, presets.TRIP_COHORT, "m").collect()
    table = {(r.section, r.metric, r.key): r.value for r in rows}
    assert table["overall", "raw_rows", "all"] == 12 and table["overall", "clean_rows", "all"] == 3
    assert table["month", "clean_rows", "1"] == 2 and table["month", "clean_rows", "2"] == 1
    assert len(rows) == 2 + 9 + 2


def test_leakage(spark):
    K.require_no_leakage(["hour"], presets.TRIP_FORBIDDEN)
    with pytest.raises(ValueError, match="RatecodeID"):
        K.require_no_leakage(["hour", "RatecodeID"], presets.TRIP_FORBIDDEN)


def test_weights_and_one_class_error(spark):
    f = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "label double")
    w = K.class_weights(f).first()
    assert (w.negatives, w.positives, w.w_positive) == (3, 1, 2.0) and abs(w.w_negative - 2 / 3) < 1e-12
    assert {(r.label, round(r.class_weight, 6)) for r in K.apply_weights(f, K.class_weights(f)).collect()} == {
        (1.0, 2.0), (0.0, 0.666667)}
    with pytest.raises(Exception, match="both classes"):
        K.class_weights(f.where("label = 0")).collect()


def test_split_gate_reports_empty_splits(spark):
    f = spark.createDataFrame([("2019-01", 1.0), ("2019-11", 0.0), ("2019-11", 1.0)], "year_month string, label double")
    got = {r.split: r for r in quality.split_gate(f, TimeSplit("2019-10", "2019-11"), minimum=2).collect()}
    assert (got["validation"].rows, got["validation"].non_empty) == (0, False)
    assert (got["train"].both_classes, got["test"].both_classes, got["test"].large_enough) == (False, True, True)
    with pytest.raises(ValueError, match="non_empty"):
        quality.require_gate(quality.split_gate(f, TimeSplit("2019-10", "2019-11")))


def test_profile_exact_and_sketched(raw):
    for exact in (True, False):
        got = {r.column_name: r for r in quality.column_profile(raw, ["VendorID", "m", "tpep_pickup_datetime"], exact=["VendorID", "m", "tpep_pickup_datetime"] if exact else []).collect()}
        assert got["m"].distinct_values == 2 and got["m"].missing_pct == 0
        assert got["VendorID"].family == "numeric" and abs(got["VendorID"].missing_pct - 100 / 12) < 1e-5
        assert got["tpep_pickup_datetime"].family == "datetime"


def test_exact_profile_is_count_distinct(spark):
    f = spark.createDataFrame([(1.0, "a", None), (-0.0, "b", None), (0.0, "b", None), (float("nan"), None, None), (float("nan"), "a", None), (None, "", None)], "x double, s string, e int")
    got = {r.column_name: r for r in quality.column_profile(f, exact=["x", "s", "e"]).collect()}
    assert {c: r.distinct_values for c, r in got.items()} == {"x": f.select(F.count_distinct("x")).first()[0], "s": 3, "e": 0}
    assert got["e"].missing_pct == 100 and got["x"].missing_pct == pytest.approx(100 / 6, abs=1e-5)
    mixed = {r.column_name: r.distinct_values for r in quality.column_profile(f, ["s", "x"], exact=["x"]).collect()}
    assert mixed == {"s": 3, "x": 3}
    assert {r.distinct_values for r in quality.column_profile(f.where("false"), exact=["x", "s", "e"]).collect()} == {0}
    plan = quality.column_profile(f, exact=["x", "s", "e"])._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_sketches_merge_over_periods(spark):
    f = spark.range(30_000).select((F.col("id") % 7).cast("string").alias("p"), (F.col("id") % 9000).alias("k"), F.when(F.col("id") % 2 == 0, "x").alias("c"))
    got = {r.column_name: r for r in quality.merge_sketches(quality.column_sketches(f, ["k", "c"], "p")).collect()}
    assert abs(got["k"].distinct_estimate - 9000) < 180 and got["c"].distinct_estimate == 1
    assert got["c"].missing_pct == 50 and got["k"].rows == 30_000


def test_cost_table_rules(spark):
    m = spark.createDataFrame(
        [("training", "a", "c", None, None, 36.0), ("cache", "b", "c", None, 5, 3600.0)],
        "experiment string, model string, config string, sample_fraction double, rows long, wall_seconds double")
    free = {r.experiment: r for r in marts.cost_table(m).collect()}
    assert free["training"].cost_source == "unpriced" and free["cache"].usd_estimate is None
    paid = {r.experiment: r for r in marts.cost_table(m, 2.0, "https://example.org").collect()}
    assert paid["training"].usd_estimate == 0.02 and paid["cache"].usd_estimate == 2.0
    for price, source in ((0.0, "https://x"), (1.0, "http://x")):
        with pytest.raises(ValueError):
            marts.cost_table(m, price, source)


@pytest.mark.parametrize("slices", [None, 1, 8])
def test_exact_median_with_a_hot_value(spark, slices):
    import statistics

    rows = [("odd" if i % 3 else "even", 4.0 if i % 3 == 1 else float((i * 37) % 101)) for i in range(301)] + [("odd", None), ("one", 2.5)]
    f = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r["median"]) for r in marts.exact_median(f, ["g"], "v", slices=slices).collect()}
    for g in ("odd", "even", "one"):
        vs = [v for k, v in rows if k == g and v is not None]
        assert got[g] == (len(vs), statistics.median(vs))


def test_mean_money_ignores_row_order(spark):
    f = spark.range(1000).select(F.lit("g").alias("g"), F.lit(1.0).alias("label"), (F.col("id") * 0.01 + 0.1).alias("fare"))
    means = {
        marts.group_rates(p, ["g"], measures={"m": marts.mean_money("fare")}).first().m
        for p in (f.repartition(2), f.repartition(7), f.orderBy(F.desc("fare")))}
    assert len(means) == 1


def test_many_customers_do_not_pass_through_the_driver(spark, tmp_path, monkeypatch):
    tables = {
        "events": "SELECT id AS event_id, TIMESTAMP_NTZ '2024-01-05 10:00:00' AS ts, id % 40 AS user_id, 'click' AS event_type, 60.0D AS value FROM range(100)",
        "customer": "SELECT nullif(id, 7) AS c_custkey, CAST(id % 3 AS INT) AS c_nationkey, 5.0D AS c_acctbal FROM range(30) UNION ALL SELECT 3, 1, 9.0D",
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, 0 AS n_regionkey FROM range(3)",
        "region": "SELECT 0 AS r_regionkey, 'ASIA' AS r_name",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    few = sorted(map(str, views.rides(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(views, "LOOKUP_ROWS", 30)
    many = views.rides(spark, str(tmp_path))
    assert "ShuffledHashJoin" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, many.collect())) == few and len(few) == 103
