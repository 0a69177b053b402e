"""All four stages over small monthly files whose schemas drift."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens import presets
from cohortlens.plans import stages


TINY = {"LogisticRegression": [{"regParam": 0.1}], "RandomForestClassifier": [{"numTrees": 2, "maxDepth": 3}],
        "MultilayerPerceptronClassifier": [{"maxIter": 3}], "GBTClassifier": [{"maxDepth": 3, "maxIter": 3}]}


def _month(spark, folder, month, rows, *, drop=(), rename=None):
    start = dt.datetime(2019, month, 1)
    data = []
    for i in range(rows):
        high = i % 4 in (0, 1)
        data.append((
            start + dt.timedelta(hours=7 * i % 640), 1 if i % 10 else 2, 1 + i % 2, 10.0 + i % 7,
            (3.0 if high else 1.0) * (10.0 + i % 7) / 10, float(1 + i % 3), 1 + i % 4, 1.0 + i % 9, 1))
    names = ["tpep_pickup_datetime", "payment_type", "PULocationID", "fare_amount", "tip_amount",
             "passenger_count", "VendorID", "trip_distance", "RatecodeID"]
    frame = spark.createDataFrame(data, names).drop(*drop)
    for old, new in (rename or {}).items():
        frame = frame.withColumnRenamed(old, new)
    frame.coalesce(1).write.parquet(f"{folder}/_m{month}")
    import glob
    import os

    part = glob.glob(f"{folder}/_m{month}/part-*.parquet")[0]
    os.rename(part, f"{folder}/trips-{month:02d}.parquet")


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    _month(spark, folder, 1, 200)
    _month(spark, folder, 10, 120, drop=("RatecodeID",))
    _month(spark, folder, 11, 150, rename={"VendorID": "vendorid"})
    lookup = tmp_path_factory.mktemp("dim") / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone\n1,Queens,a\n1,Queens,dup\nx,Nowhere,b\n")
    made = stages.Job(work=str(tmp_path_factory.mktemp("work")), grids=TINY, folds=2, parallelism=1, tuning_fraction=1.0, minimum_group=1,
                      background_rows=60, explain_samples=64, perturbed_fraction=0.4)
    stages.ingest(
        spark, made, str(folder), str(lookup), expected=[f"trips-{m:02d}.parquet" for m in (1, 10, 11)],
        period_pattern=r"trips-(\d+)", key="LocationID", value="Borough", min_rows=400, min_columns=8, min_bytes=1000)
    return made, str(folder), str(lookup)


def test_ingest(spark, job):
    made, folder, lookup = job
    fact = stages.staged(spark, made)
    assert set(fact.columns) == {
        "label", "pickup_borough", "VendorID", "RatecodeID", "passenger_count", "pickup_hour", "pickup_dow",
        "pickup_month", "pickup_month_sin", "pickup_month_cos", "pickup_date", "year_month", "PULocationID",
        "trip_distance", "fare_amount", "tip_amount"}
    assert fact.count() == 423  # one row in ten is not paid by card
    assert {r[0] for r in fact.select("pickup_borough").distinct().collect()} == {"Queens", "Unknown"}
    late = fact.where("year_month = '2019-10'").select("RatecodeID").distinct().collect()
    assert [r[0] for r in late] == ["Unknown"]
    table = {(r.section, r.metric, r.key): r.value for r in spark.read.parquet(made.at("tables", "quality")).collect()}
    assert table["overall", "raw_rows", "all"] == 470
    assert table["quality_nonexclusive", "wrong_channel", "all"] == 47
    assert table["quality_nonexclusive", "missing_late_code", "all"] == 120
    assert table["month", "clean_rows", "2019-10"] == 108
    assert table["overall", "source_bytes", "all"] > 1000
    with pytest.raises(FileNotFoundError, match="trips-12"):
        stages.ingest(spark, made, folder, lookup, expected=["trips-12.parquet"], period_pattern=r"(\d+)",
                      key="LocationID", value="Borough")


def test_train_assess_publish(spark, job):
    made, _, _ = job
    metrics = stages.train(spark, made)
    rows = metrics.collect()
    assert len(rows) == 4 and {r.rows for r in rows} == {135}
    assert all(r.tp + r.fp + r.tn + r.fn == r.rows for r in rows)
    curve = spark.read.parquet(made.at("tables", "curves"))
    assert curve.where("tp = 0 AND fp = 0").count() == 4

    ranked = stages.assess(spark, made, repeats=1, explained_rows=3)
    assert sorted(r["rank"] for r in ranked.collect()) == [1, 2, 3, 4]
    weights = spark.read.parquet(made.at("tables", "local_weights"))
    assert weights.groupBy("case_id").count().where("count <> 6").count() == 0

    done = stages.publish(spark, made)
    for name in done:
        back = spark.read.option("header", True).csv(made.at("marts", name))
        assert back.count() > 0, name
    assert spark.read.json(made.at("documents", "metrics")).count() == 4
    cost = spark.read.option("header", True).csv(made.at("marts", "cost"))
    assert cost.columns[0] == "experiment" and cost.where(F.col("cost_source") == "unpriced").count() == 4


def test_feature_width():
    assert presets.TRIP_FEATURES.width == 53
