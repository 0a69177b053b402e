import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import session
from cohortlens.sources import conform, dimension, files, shared, sinks

CANON = T.StructType([T.StructField("Key", T.IntegerType()), T.StructField("Amount", T.DoubleType()), T.StructField("Extra", T.StringType())])


def test_conform(spark):
    f = spark.createDataFrame([("1", 2)], "KEY string, amount int")
    got = conform.conform(f, CANON, required=["Key"])
    assert got.dtypes == [("Key", "int"), ("Amount", "double"), ("Extra", "string")]
    assert tuple(got.first()) == (1, 2.0, None)
    with pytest.raises(ValueError, match="Extra"):
        conform.conform(f, CANON, required=["Extra"])


def test_periods_read_per_schema_version(spark, tmp_path):
    import os

    for m, frame in ((1, spark.range(3).selectExpr("id AS key", "1 AS amount")), (2, spark.range(4).selectExpr("cast(id AS int) AS KEY", "'x' AS extra")),
                     (3, spark.range(5).selectExpr("id AS key", "1 AS amount"))):
        frame.coalesce(1).write.parquet(str(tmp_path / f"_p{m}"))
        part = next((tmp_path / f"_p{m}").glob("part-*.parquet"))
        os.link(part, tmp_path / f"part-{m:02d}.parquet")
    listed = files.file_inventory(spark, str(tmp_path), "part-0*.parquet").where(~F.col("path").contains("/_p"))
    assert listed.count() == 3
    log = conform.schema_log(spark, listed)
    got = conform.load_periods(log, CANON, r"part-(\d+)", required=["Key"])
    assert {(r.source_period, r["count"]) for r in got.groupBy("source_period").count().collect()} == {(1, 3), (2, 4), (3, 5)}
    assert got._jdf.queryExecution().toString().count("FileScan parquet") == 2  # two versions, three files
    log = {r.file_name: r for r in log.collect()}
    assert log["part-01.parquet"].schema == log["part-03.parquet"].schema and log["part-02.parquet"].n_columns == 2
    with pytest.raises(ValueError):
        conform.union_frames([])


def test_union_is_strict(spark):
    with pytest.raises(Exception):
        conform.union_frames([spark.range(1), spark.range(1).toDF("other")]).collect()
    many = conform.union_frames([spark.range(2) for _ in range(5)])
    assert many.count() == 10


def test_manifest_and_missing(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    good = next((tmp_path / "t").glob("*.parquet"))
    (tmp_path / "t" / "fake.parquet").write_bytes(b"PAR1 not parquet at all")
    listed = files.file_inventory(spark, str(tmp_path / "t"))
    got = {r.file_name: r for r in files.file_manifest(spark, str(tmp_path / "t")).collect()}
    # beyond the limit of a row the digest is the same, streamed
    size = (tmp_path / "t" / "fake.parquet").stat().st_size
    again = {r.file_name: r for r in files.file_manifest(spark, str(tmp_path / "t"), row_bytes=size).collect()}
    assert {r.read_as for r in got.values()} == {"row"} and (again[good.name].read_as, again["fake.parquet"].read_as) == ("stream", "row")
    assert {n: r[:5] for n, r in got.items()} == {n: r[:5] for n, r in again.items()}
    assert got[good.name].is_parquet and got[good.name].sha256 == hashlib.sha256(good.read_bytes()).hexdigest()
    assert got[good.name].bytes == good.stat().st_size and not got["fake.parquet"].is_parquet
    assert [r.file_name for r in files.missing_files(listed, ["fake.parquet", "gone.parquet"]).collect()] == ["gone.parquet"]
    with pytest.raises(FileNotFoundError, match="gone"):
        files.require_files(listed, ["gone.parquet"])
    assert [(r.file_name, r.bytes, r.rows) for r in files.table_files(spark, str(good)).collect()] == [(good.name, good.stat().st_size, 10)]


def test_bad_values_become_null_and_rules_reach_the_scan(spark, tmp_path):
    f = spark.createDataFrame([("1", 2.0), ("x", 3.0)], "Key string, Amount double")
    assert [r.Key for r in conform.conform(f, CANON).orderBy("Amount").collect()] == [1, None]
    spark.range(20).selectExpr("id AS key", "id * 1.0 AS amount").coalesce(1).write.parquet(str(tmp_path / "p"))
    log = conform.schema_log(spark, files.file_inventory(spark, str(tmp_path / "p")))
    got = conform.load_periods(log, CANON, r"part-(\d+)", rule=lambda frame: F.col("Key") == 7)
    assert [(r.Key, r.Amount) for r in got.collect()] == [(7, 7.0)]
    assert "EqualTo(key,7)" in got._jdf.queryExecution().toString()  # stored as bigint, wanted as int


def test_dimension_dedupes_and_drops_bad_keys(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough\n1,Queens\n1,Bronx\n,Gone\nx,Bad\n2,Queens\n")
    got = dimension.read_dimension(spark, str(tmp_path / "z.csv"), "LocationID", "Borough", key_as="k", value_as="v")
    assert sorted(map(tuple, got.collect())) == [(1, "Bronx"), (2, "Queens")]


def test_csv_headers_blanks_and_empty(spark, tmp_path):
    f = spark.createDataFrame([(1, "a", 9)], "x int, y string, extra int").coalesce(1)
    sinks.write_csv(f, str(tmp_path / "o"), ["y", "gone", "x"])
    text = next((tmp_path / "o").glob("part-*.csv")).read_text().splitlines()
    assert text[0] == "y,gone,x" and text[1] in ('a,,1', 'a,"",1')
    with pytest.raises(ValueError):
        sinks.write_csv(f.limit(0), str(tmp_path / "o2"), ["x"])


def test_json_refuses_non_finite_numbers(spark, tmp_path):
    ok = spark.createDataFrame([(1.0, [1.0], (2.0,))], "a double, b array<double>, c struct<d: double>")
    sinks.write_json(ok, str(tmp_path / "ok"))
    assert spark.read.schema(ok.schema).json(str(tmp_path / "ok")).collect() == ok.collect()
    for bad in ((float("nan"), [1.0], (2.0,)), (1.0, [float("inf")], (2.0,)), (1.0, [1.0], (float("-inf"),))):
        with pytest.raises(ValueError, match="non-finite"):
            sinks.write_json(spark.createDataFrame([bad], ok.schema), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_a_failing_json_write_leaves_what_was_there(spark, tmp_path):
    sinks.write_json(spark.createDataFrame([(1.0,)], "a double"), str(tmp_path / "doc"))
    broken = spark.range(3).select(F.when(F.col("id") < 9, F.raise_error(F.lit("boom"))).cast("string").alias("a"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_json(broken, str(tmp_path / "doc"))
    assert [r.a for r in spark.read.schema("a double").json(str(tmp_path / "doc")).collect()] == [1.0]
    sinks.write_json(spark.createDataFrame([(2.0,)], "a double"), str(tmp_path / "doc"))
    assert [r.a for r in spark.read.schema("a double").json(str(tmp_path / "doc")).collect()] == [2.0]
    assert [p.name for p in tmp_path.iterdir()] == ["doc"]


def test_freeze_fixes_random_draws(spark):
    f = shared.freeze(spark.range(50).withColumn("u", F.rand()), "t")
    assert f.collect() == f.collect()
    assert "FileScan" in f._jdf.queryExecution().toString()


def test_pin_small_respects_its_bound(spark):
    f = spark.range(10).withColumn("x", F.lit(1.5))
    assert "LocalRelation" in shared.pin_small(f, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert shared.pin_small(f, 9) is f


def test_scratch_comes_from_the_session(spark):
    assert shared.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:1", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_root(Session())


def test_hot_period_is_split_over_writers(spark, tmp_path):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(k) for k in keys}
    rows = spark.range(0, 200_000, 1, 8).select(
        "id", F.when(F.col("id") % 10 < 9, "2019-01").otherwise(F.concat(F.lit("2019-"), F.lpad((F.col("id") % 11 + 1).cast("string"), 2, "0"))).alias("p"),
        F.xxhash64("id").alias("noise"))
    try:
        for k in keys:
            spark.conf.set(k, "128k")
        sinks.write_partitioned(rows, str(tmp_path / "w"), "p", ["id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot, cold = (len(list((tmp_path / "w" / f"p={p}").glob("*.parquet"))) for p in ("2019-01", "2019-05"))
    assert hot >= 4 and cold <= 2
    assert spark.read.parquet(str(tmp_path / "w")).count() == 200_000


def test_session_settings(spark):
    with pytest.raises(ValueError):
        session.build_session("x", {"executor_instances": 0})
    spark.conf.set("spark.hidden.password", "hunter2")
    got = {r.setting: r for r in session.run_configuration(spark).collect()}
    spark.conf.unset("spark.hidden.password")
    assert got["spark.sql.shuffle.partitions"].value == "4" and got["version"].value == spark.version
    assert got["spark.hidden.password"].value == "(withheld)" and got["spark.hidden.password"].origin == "session"


def test_many_files_are_read_at_the_same_time(spark, tmp_path):
    """The log is complete and in order whatever finishes first."""
    spark.range(4000).repartition(20).write.parquet(str(tmp_path / "t"))
    listed = files.file_inventory(spark, str(tmp_path / "t"))
    logs = [conform.schema_log(spark, listed, at_once=k).collect() for k in (1, 8)]
    assert logs[0] == logs[1] and len(logs[0]) == 20 and {r.schema for r in logs[0]} == {"struct<id:bigint>"}


def test_scratch_tables_have_a_life(spark):
    """What the result reads stays, in subqueries too; the rest goes, also after an error."""
    from pathlib import Path

    from cohortlens.sources.shared import freeze, scratch_life, shared_root

    def there():
        return {p.name.rpartition("-")[0] for p in Path(shared_root(spark)).iterdir() if p.name.startswith("life")}

    with scratch_life(spark) as keep:
        a, b, c = (freeze(spark.range(k), f"life{k}") for k in (1, 2, 3))
        assert there() == {"life1", "life2", "life3"}
        out = keep(a.select("id", c.agg(F.max("id")).scalar().alias("top")))
    assert there() == {"life1", "life3"} and [tuple(r) for r in out.collect()] == [(0, 2)]
    with pytest.raises(ZeroDivisionError), scratch_life(spark):
        freeze(spark.range(4), "life4")
        1 / 0
    assert there() == {"life1", "life3"}
