"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.plans import views as V
from cohortlens.plans.cohort_queries import cohort
from cohortlens.plans.registry import query
from cohortlens.sources import conform as N
from cohortlens.sources import dimension as D
from cohortlens.sources import files as S
from cohortlens.sources import sinks as K
from cohortlens.sources.shared import freeze, fresh_path

FACTS = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


def _counts_sql(tables) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in tables)


def _table_rows(spark, d, tables):
    """Rows and bytes by table; a table may be a file or a folder of files."""
    each = [S.table_files(spark, f"{d}/{t}.parquet").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
            .select(F.lit(t).alias("name"), "rows", "bytes", "files") for t in tables]
    return N.union_frames(each)


@query("src_missing_files", f"""
SELECT e.name, c.rows, c.rows IS NULL AS missing
FROM (VALUES {', '.join(f"('{t}')" for t in (*FACTS, 'returns', 'refunds'))}) e(name) LEFT JOIN ({_counts_sql(FACTS)}) c USING (name)""")
def src_missing_files(spark, d):
    """Expected tables beside what the files hold; the two that are not there are missing."""
    found = _table_rows(spark, d, FACTS).select("name", "rows")
    expected = spark.createDataFrame([(t,) for t in (*FACTS, "returns", "refunds")], "name string")
    return expected.join(found, "name", "left").withColumn("missing", F.col("rows").isNull())


@query("src_file_inventory")
def src_file_inventory(spark, d):
    """Rows, bytes and files of each table; SQL over the tables knows nothing of bytes."""
    return _table_rows(spark, d, FACTS)


@query("src_manifest")
def src_manifest(spark, d):
    """Digest of each file; SQL sees tables, not the bytes of their files."""
    return S.file_manifest(spark, [f"{d}/{t}.parquet" for t in FACTS]).drop("path")


# Spark's names of the types that SQL lists
_TYPES_SQL = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'FLOAT' THEN 'float' ELSE data_type END"


@query("src_schema_log", f"""
SELECT table_name AS name, CAST(1 AS BIGINT) AS versions, CAST(count(*) AS INTEGER) AS n_columns,
       'struct<' || string_agg(column_name || ':' || {_TYPES_SQL}, ',' ORDER BY column_index) || '>' AS schema
FROM duckdb_columns() WHERE table_name IN ({', '.join(repr(t) for t in FACTS)}) GROUP BY 1""")
def src_schema_log(spark, d):
    """Schema versions, columns and types of each table, from the log of its files."""
    files = S.file_inventory(spark, [f"{d}/{t}.parquet" for t in FACTS])
    table = F.regexp_extract("path", r"/(\w+)\.parquet(?:/[^/]*)?$", 1)
    log = N.schema_log(spark, files).withColumn("name", table)
    return log.groupBy("name").agg(F.count_distinct("schema").alias("versions"), F.min("n_columns").alias("n_columns"), F.min("schema").alias("schema"))


CANON = T.StructType([
    T.StructField("KEY", T.LongType()),
    T.StructField("HAPPENED", T.TimestampNTZType()),
    T.StructField("AMOUNT", T.DoubleType()),
    T.StructField("Kind", T.StringType()),
    T.StructField("surcharge", T.DoubleType()),
])


@query("src_conform_schema", """
SELECT o_orderkey AS KEY, o_orderdate AS HAPPENED, o_totalprice AS AMOUNT, o_orderstatus AS Kind,
       CAST(NULL AS DOUBLE) AS surcharge FROM orders""")
def src_conform_schema(spark, d):
    """Names differ in case, one optional column is absent."""
    shouted = V.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderdate").alias("Happened"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("KIND"))
    return N.conform(shouted, CANON, required=("KEY", "HAPPENED"))


@query("src_tag_period", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS source_period, count(*) AS n FROM orders GROUP BY 1""")
def src_tag_period(spark, d):
    """Orders written by year; each row's period comes back from its file's path."""
    path = fresh_path(spark, "yearly")
    K.write_partitioned(
        V.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y")), path, "y")
    tagged = N.tag_period(spark.read.schema("o_orderkey long").parquet(path), r"/y=(\d+)/")
    return tagged.groupBy("source_period").agg(F.count(F.lit(1)).alias("n"))


@query("union_periods", """
SELECT 1 AS source_period, o_orderkey AS KEY, o_orderdate AS HAPPENED, o_totalprice AS AMOUNT,
       o_orderstatus AS Kind, CAST(NULL AS DOUBLE) AS surcharge FROM orders
UNION ALL SELECT 2, event_id, ts, value, event_type, NULL FROM events
UNION ALL SELECT 3, l_orderkey, l_shipdate, l_extendedprice, l_returnflag, l_tax FROM lineitem""")
def union_periods(spark, d):
    """Three drifting sources under one schema, each scanned once."""
    aliases = (
        ("orders", {"KEY": "o_orderkey", "HAPPENED": "o_orderdate", "AMOUNT": "o_totalprice", "Kind": "o_orderstatus"}),
        ("events", {"KEY": "event_id", "HAPPENED": "ts", "AMOUNT": "value", "Kind": "event_type"}),
        ("lineitem", {"KEY": "l_orderkey", "HAPPENED": "l_shipdate", "AMOUNT": "l_extendedprice",
                      "Kind": "l_returnflag", "surcharge": "l_tax"}),
    )
    frames = [
        N.conform(V.table(spark, d, t), CANON, required=("KEY",), aliases=names)
        .withColumn("source_period", F.lit(i)) for i, (t, names) in enumerate(aliases, 1)
    ]
    return N.union_frames(frames)


@query("src_dimension", """
SELECT c_nationkey AS zone_id, min(c_mktsegment) AS grp FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1""")
def src_dimension(spark, d):
    """A CSV lookup with duplicate keys, made from the customers, read back with casts."""
    path = fresh_path(spark, "lookup")
    K.write_csv(V.table(spark, d, "customer"), path, ["c_nationkey", "c_mktsegment"])
    return D.read_dimension(spark, path, "c_nationkey", "c_mktsegment", key_as="zone_id", value_as="grp")


@query("src_preview", """
SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5""")
def src_preview(spark, d):
    return D.preview(V.table(spark, d, "events"), ["event_id", "event_type", "value"], ["event_id"])


@query("sink_partitioned_write", V.TRIPS_SQL + """
SELECT year_month, count(*) AS n, count(DISTINCT grp) AS groups FROM cohort GROUP BY 1""")
def sink_partitioned_write(spark, d):
    """The whole fact, all columns, by period."""
    path = fresh_path(spark, "staged")
    K.write_partitioned(cohort(spark, d), path, "year_month", ["pickup_date", "zone_id"])
    staged = D.read_staged(spark, path)
    return staged.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("grp").alias("groups"))


@query("src_staged_roundtrip", V.TRIPS_SQL + """
SELECT trip_key, label, grp, vendor, rate_code, CASE WHEN passenger_count BETWEEN 1 AND 5 THEN passenger_count END AS passenger_count,
       pickup_hour, pickup_dow, pickup_month, round(sin(month(pickup_ts) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS pickup_month_sin,
       round(cos(month(pickup_ts) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS pickup_month_cos, pickup_date, year_month, zone_id,
       trip_distance, fare_amount, round(tip_amount, 6) AS tip_amount, round(score, 9) AS score
FROM cohort WHERE year_month >= '2000-07'""")
def src_staged_roundtrip(spark, d):
    """All columns read back with partition pruning on the text period key."""
    path = fresh_path(spark, "staged")
    K.write_partitioned(cohort(spark, d), path, "year_month")
    back = D.read_staged(spark, path).where(F.col("year_month") >= "2000-07")
    return back.withColumns({c: F.round(c, n) for c, n in (("pickup_month_sin", 9), ("pickup_month_cos", 9), ("tip_amount", 6), ("score", 9))})


@query("sink_freeze", """
SELECT event_id, hour(ts) AS hour, value FROM events""")
def sink_freeze(spark, d):
    return freeze(V.table(spark, d, "events").select("event_id", F.hour("ts").cast("bigint").alias("hour"), "value"), "events")


@query("sink_csv_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note FROM orders""")
def sink_csv_roundtrip(spark, d):
    path = fresh_path(spark, "export")
    K.write_csv(V.table(spark, d, "orders"), path, ["o_orderkey", "o_orderstatus", "note"])
    return spark.read.option("header", True).csv(path)


@query("sink_finite_check", """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS l_quantity,
       count(*) FILTER (WHERE l_discount = 0) AS ratio FROM lineitem""")
def sink_finite_check(spark, d):
    """Division by a zero discount is made infinite on purpose, and counted."""
    item = V.table(spark, d, "lineitem").select(
        "l_quantity",
        F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax")).alias("ratio"))
    return K.non_finite_counts(item)


@query("sink_json_roundtrip", """
SELECT event_id, event_type, value FROM events""")
def sink_json_roundtrip(spark, d):
    path = fresh_path(spark, "doc")
    K.write_json(V.table(spark, d, "events").select("event_id", "event_type", "value"), path)
    return spark.read.schema("event_id long, event_type string, value double").json(path)
