"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import quality as Q
from cohortlens.operators import robustness as R
from cohortlens.functions import columns as C
from cohortlens.plans import views as V
from cohortlens.plans.cohort_queries import cohort
from cohortlens.plans.registry import query
from cohortlens.sources.files import table_files
from cohortlens.sources.shared import freeze

_IN_WINDOW = "pickup_ts >= TIMESTAMP '1996-01-01' AND pickup_ts < TIMESTAMP '2002-01-01'"
_BAD = {
    "outside_window": f"NOT coalesce({_IN_WINDOW}, FALSE)",
    "wrong_channel": "NOT coalesce(payment_type = 1, FALSE)",
    "invalid_base": "NOT coalesce(fare_amount > 0 AND NOT isnan(fare_amount), FALSE)",
    "invalid_part": "NOT coalesce(tip_amount >= 0 AND NOT isnan(tip_amount), FALSE)",
    "missing_place": "zone_id IS NULL",
    "missing_occupancy": "passenger_count IS NULL",
    "invalid_occupancy": "passenger_count < 1 OR passenger_count > 5",
    "missing_vendor": "vendor IS NULL",
    "missing_late_code": "rate_code IS NULL",
}
_FLAG_SQL = ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in _BAD.items())


@query("qc_flags", V.TRIPS_SQL + f"SELECT count(*) AS raw_rows, {_FLAG_SQL} FROM trips")
def qc_flags(spark, d):
    return Q.quality_flags(V.trips(spark, d), V.TRIPS)


@query("qc_long_table", V.TRIPS_SQL + f"""
, f AS (SELECT count(*) AS raw_rows, {_FLAG_SQL} FROM trips)
SELECT 'overall' AS section, 'raw_rows' AS metric, 'all' AS key, raw_rows AS value FROM f
UNION ALL SELECT 'overall', 'clean_rows', 'all', count(*) FROM eligible
UNION ALL SELECT 'month', 'clean_rows', year_month, count(*) FROM eligible GROUP BY year_month
""" + "".join(f"UNION ALL SELECT 'quality_nonexclusive', '{n}', 'all', {n} FROM f\n" for n in _BAD))
def qc_long_table(spark, d):
    return Q.quality_table(V.trips(spark, d), V.TRIPS, "year_month")


_PROFILE = {
    "trip_key": "numeric", "pickup_ts": "datetime", "payment_type": "numeric", "fare_amount": "numeric", "tip_amount": "numeric",
    "trip_distance": "numeric", "passenger_count": "numeric", "vendor": "categorical", "rate_code": "categorical",
    "zone_id": "numeric", "year_month": "categorical", "score": "numeric",
}


@query("qc_column_profile", V.TRIPS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{f}' AS family, "
    f"round(100.0 * (count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS missing_pct, "
    f"count(DISTINCT {c}) AS distinct_values FROM trips" for c, f in _PROFILE.items()))
def qc_column_profile(spark, d):
    return Q.column_profile(V.trips(spark, d), list(_PROFILE), exact=list(_PROFILE))


@query("qc_merged_sketches")
def qc_merged_sketches(spark, d):
    """Distinct values of the whole estimated from sketches kept per period."""
    kept = freeze(Q.column_sketches(V.trips(spark, d), list(_PROFILE), "year_month"), "sketches")
    return Q.merge_sketches(kept)


@query("qc_volume_gate", """
SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns, count(*) >= 5000 AS enough_rows,
       TRUE AS enough_columns, TRUE AS enough_bytes FROM lineitem""")
def qc_volume_gate(spark, d):
    sizes = table_files(spark, f"{d}/lineitem.parquet").agg(F.sum("bytes")).first()[0]
    return Q.volume_gate(V.table(spark, d, "lineitem"), sizes, min_rows=5000, min_columns=10, min_bytes=10_000)


@query("qc_split_gate", V.TRIPS_SQL + """
, s AS (SELECT CASE WHEN year_month < '2000-07' THEN 'train' WHEN year_month < '2000-08' THEN 'validation'
               ELSE 'test' END AS split, label FROM cohort),
n AS (SELECT unnest(['train', 'validation', 'test']) AS split),
g AS (SELECT n.split, count(s.split) AS rows, count(*) FILTER (WHERE label = 1) AS positives
      FROM n LEFT JOIN s ON n.split = s.split GROUP BY n.split)
SELECT split, rows, positives, rows > 0 AS non_empty, positives > 0 AND positives < rows AS both_classes,
       rows >= 100 AS large_enough FROM g""")
def qc_split_gate(spark, d):
    return Q.split_gate(cohort(spark, d), V.SPLIT, minimum=100)


_RIDE_TEST = "day_key >= '2024-01-25'"
RIDE_DRAW = V.draw_sql("event_id", 31)


def perturbed_rides(spark, d):
    """The test rides with a fifth of them perturbed by their key's draw."""
    return R.perturb(V.test_rides(spark, d), C.key_draw("event_id", 31), R.shift_and_hide(0.20))


@query("qc_cohort_reconcile", V.RIDES_SQL + f"""
SELECT count(*) AS base_rows, count(*) AS other_rows, count(*) FILTER (WHERE label = 1) AS base_positives,
       count(*) FILTER (WHERE label = 1) AS other_positives, TRUE AS same_rows, TRUE AS same_positives
FROM rides WHERE {_RIDE_TEST}""")
def qc_cohort_reconcile(spark, d):
    return Q.reconcile_cohorts(V.test_rides(spark, d), perturbed_rides(spark, d))


_SUMMED = ("outside_window", "invalid_base", "invalid_part", "missing_place")


@query("qc_volume_summary", V.TRIPS_SQL + f"""
, p AS (SELECT count(*) AS n, {_FLAG_SQL} FROM trips GROUP BY year_month)
SELECT CAST(sum(n) AS BIGINT) AS raw_rows, count(*) AS periods, min(n) AS min_period_rows, max(n) AS max_period_rows,
       {', '.join(f'CAST(sum({k}) AS BIGINT) AS {k}' for k in _SUMMED)},
       CAST(5 AS BIGINT) AS min_source_columns, CAST(11 AS BIGINT) AS max_source_columns FROM p""")
def qc_volume_summary(spark, d):
    widths = [len(V.table(spark, d, t).columns) for t in ("lineitem", "orders", "customer")]
    return Q.volume_summary(V.trips(spark, d), V.TRIPS, "year_month", widths)


@query("perturb_inputs", V.RIDES_SQL + f"""
, t AS (SELECT *, {RIDE_DRAW} AS u FROM rides WHERE {_RIDE_TEST})
SELECT event_id, label,
       CASE WHEN u < 0.1 THEN CAST((CAST(hour AS INTEGER) + 1) % 24 AS VARCHAR) ELSE hour END AS hour,
       CASE WHEN u >= 0.1 AND u < 0.2 THEN 'Unknown' ELSE grp END AS grp,
       u < 0.1 AS hour_shifted, u >= 0.1 AND u < 0.2 AND grp <> 'Unknown' AS group_masked FROM t""")
def perturb_inputs(spark, d):
    return perturbed_rides(spark, d).select("event_id", "label", "hour", "grp", R.SHIFTED, R.MASKED)


@query("perturb_tallies", V.RIDES_SQL + f"""
, t AS (SELECT *, {RIDE_DRAW} AS u FROM rides WHERE {_RIDE_TEST})
SELECT count(*) AS rows, count(*) FILTER (WHERE label = 1) AS positives,
       count(*) FILTER (WHERE u < 0.1) AS hour_shifted,
       count(*) FILTER (WHERE u >= 0.1 AND u < 0.2 AND grp <> 'Unknown') AS group_masked FROM t""")
def perturb_tallies(spark, d):
    return R.tallies(perturbed_rides(spark, d))


@query("perturb_shift", """
SELECT event_id, CAST((hour(ts) + 1) % 24 AS VARCHAR) AS next_hour FROM events""")
def perturb_shift(spark, d):
    hours = V.table(spark, d, "events").select("event_id", F.hour("ts").cast("string").alias("hour"))
    return hours.select("event_id", C.shift_cycle("hour", 24).alias("next_hour"))
