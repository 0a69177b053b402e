"""Aggregate marts, pivots and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators import marts as M
from cohortlens.operators import selection
from cohortlens.plans import views as V
from cohortlens.plans.cohort_queries import cohort
from cohortlens.plans.registry import query

MINIMUM = 50


@query("agg_rows_by_period", """
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS n FROM orders GROUP BY 1""")
def agg_rows_by_period(spark, d):
    return M.rows_by(V.table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))


@query("agg_period_label", V.TRIPS_SQL + """
SELECT year_month, label, count(*) AS n FROM cohort GROUP BY 1, 2 ORDER BY 1, 2""")
def agg_period_label(spark, d):
    return M.rows_by(cohort(spark, d), "year_month", "label").orderBy("year_month", "label")


_SPLIT = ("CASE WHEN year_month < '2000-07' THEN 'train' "
          "WHEN year_month < '2000-08' THEN 'validation' ELSE 'test' END")


@query("agg_split_rows", V.TRIPS_SQL + f"""
, s AS (SELECT {_SPLIT} AS split, year_month, label FROM cohort)
SELECT 'period' AS level, split, year_month AS period, count(*) AS rows,
       count(*) FILTER (WHERE label = 1) AS positives FROM s GROUP BY split, year_month
UNION ALL SELECT 'split', split, 'all', count(*), count(*) FILTER (WHERE label = 1) FROM s GROUP BY split
UNION ALL SELECT 'total', 'all', 'all', count(*), count(*) FILTER (WHERE label = 1) FROM s""")
def agg_split_rows(spark, d):
    return M.split_totals(cohort(spark, d), V.SPLIT)


@query("agg_group_hour", V.RIDES_SQL + """
SELECT grp, hour, count(*) AS n, round(avg(label), 6) AS rate FROM rides GROUP BY 1, 2""")
def agg_group_hour(spark, d):
    return M.group_rates(V.rides(spark, d), ["grp", "hour"], digits=6)


def business(spark, d, minimum):
    """Period, group and hour cells with mean fare, small cells withheld, sorted."""
    return M.group_rates(
        cohort(spark, d), ["year_month", "grp", "pickup_hour"], minimum=minimum,
        rate="high_tip_rate", measures={"mean_fare_usd": M.mean_money("fare_amount")}, digits=6,
    ).orderBy("year_month", "grp", "pickup_hour")


@query("mart_business", V.TRIPS_SQL + f"""
SELECT year_month, grp, pickup_hour, count(*) AS n, round(avg(label), 6) AS high_tip_rate,
       round(avg(CAST(floor(fare_amount * 100 + 0.5) AS BIGINT)) / 100, 6) AS mean_fare_usd
FROM cohort GROUP BY 1, 2, 3 HAVING count(*) >= {MINIMUM} ORDER BY 1, 2, 3""")
def mart_business(spark, d):
    return business(spark, d, MINIMUM)


@query("mart_distance", V.TRIPS_SQL + f"""
SELECT CASE WHEN trip_distance < 2 THEN '0-2 miles' WHEN trip_distance < 5 THEN '2-5 miles'
            WHEN trip_distance <= 40 THEN '5-40 miles' ELSE 'unknown/outlier' END AS distance_band,
       count(*) AS n, round(avg(label), 6) AS rate
FROM cohort GROUP BY 1 HAVING count(*) >= {MINIMUM}""")
def mart_distance(spark, d):
    banded = cohort(spark, d).withColumn("distance_band", C.distance_band("trip_distance", 40))
    return M.group_rates(banded, ["distance_band"], minimum=MINIMUM, digits=6)


@query("mart_distance_fare", V.TRIPS_SQL + """
SELECT CASE WHEN trip_distance < 10 THEN '0-10' WHEN trip_distance < 20 THEN '10-20'
            WHEN trip_distance < 30 THEN '20-30' WHEN trip_distance < 40 THEN '30-40' ELSE '40+' END AS distance_band,
       count(*) AS n, round(avg(label), 6) AS rate, round(avg(CAST(floor(fare_amount * 100 + 0.5) AS BIGINT)) / 100, 6) AS mean_fare,
       round(sum(trip_distance), 2) AS volume
FROM cohort GROUP BY 1""")
def mart_distance_fare(spark, d):
    named = C.band("trip_distance", (10, 20, 30, 40), ("0-10", "10-20", "20-30", "30-40"), "40+", last_inclusive=False)
    return M.group_rates(
        cohort(spark, d).withColumn("distance_band", named), ["distance_band"],
        measures={"mean_fare": M.mean_money("fare_amount"), "volume": F.sum("trip_distance")}, digits=6,
    ).withColumn("volume", F.round("volume", 2))


@query("mart_group_rate", V.TRIPS_SQL + f"""
SELECT grp, count(*) AS n, round(avg(label), 6) AS rate FROM cohort
GROUP BY 1 HAVING count(*) >= {MINIMUM} ORDER BY rate DESC, grp""")
def mart_group_rate(spark, d):
    return M.group_rates(cohort(spark, d), ["grp"], minimum=MINIMUM, digits=6).orderBy(F.desc("rate"), "grp")


@query("pivot_period_label", V.TRIPS_SQL + """
SELECT year_month, count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1
FROM cohort GROUP BY 1""")
def pivot_period_label(spark, d):
    return M.pivot_labels(cohort(spark, d), "year_month")


@query("pivot_group_hour", V.RIDES_SQL + """
, c AS (SELECT grp, hour, avg(label) AS rate FROM rides
        WHERE day_key = (SELECT max(day_key) FROM rides) GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT grp, """ + ", ".join(
    f"round(max(rate) FILTER (WHERE hour = '{h}'), 6) AS h{h}" for h in range(24)) + """
FROM c GROUP BY grp""")
def pivot_group_hour(spark, d):
    return M.latest_period_heatmap(V.rides(spark, d), "day_key", "grp", "hour", range(24), minimum=2, digits=6)


@query("topn_cells", V.TRIPS_SQL + """
SELECT year_month, grp, count(*) AS n, round(avg(label), 6) AS rate FROM cohort
GROUP BY 1, 2 ORDER BY n DESC, year_month, grp LIMIT 8""")
def topn_cells(spark, d):
    return M.top_cells(cohort(spark, d), ["year_month", "grp"], 8, digits=6)


@query("agg_median_timing", """
SELECT event_type, count(*) AS runs, round(median(value), 6) AS median_seconds FROM events GROUP BY 1""")
def agg_median_timing(spark, d):
    return M.median_timings(V.table(spark, d, "events"), ["event_type"], "value").withColumn(
        "median_seconds", F.round("median_seconds", 6))


_PRICE, _PRICE_SOURCE = 2.5, "https://example.org/rates"


def _measurements(spark, d):
    """Event values read as seconds: one measurement per event type and hour."""
    spent = V.table(spark, d, "events").groupBy("event_type", F.hour("ts").alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("wall_seconds"))
    return spent.select(
        F.when(F.col("event_type") == "view", "training").otherwise("groupby_fraction").alias("experiment"),
        F.col("event_type").alias("model"), F.col("h").cast("string").alias("config"),
        F.lit(1.0).alias("sample_fraction"), "rows", "wall_seconds")


@query("mart_cost", f"""
WITH m AS (SELECT event_type, hour(ts) AS h, count(*) AS rows, round(sum(value), 3) AS s FROM events GROUP BY 1, 2)
SELECT CASE WHEN event_type = 'view' THEN 'training' ELSE 'groupby_fraction' END AS experiment,
       event_type AS model, CAST(h AS VARCHAR) AS config, CAST(1 AS DOUBLE) AS sample_fraction, rows,
       s AS wall_seconds, round(s / 3600 * CAST({_PRICE} AS DOUBLE), 4) AS usd_estimate,
       '{_PRICE_SOURCE} (cluster rate only; no storage/egress)' AS cost_source FROM m""")
def mart_cost(spark, d):
    return M.cost_table(_measurements(spark, d), _PRICE, _PRICE_SOURCE)


@query("mart_cost_unpriced", """
WITH m AS (SELECT event_type, hour(ts) AS h, count(*) AS rows, round(sum(value), 3) AS s FROM events GROUP BY 1, 2)
SELECT CASE WHEN event_type = 'view' THEN 'training' ELSE 'groupby_fraction' END AS experiment,
       event_type AS model, CAST(h AS VARCHAR) AS config, CAST(1 AS DOUBLE) AS sample_fraction, rows,
       s AS wall_seconds, CAST(NULL AS DOUBLE) AS usd_estimate,
       CASE WHEN event_type = 'view' THEN 'unpriced' ELSE 'benchmark only' END AS cost_source FROM m""")
def mart_cost_unpriced(spark, d):
    return M.cost_table(_measurements(spark, d))


_GRID_SQL = """WITH g AS (
  SELECT event_type AS model, hour(ts) AS grid_index,
         round(avg(CASE WHEN value > 50 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 3) AS metric,
         round(sum(value), 3) AS seconds
  FROM events GROUP BY 1, 2),
b AS (SELECT model, grid_index, metric,
             row_number() OVER (PARTITION BY model ORDER BY metric DESC, grid_index) AS rn FROM g),
t AS (SELECT model, round(sum(seconds), 3) AS seconds, max(metric) AS metric FROM g GROUP BY 1)
"""


def _grid(spark, d):
    """A cross-validation-shaped table from events: type as model, hour as grid point."""
    return V.table(spark, d, "events").groupBy(
        F.col("event_type").alias("model"), F.hour("ts").alias("grid_index")).agg(
        F.round(F.avg((F.col("value") > 50).cast("double")), 3).alias("metric"),
        F.round(F.sum("value"), 3).alias("seconds"))


@query("select_best_params", _GRID_SQL + "SELECT model, CAST(grid_index AS INTEGER) AS grid_index, metric FROM b WHERE rn = 1")
def select_best_params(spark, d):
    return selection.best_points(_grid(spark, d).select("model", "grid_index", "metric"))


@query("select_recommended", _GRID_SQL + """
SELECT model, metric, seconds FROM t WHERE (SELECT max(metric) FROM t) - metric <= 0.05
ORDER BY seconds, model LIMIT 1""")
def select_recommended(spark, d):
    per_model = _grid(spark, d).groupBy("model").agg(
        F.max("metric").alias("metric"), F.round(F.sum("seconds"), 3).alias("seconds"))
    return selection.recommend(per_model, metric="metric", cost="seconds", tolerance=0.05)
