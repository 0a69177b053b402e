"""Cohort, feature, split and sampling queries."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators import cohort as K
from cohortlens.operators import sampling
from cohortlens.plans import views as V
from cohortlens.plans.registry import query

S = V.TRIPS


def cohort(spark, d):
    """The staged fact for the trips view, with its key and score kept."""
    return K.build_cohort(V.trips(spark, d, card_only=True), V.zones(spark, d), S, keep=("trip_key", "score"))


@query("cohort_filter", V.TRIPS_SQL + """
SELECT trip_key, pickup_ts, fare_amount, tip_amount, zone_id FROM eligible""")
def cohort_filter(spark, d):
    return K.eligible(V.trips(spark, d, card_only=True), S).select(
        "trip_key", "pickup_ts", "fare_amount", "tip_amount", "zone_id")


@query("cohort_build", V.TRIPS_SQL + """
SELECT label, grp, vendor, rate_code,
       CASE WHEN passenger_count BETWEEN 1 AND 5 THEN passenger_count END AS passenger_count,
       pickup_hour, pickup_dow, pickup_month,
       round(sin(month(pickup_ts) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS pickup_month_sin,
       round(cos(month(pickup_ts) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS pickup_month_cos,
       pickup_date, year_month, zone_id, trip_distance, fare_amount,
       round(tip_amount, 6) AS tip_amount
FROM cohort""")
def cohort_build(spark, d):
    return cohort(spark, d).drop("trip_key", "score").withColumns({
        "pickup_month_sin": F.round("pickup_month_sin", 9),
        "pickup_month_cos": F.round("pickup_month_cos", 9),
        "tip_amount": F.round("tip_amount", 6),
    })


@query("label_ratio", """
SELECT l_orderkey * 10 + l_linenumber AS trip_key,
       CASE WHEN l_extendedprice * l_discount / l_extendedprice > CAST(0.055 AS DOUBLE)
            THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label FROM lineitem""")
def label_ratio(spark, d):
    item = V.table(spark, d, "lineitem")
    return item.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_key"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("part"), "l_extendedprice",
    ).select("trip_key", C.ratio_label("part", "l_extendedprice", S.ratio).alias("label"))


@query("feat_unknown_category", f"""WITH {V.ZONES_SQL}
SELECT c_custkey, coalesce(grp, 'Unknown') AS grp,
       coalesce(CAST(zone_id AS VARCHAR), 'Unknown') AS zone
FROM customer LEFT JOIN zones ON c_nationkey = zone_id""")
def feat_unknown_category(spark, d):
    joined = K.join_dimension(V.table(spark, d, "customer"), V.zones(spark, d), "c_nationkey", "zone_id")
    return joined.select("c_custkey", C.as_category("grp").alias("grp"), C.as_category("zone_id").alias("zone"))


@query("feat_domain_null", """
SELECT CAST(l_linenumber AS DOUBLE) AS raw_count,
       CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
       count(*) AS n FROM lineitem GROUP BY 1, 2""")
def feat_domain_null(spark, d):
    counted = V.table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("raw_count"))
    kept = counted.withColumn("passenger_count", C.within_or_null("raw_count", *S.occupancy_range))
    return kept.groupBy("raw_count", "passenger_count").agg(F.count(F.lit(1)).alias("n"))


@query("feat_calendar", """
SELECT event_id, CAST(hour(ts) AS VARCHAR) AS hour, CAST(dayofweek(ts) + 1 AS VARCHAR) AS dow,
       CAST(month(ts) AS VARCHAR) AS month FROM events""")
def feat_calendar(spark, d):
    ts = F.col("ts")
    return V.table(spark, d, "events").select(
        "event_id", F.hour(ts).cast("string").alias("hour"),
        F.dayofweek(ts).cast("string").alias("dow"), F.month(ts).cast("string").alias("month"))


@query("feat_cyclic", """
SELECT o_orderkey, round(sin(month(o_orderdate) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS month_sin,
       round(cos(month(o_orderdate) * 2 * pi() / 12), 9) + CAST(0 AS DOUBLE) AS month_cos FROM orders""")
def feat_cyclic(spark, d):
    month = F.month("o_orderdate")
    return V.table(spark, d, "orders").select(
        "o_orderkey", F.round(C.cycle_sin(month, 12), 9).alias("month_sin"),
        F.round(C.cycle_cos(month, 12), 9).alias("month_cos"))


@query("feat_period_keys", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS pickup_date,
       strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""")
def feat_period_keys(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("pickup_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))


_LEAK_CANDIDATES = ("trip_distance", "fare_amount", "passenger_count", "vendor", "rate_code", "zone_id")


@query("feat_leakage_report", V.TRIPS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {str(c in V.TRIP_FORBIDDEN).upper()} AS forbidden, "
    f"count({c}) AS filled_rows FROM trips" for c in _LEAK_CANDIDATES))
def feat_leakage_report(spark, d):
    return K.leakage_report(V.trips(spark, d), _LEAK_CANDIDATES, V.TRIP_FORBIDDEN)


@query("join_dimension", V.TRIPS_SQL + """
SELECT trip_key, zone_id, grp, fare_amount FROM cohort""")
def join_dimension(spark, d):
    """Every eligible fact row with its group, unmatched zones included."""
    facts = K.eligible(V.trips(spark, d, card_only=True), S).select("trip_key", "zone_id", "fare_amount")
    joined = K.join_dimension(facts, V.zones(spark, d), "zone_id", "zone_id")
    return joined.select("trip_key", "zone_id", C.as_category("grp").alias("grp"), "fare_amount")


_SPLIT_CASE = ("CASE WHEN year_month < '2000-07' THEN 'train' "
               "WHEN year_month < '2000-08' THEN 'validation' ELSE 'test' END")


@query("split_temporal", V.TRIPS_SQL + f"""
SELECT trip_key, label, year_month, {_SPLIT_CASE} AS split FROM cohort""")
def split_temporal(spark, d):
    return cohort(spark, d).select("trip_key", "label", "year_month", K.split_name(V.SPLIT).alias("split"))


@query("split_day_folds", """
SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 3 AS INTEGER) AS fold,
       count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS days,
       count(*) FILTER (WHERE value > 50) AS positives FROM events GROUP BY 1""")
def split_day_folds(spark, d):
    """Rows fold to days first, so the distinct count of days is a plain count."""
    days = V.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("positives"))
    return days.groupBy(C.day_fold("day", 3, hashed=False).alias("fold")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("days"), F.sum("positives").alias("positives"))


def _train(spark, d):
    return cohort(spark, d).where(F.col("year_month") < V.SPLIT.validation_from)


@query("agg_class_weights", V.TRIPS_SQL + """,
t AS (SELECT count(*) FILTER (WHERE label = 0) AS negatives, count(*) FILTER (WHERE label = 1) AS positives
      FROM cohort WHERE year_month < '2000-07')
SELECT negatives, positives,
       round((negatives + positives) / (CAST(2 AS DOUBLE) * negatives), 9) AS w_negative,
       round((negatives + positives) / (CAST(2 AS DOUBLE) * positives), 9) AS w_positive FROM t""")
def agg_class_weights(spark, d):
    return K.class_weights(_train(spark, d)).withColumns({
        "w_negative": F.round("w_negative", 9), "w_positive": F.round("w_positive", 9)})


@query("weight_apply", """
WITH r AS (SELECT event_id, CAST(value > 50 AS DOUBLE) AS label FROM events WHERE ts < TIMESTAMP '2024-01-22'),
w AS (SELECT count(*) AS n, sum(label) AS p FROM r)
SELECT event_id, label,
       round(CASE WHEN label = 1 THEN n / (2 * p) ELSE n / (2 * (n - p)) END, 9) AS class_weight
FROM r, w""")
def weight_apply(spark, d):
    train = V.table(spark, d, "events").where(
        F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz")
    ).select("event_id", (F.col("value") > 50).cast("double").alias("label"))
    weighted = K.apply_weights(train, K.class_weights(train))
    return weighted.withColumn("class_weight", F.round("class_weight", 9))


@query("sample_hash", f"""
SELECT event_id, event_type FROM events WHERE {V.draw_sql('event_id', 17)} < 0.25""")
def sample_hash(spark, d):
    events = V.table(spark, d, "events").select("event_id", "event_type")
    return sampling.by_key(events, "event_id", 0.25, 17, hashed=False)


@query("sample_background", f"""
SELECT event_id, event_type, value FROM events ORDER BY {V.draw_sql('event_id', 29)}, event_id LIMIT 200""")
def sample_background(spark, d):
    events = V.table(spark, d, "events").select("event_id", "event_type", "value")
    return sampling.background(events, "event_id", 200, 29, hashed=False)


_CDF = list(itertools.accumulate(math.exp(-1.0) / math.factorial(k) for k in range(18)))


def _bootstrap_sql(trials: int, seed: int) -> str:
    parts = []
    for t in range(trials):
        draw = V.draw_sql("event_id", seed + t)
        weight = " + ".join(f"CAST(u >= CAST({c!r} AS DOUBLE) AS BIGINT)" for c in _CDF)
        parts.append(
            f"SELECT {t + 1} AS trial, CAST(sum({weight}) AS BIGINT) AS rows_drawn, "
            f"round(sum(({weight}) * y) / sum({weight}), 6) AS rate "
            f"FROM (SELECT {draw} AS u, CAST(value > 50 AS DOUBLE) AS y FROM events)")
    return " UNION ALL ".join(parts)


@query("sample_bootstrap", _bootstrap_sql(5, 11))
def sample_bootstrap(spark, d):
    rows = V.table(spark, d, "events").select("event_id", (F.col("value") > 50).cast("double").alias("label"))
    return sampling.bootstrap_rates(rows, "event_id", 5, 11, hashed=False)


@query("band_distance", """
SELECT CASE WHEN l_quantity < 2 THEN '0-2 miles' WHEN l_quantity < 5 THEN '2-5 miles'
            WHEN l_quantity <= 40 THEN '5-40 miles' ELSE 'unknown/outlier' END AS distance_band,
       count(*) AS n FROM lineitem GROUP BY 1""")
def band_distance(spark, d):
    return V.table(spark, d, "lineitem").groupBy(
        C.distance_band("l_quantity", 40).alias("distance_band")).agg(F.count(F.lit(1)).alias("n"))


@query("band_custom_edges", """
SELECT CASE WHEN l_quantity < 10 THEN '0-10' WHEN l_quantity < 20 THEN '10-20' WHEN l_quantity < 30 THEN '20-30'
            WHEN l_quantity < 40 THEN '30-40' ELSE '40+' END AS distance_band,
       count(*) AS n FROM lineitem GROUP BY 1""")
def band_custom_edges(spark, d):
    named = C.band("l_quantity", (10, 20, 30, 40), ("0-10", "10-20", "20-30", "30-40"), "40+", last_inclusive=False)
    return V.table(spark, d, "lineitem").groupBy(named.alias("distance_band")).agg(F.count(F.lit(1)).alias("n"))
