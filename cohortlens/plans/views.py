"""The two working views over the test tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.sources.dimension import one_row_per_key
from cohortlens.spec import CohortSpec, FeatureSpec, TimeSplit

TRIPS = CohortSpec(
    window=("1996-01-01", "2002-01-01"), ratio=0.055, occupancy_range=(1.0, 5.0)
)
SPLIT = TimeSplit(validation_from="2000-07", test_from="2000-08")
RIDE_SPLIT = TimeSplit(validation_from="2024-01-22", test_from="2024-01-25", period="day_key")

TRIP_FORBIDDEN = ("fare_amount", "tip_amount", "trip_distance", "payment_type", "rate_code")

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown")
RIDE_FEATURES = FeatureSpec(
    numeric=("balance",),
    vocabulary={
        "grp": REGIONS,
        "vendor": ("click", "error", "purchase", "signup"),  # "view" stays unseen on purpose
        "hour": tuple(str(h) for h in range(24)),
        "dow": tuple(str(d) for d in range(1, 8)),
    },
    cyclic=("month_day", 31),
    forbidden=("fare", "label", "event_id"),
)


# Customers beyond which the lookup is shuffled instead of sent through the driver.
LOOKUP_ROWS = 100_000


def draw_sql(key: str, seed: int) -> str:
    """The draw of ``key_draw`` in SQL."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 13) AS BIGINT) / CAST({1 << 52} AS DOUBLE)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension; two nations are left out so that some facts find no zone."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    pairs = (
        nation.where(F.col("n_nationkey") < 23)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").cast("int").alias("zone_id"), F.col("r_name").alias("grp"))
    )
    return one_row_per_key(pairs, "zone_id", "grp")


def trips(spark: SparkSession, sf_dir: str, card_only: bool = False) -> DataFrame:
    """Trip-shaped facts: line items with their order's time and customer's zone.

    ``card_only`` states the payment rule on the stored column, so it reaches the scan.
    """
    item, order, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    if card_only:
        item = item.where(F.col("l_linestatus") == "F")
    return (
        item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_key"),
            F.col("o_orderdate").alias("pickup_ts"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("payment_type"),
            F.col("l_extendedprice").alias("fare_amount"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("l_linenumber").cast("double").alias("passenger_count"),
            F.substring("o_orderpriority", 1, 1).alias("vendor"),
            F.col("l_returnflag").alias("rate_code"),
            F.col("c_nationkey").alias("zone_id"),
            F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
            ((F.col("l_quantity") + 10 * F.col("l_linenumber")) / F.lit(120.0)).alias("score"),
        )
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride-shaped facts: events with the customer's zone, hour and day features.

    A table of many customers is joined by shuffle: as a broadcast it would pass through
    the driver again in every job of a query that runs many.
    """
    event, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    if customer.count() > LOOKUP_ROWS:  # from the footers
        customer = customer.hint("shuffle_hash")
    ts = F.col("ts")
    return (
        event.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
        .join(zones(spark, sf_dir), F.col("c_nationkey") == F.col("zone_id"), "left")
        .select(
            "event_id", "ts",
            F.col("value").alias("fare"),
            (F.col("value") > 50).cast("double").alias("label"),
            C.as_category("grp").alias("grp"),
            F.col("event_type").alias("vendor"),
            F.hour(ts).cast("string").alias("hour"),
            F.dayofweek(ts).cast("string").alias("dow"),
            F.dayofmonth(ts).cast("string").alias("month_day"),
            F.to_date(ts).alias("day"),
            F.date_format(ts, "yyyy-MM-dd").alias("day_key"),
            C.within_or_null("c_acctbal", 0.0, 1e9).alias("balance"),
        )
    )


def test_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides of the test period, bounded on the raw time so that the scan is filtered."""
    first = F.lit(RIDE_SPLIT.test_from).cast("timestamp_ntz")
    return rides(spark, sf_dir).where(F.col("ts") >= first)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-free scores over every line item: narrow scan, no join."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        (F.col("l_discount") > 0.055).cast("double").alias("label"),
        ((F.col("l_quantity") + 10 * F.col("l_linenumber")) / F.lit(120.0)).alias("score"),
    )


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three formula models side by side, ``price`` with nearly unique scores. One scan:
    each row fans out in place."""
    item = table(spark, sf_dir, "lineitem")
    formulas = {
        "mix": (F.col("l_quantity") + 10 * F.col("l_linenumber")) / F.lit(120.0),
        "price": F.col("l_extendedprice") / F.lit(100000.0),
        "tax": F.col("l_tax") / F.lit(0.08),
    }
    fan = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in formulas.items()])
    return item.select(
        (F.col("l_discount") > 0.055).cast("double").alias("label"),
        F.when(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "validation")
        .otherwise("test").alias("part"),
        F.inline(fan),
    )


ZONES_SQL = """zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS zone_id, min(r_name) AS grp
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey < 23 GROUP BY 1)"""

TRIPS_SQL = f"""WITH {ZONES_SQL},
trips AS (
  SELECT l_orderkey * 10 + l_linenumber AS trip_key, o_orderdate AS pickup_ts,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS payment_type,
         l_extendedprice AS fare_amount, l_extendedprice * l_discount AS tip_amount,
         l_quantity AS trip_distance, CAST(l_linenumber AS DOUBLE) AS passenger_count,
         substr(o_orderpriority, 1, 1) AS vendor, l_returnflag AS rate_code,
         c_nationkey AS zone_id, strftime(o_orderdate, '%Y-%m') AS year_month,
         (l_quantity + 10 * l_linenumber) / CAST(120.0 AS DOUBLE) AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey),
eligible AS (
  SELECT * FROM trips
  WHERE pickup_ts >= TIMESTAMP '1996-01-01' AND pickup_ts < TIMESTAMP '2002-01-01'
    AND payment_type = 1 AND fare_amount > 0 AND NOT isnan(fare_amount)
    AND tip_amount >= 0 AND NOT isnan(tip_amount) AND zone_id IS NOT NULL),
cohort AS (
  SELECT e.*, CASE WHEN tip_amount / fare_amount > CAST(0.055 AS DOUBLE) THEN CAST(1 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS label,
         coalesce(z.grp, 'Unknown') AS grp,
         CAST(hour(pickup_ts) AS VARCHAR) AS pickup_hour,
         CAST(dayofweek(pickup_ts) + 1 AS VARCHAR) AS pickup_dow,
         CAST(month(pickup_ts) AS VARCHAR) AS pickup_month,
         CAST(pickup_ts AS DATE) AS pickup_date
  FROM eligible e LEFT JOIN zones z ON e.zone_id = z.zone_id)
"""

RIDES_SQL = f"""WITH {ZONES_SQL},
rides AS (
  SELECT event_id, ts, value AS fare,
         CASE WHEN value > 50 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         coalesce(grp, 'Unknown') AS grp, event_type AS vendor,
         CAST(hour(ts) AS VARCHAR) AS hour, CAST(dayofweek(ts) + 1 AS VARCHAR) AS dow,
         CAST(day(ts) AS VARCHAR) AS month_day, CAST(ts AS DATE) AS day,
         strftime(ts, '%Y-%m-%d') AS day_key,
         CASE WHEN c_acctbal BETWEEN 0 AND 1e9 THEN c_acctbal END AS balance
  FROM events LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN zones ON c_nationkey = zone_id)
"""

SCORES_SQL = """WITH scores AS (
  SELECT CASE WHEN l_discount > CAST(0.055 AS DOUBLE) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         (l_quantity + 10 * l_linenumber) / CAST(120.0 AS DOUBLE) AS score
  FROM lineitem)
"""

MODEL_SCORES_SQL = """WITH base AS (
  SELECT CASE WHEN l_discount > CAST(0.055 AS DOUBLE) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'validation' ELSE 'test' END AS part, *
  FROM lineitem),
model_scores AS (
  SELECT label, part, 'mix' AS model, (l_quantity + 10 * l_linenumber) / CAST(120.0 AS DOUBLE) AS score FROM base
  UNION ALL SELECT label, part, 'price', l_extendedprice / CAST(100000.0 AS DOUBLE) FROM base
  UNION ALL SELECT label, part, 'tax', l_tax / CAST(0.08 AS DOUBLE) FROM base)
"""
