"""Ready-made roles for public monthly trip-record files."""

from __future__ import annotations

from pyspark.sql import types as T

from cohortlens.spec import CohortSpec, FeatureSpec, TimeSplit

# The canonical columns of the public trip-record files, in file order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

# Columns without which a file is refused.
TRIP_REQUIRED = (
    "tpep_pickup_datetime",
    "PULocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
)

# Measured at or after the end of the trip, so never model inputs.
TRIP_FORBIDDEN = (
    "tip_amount",
    "fare_amount",
    "total_amount",
    "trip_distance",
    "tpep_dropoff_datetime",
    "DOLocationID",
    "payment_type",
    "RatecodeID",
)

TRIP_COHORT = CohortSpec(
    time="tpep_pickup_datetime",
    place="PULocationID",
    group="pickup_borough",
    vendor="VendorID",
    late_code="RatecodeID",
)

TRIP_SPLIT = TimeSplit(validation_from="2019-10", test_from="2019-11")

# Vocabularies declared before fitting.
TRIP_FEATURES = FeatureSpec(
    numeric=("passenger_count",),
    vocabulary={
        "pickup_borough": (
            "Bronx", "Brooklyn", "EWR", "Manhattan", "Queens", "Staten Island", "Unknown",
        ),
        "VendorID": ("1", "2", "4", "Unknown"),
        "pickup_hour": tuple(str(h) for h in range(24)),
        "pickup_dow": tuple(str(d) for d in range(1, 8)),
    },
    cyclic=("pickup_month", 12),
    forbidden=TRIP_FORBIDDEN,
)
