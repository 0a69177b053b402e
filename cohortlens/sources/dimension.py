"""Dimension and staged-table readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def one_row_per_key(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Drop NULL keys; of duplicate keys keep the smallest value, so reruns agree."""
    return frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def read_dimension(spark: SparkSession, path: str, key: str, value: str, *,
                   key_as: str, value_as: str) -> DataFrame:
    """Header CSV lookup: integer key (unparsable ones dropped) and one text value."""
    raw = spark.read.option("header", True).csv(path)
    named = raw.select(
        F.col(f"`{key}`").try_cast("int").alias(key_as), F.col(f"`{value}`").alias(value_as)
    )
    return one_row_per_key(named, key_as, value_as)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged Parquet; a missing folder is an error naming the stage to run."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no staged table at {path}: run the ingest stage first") from error


def preview(frame: DataFrame, columns: Sequence[str], order: Sequence[str], rows: int = 5) -> DataFrame:
    """First rows by key: a top-k plan, never a full sort."""
    return frame.select(*columns).orderBy(*order).limit(rows)
