"""Writers: partitioned Parquet, ordered CSV, finite-only JSON."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(frame: DataFrame, path: str, period: str, cluster_by: Sequence[str] = ()) -> None:
    """Period-partitioned Parquet, overwriting.

    ``rebalance`` gathers each period for few, well-sized files; the adaptive planner
    splits a period (or any hot key) that outgrows one task, so a third of all rows in
    one period does not become one writer. Sorting inside each task tightens the
    row-group statistics of the clustering columns.
    """
    spread = frame.hint("rebalance", period)
    if cluster_by:
        spread = spread.sortWithinPartitions(period, *cluster_by)
    spread.write.mode("overwrite").partitionBy(period).parquet(path)


def write_csv(frame: DataFrame, path: str, headers: Sequence[str]) -> None:
    """CSV in the given column order; extra columns are ignored, absent ones blank.

    An empty frame is refused. The emptiness probe reads one row.
    """
    if frame.isEmpty():
        raise ValueError(f"no rows to export to {path}")
    have = set(frame.columns)
    picked = [F.col(h) if h in have else F.lit(None).cast("string").alias(h) for h in headers]
    frame.select(*picked).write.mode("overwrite").option("header", True).csv(path)


def _leaf_checks(column, data_type) -> list:
    """Non-finite tests for every float leaf below a column, structs and arrays included."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return [F.isnan(column) | (F.abs(column) == F.lit(float("inf")))]
    if isinstance(data_type, T.StructType):
        return [t for f in data_type for t in _leaf_checks(column.getField(f.name), f.dataType)]
    if isinstance(data_type, T.ArrayType) and _leaf_checks(F.lit(None), data_type.elementType):
        def bad(x):
            tests = _leaf_checks(x, data_type.elementType)
            out = tests[0]
            for t in tests[1:]:
                out = out | t
            return F.coalesce(out, F.lit(False))
        return [F.exists(column, bad)]
    return []


def non_finite_counts(frame: DataFrame) -> DataFrame:
    """Rows with NaN or infinity per column, one pass; columns without floats are left out."""
    counts = []
    for f in frame.schema:
        tests = _leaf_checks(F.col(f"`{f.name}`"), f.dataType)
        if not tests:
            continue
        hit = F.lit(False)
        for t in tests:
            hit = hit | F.coalesce(t, F.lit(False))
        counts.append(F.count_if(hit).alias(f.name))
    if not counts:
        return frame.agg(F.count(F.lit(1)).alias("rows"))
    return frame.agg(F.count(F.lit(1)).alias("rows"), *counts)


def write_json(frame: DataFrame, path: str) -> None:
    """JSON lines, refused when any number is not finite.

    Written beside the target and moved into place when complete, so a failing write leaves
    what was there before."""
    found = non_finite_counts(frame).first().asDict()
    bad = {k: v for k, v in found.items() if k != "rows" and v}
    if bad:
        raise ValueError(f"non-finite numbers in {bad}")
    spark = frame.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh, old = (paths(f"{path.rstrip('/')}{tail}") for tail in ("", f".new-{uuid.uuid4().hex}", f".old-{uuid.uuid4().hex}"))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        frame.write.mode("errorifexists").json(fresh.toString())
        there = store.exists(target)
        if there and not store.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not store.rename(fresh, target):
            if there:
                store.rename(old, target)
            raise OSError(f"cannot publish {path}")
        store.delete(old, True)
    finally:
        store.delete(fresh, True)
