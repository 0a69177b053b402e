"""Where intermediate tables live: the folder every executor can reach."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch(spark.sparkContext.applicationId)


_LIVES: list[set[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _LIVES:
        _LIVES[-1].add(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def paths_read(frame: DataFrame) -> str:
    """Where a frame's plan reads, subqueries included, as Spark's explanation says it."""
    conf = frame.sparkSession.conf
    held = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", str(1 << 24))
    try:
        return frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        conf.set("spark.sql.maxMetadataStringLength", held)


@contextlib.contextmanager
def scratch_life(spark: SparkSession):
    """Notes every fresh path made inside. ``keep(frame)`` says that a frame leaves; at the
    end all noted tables go but those that such a frame still reads."""
    made: set[str] = set()
    needed: list[str] = []

    def keep(frame: DataFrame) -> DataFrame:
        needed.append(paths_read(frame) if made else "")
        return frame

    _LIVES.append(made)
    try:
        yield keep
    finally:
        _LIVES.remove(made)
        for path in made:
            if not any(path.rpartition("/")[2] in plan for plan in needed):
                remove(spark, path)


def freeze(frame: DataFrame, label: str = "frozen", partition_by: str | None = None) -> DataFrame:
    """Write once, read back: fixes random draws and costly scores for every later
    action, and cuts the lineage so a lost executor re-reads files, not the plan."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    writer = frame.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # the written schema is known: no footer inference job
    return spark.read.schema(frame.schema).parquet(path)


def pin_small(frame: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Compute a small aggregate once and mark the result for broadcast.

    The row count is checked first: an aggregate beyond ``max_rows`` comes back as it
    was and joins by shuffle. The rows return as a local relation, so a frame read by
    several joins is not computed again for each.
    """
    rows = frame.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return frame
    return F.broadcast(frame.sparkSession.createDataFrame(rows, frame.schema))
