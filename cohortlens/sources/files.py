"""File-level sources: inventory, completeness, integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """Path and size of each file, from the listing alone: the content column is pruned."""
    load = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(load)
    return listed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
    )


def table_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Name, bytes and rows of each Parquet file, files without rows left out.

    No stored column is read: Spark's reader counts rows from the footers, and names come
    from its file metadata, whatever the schemas of the files.
    """
    load = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.schema("`_absent` string").option("pathGlobFilter", "*.parquet").parquet(*load)
    return rows.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def missing_files(inventory: DataFrame, expected: Sequence[str]) -> DataFrame:
    """All expected names that the listing lacks."""
    wanted = inventory.sparkSession.createDataFrame([(n,) for n in expected], "file_name string")
    return wanted.join(inventory.select("file_name"), "file_name", "left_anti")


def require_files(inventory: DataFrame, expected: Sequence[str]) -> None:
    absent = sorted(r.file_name for r in missing_files(inventory, expected).collect())
    if absent:
        raise FileNotFoundError(f"missing input files: {absent}")


def locate(uri: str):
    """The Arrow file system and inner path behind a Spark file path."""
    from pyarrow import fs

    for spark_scheme in ("s3a://", "s3n://"):
        if uri.startswith(spark_scheme):
            uri = "s3://" + uri[len(spark_scheme):]
    return fs.FileSystem.from_uri(uri)


def _open_stream(uri: str):
    store, path = locate(uri)
    return store.open_input_stream(path)


def _digest_files(batches):
    import hashlib

    for batch in batches:
        shas, heads, tails = [], [], []
        for uri in batch["path"]:
            sha, head, tail = hashlib.sha256(), b"", b""
            with _open_stream(uri) as stream:
                while chunk := stream.read(8 << 20):
                    sha.update(chunk)
                    head = (head + chunk[:4])[:4]
                    tail = (tail + chunk[-4:])[-4:]
            shas.append(sha.hexdigest())
            heads.append(head)
            tails.append(tail)
        out = batch[["path", "file_name", "bytes"]].copy()
        out["sha256"] = shas
        out["is_parquet"] = [
            h == b"PAR1" and t == b"PAR1" and n >= 8
            for h, t, n in zip(heads, tails, batch["bytes"])
        ]
        yield out


# Files up to so many bytes are hashed as one row; two of them fit a task beside their copies.
ROW_BYTES = 128 << 20


def file_manifest(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.parquet", row_bytes: int = ROW_BYTES) -> DataFrame:
    """Digest, size and format magic per file; ``read_as`` says how it was read.

    Files up to ``row_bytes`` are rows of Spark's own reader, opened by Spark's file systems
    and hashed inside the JVM; the length is asked before the content is read. Longer files
    do not fit a row: they are streamed in 8 MiB pieces, which takes constant memory, by the
    Arrow file system of their address. The digest is SHA-256 of the whole file either way.
    """
    load = [paths] if isinstance(paths, str) else list(paths)
    whole = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(load).where(F.col("length") <= row_bytes)
    magic = F.lit(b"PAR1")
    rows = whole.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"),
        ((F.col("length") >= 8) & (F.substring("content", 1, 4) == magic) & (F.substring("content", -4, 4) == magic)).alias("is_parquet"), F.lit("row").alias("read_as"))
    long = file_inventory(spark, load, glob).where(F.col("bytes") > row_bytes)
    streamed = long.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(
        _digest_files, "path string, file_name string, bytes long, sha256 string, is_parquet boolean")
    return rows.union(streamed.withColumn("read_as", F.lit("stream")))
