"""Shared table helpers: reading, scratch tables, row numbers, bit filters, components."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.sources.shared import fresh_path

# Words as all word-based operators read them, and what stands between them.
WORD = r"[^\x20\x09-\x0D]+"
# Bits of a filter: 4 MB broadcast, whatever the input. A full filter only stops filtering.
# Where that would cost disk, a filter of many values has up to 16 MB (``roomy_bits``).
FILTER_BITS, MOST_FILTER_BITS = 1 << 25, 1 << 27


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spare_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores before it until no column of the frame has the name."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends, on all executors,
    and not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


class Scratch:
    """Tables written below ``spark.checkpoint.dir`` and read back: they cut lineage, fix
    every draw, and outlive executors. ``drop`` removes those no later plan reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def keep(self, frame: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        with brief_shuffles(self.spark):
            frame.write.mode("errorifexists").parquet(path)
        back = self.spark.read.schema(frame.schema).parquet(path)
        self._paths[id(back)] = path
        back._scratch = self
        return back

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for frame in frames:
            if path := self._paths.pop(id(frame), None):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)


def number_rows(frame: DataFrame, keys: list[Column], scratch: Scratch, name: str = "row_number") -> tuple[DataFrame, int]:
    """The frame with gapless row numbers from 0 in key order, and the row count.

    Rows are range-partitioned by the keys, a hash of the row and their place in the scan
    (so many equal rows still spread), written once, and numbered by adding up the sizes
    of the partitions before. Equal rows may swap numbers, which changes no result.
    """
    mark, where = spare_name(frame, "mark"), spare_name(frame, "scan_place")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns])
    ranged = frame.withColumn(where, F.monotonically_increasing_id())
    order = [*keys, whole, F.col(where)]
    kept = scratch.keep(
        ranged.repartitionByRange(*order).sortWithinPartitions(*order).drop(where)
        .withColumn(mark, F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright(mark, 33), F.col(mark).bitwiseAND((1 << 33) - 1)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the write
    starts = scratch.keep(sizes.select(F.col("_part"), "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")), "starts")
    n = starts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    at, first = spare_name(kept, "part"), spare_name(kept, "start")
    starts = starts.select(F.col("_part").alias(at), F.col("_start").alias(first))
    out = kept.withColumn(at, part).join(F.broadcast(starts), at)
    return out.withColumn(name, F.col(first) + place).drop(at, first, mark), n


def running_sums(frame: DataFrame, group: str, order: list[str], value: str, scratch: Scratch, name: str = "upto") -> DataFrame:
    """Adds the inclusive running sum of ``value`` within ``group`` in the order given.

    A hot group is cut into ranges; each range is summed by one task and starts at the
    total of the ranges before it. Rows should be narrow and unique in (group, order).
    """
    keys = [group, *order]
    kept = scratch.keep(frame.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = kept.groupBy(group, "_part").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    starts = scratch.keep(starts, "range-starts")
    upto = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = kept.withColumn("_local", F.sum(value).over(upto))
    a, b = local.alias("a"), starts.alias("b")
    joined = a.join(b, F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")) & (F.col("a._part") == F.col("b._part")))
    return joined.select("a.*", (F.col("a._local") + F.col("b._start")).alias(name)).drop("_part", "_local")


def bit_of(hashes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """Which bit stands for a 64-bit value; the JVM side is in ``bit_filter``."""
    return (hashes.view(np.int64) & np.int64(bits - 1)).astype(np.int64)


def has_bit(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = bit_of(hashes, filter_.size * 8)
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def roomy_bits(values: int) -> int:
    """Bits for a filter of so many values that sets one in eight of them at most, as far as they go."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, 1 << (8 * values - 1).bit_length())) if values else FILTER_BITS


def bit_filter(values: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit for the low bits of every 64-bit value in the column, never a false zero.

    Bits are merged in the tasks; at most ``bits / 32`` words reach the driver.
    """
    low = F.col(column).bitwiseAND(bits - 1)
    words = values.where(F.col(column).isNotNull()).groupBy(F.shiftright(low, 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 31L as int))")).alias("set"))
    with brief_shuffles(values.sparkSession):
        got = words.toArrow()
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[got["word"].to_numpy()] = got["set"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def components(edges: DataFrame, scratch: Scratch, rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node that each end of the edges (a, b) can reach.

    Alternates large-star and small-star contraction; every round is written, so lineage
    stays short. Only aggregates with partial sums and equi-joins against written tables,
    which adaptive execution can split, so a star of any size is no hot task.
    """
    def tidy(frame: DataFrame) -> DataFrame:
        return scratch.keep(frame.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def print_of(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = tidy(edges.where("a is not null and b is not null"))
    seen = print_of(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mins = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "mins")
        large = tidy(both.join(mins, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        lows = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")), "mins")
        joined = large.join(lows, "a")
        small = tidy(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lows.select("a", F.col("m").alias("b"))))
        was, seen = seen, print_of(small)
        scratch.drop(now, mins, large, lows)
        now = small
        if seen == was:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def contract(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) for both ends of the edges (a, b), one root a component, whichever it is.

    In each round every node moves to the neighbour whose hash is least, itself included,
    and edges follow their ends, so most nodes go and edges inside one place end; a star
    takes two rounds. A round is one aggregate with partial minima; ``components``, which
    also finds the smallest node, takes several.
    """
    now = scratch.keep(edges.where("a <> b").select("a", "b"), "edges")
    moves = []
    for _ in range(rounds):
        if now.isEmpty():
            break
        rank = F.xxhash64
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("rank"), F.col("b").alias("to"))).alias("least"))
        move = scratch.keep(least.select(F.col("a").alias("node"), F.when(F.col("least.rank") < rank("a"), F.col("least.to")).otherwise(F.col("a")).alias("root")), "moves")
        moves.append(move)
        x, y = move.alias("x"), move.alias("y")
        moved = now.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).select(F.col("x.root").alias("a"), F.col("y.root").alias("b"))
        moved = scratch.keep(moved.where("a <> b"), "edges")
        scratch.drop(now)
        now = moved
    else:
        raise RuntimeError("components did not settle")
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false") if not moves else moves[0]
    for move in moves[1:]:
        later = move.select(F.col("node").alias("_at"), F.col("root").alias("_to"))
        out = out.join(later, out["root"] == later["_at"], "left").select("node", F.coalesce("_to", "root").alias("root"))
    return out


def extend(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Roots (node, root) after more links (a, b) between nodes, known or new."""
    x, y = roots.alias("x"), roots.alias("y")
    ends = links.join(x, F.col("a") == F.col("x.node"), "left").join(y, F.col("b") == F.col("y.node"), "left").select(
        F.coalesce("x.root", "a").alias("a"), F.coalesce("y.root", "b").alias("b"))
    more = scratch.keep(contract(ends, scratch), "more-roots").select(F.col("node").alias("_at"), F.col("root").alias("_to"))
    known = roots.join(more, roots["root"] == more["_at"], "left").select("node", F.coalesce("_to", "root").alias("root"))
    fresh = more.join(roots, more["_at"] == roots["node"], "left_anti").select(F.col("_at").alias("node"), F.col("_to").alias("root"))
    return known.union(fresh)
