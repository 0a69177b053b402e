"""Grouped rates, suppressed marts, pivots, top cells, cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.cohort import split_name
from cohortlens.operators.evaluation import cumulative_counts
from cohortlens.sources.shared import pin_small
from cohortlens.spec import TimeSplit


def rows_by(frame: DataFrame, *keys: str | Column) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def group_rates(frame: DataFrame, keys: Sequence[str], *, label: str = "label",
                minimum: int = 0, rate: str = "rate", measures: dict[str, Column] | None = None,
                digits: int | None = None) -> DataFrame:
    """Count, mean label and further aggregates per cell; cells under ``minimum`` are
    withheld. Partial aggregation keeps the shuffle at one row per cell and task, so a
    hot cell costs no more than a cold one."""
    def shown(c: Column, name: str) -> Column:
        return (c if digits is None else F.round(c, digits)).alias(name)

    grouped = frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        shown(F.avg(label), rate),
        *[shown(c, name) for name, c in (measures or {}).items()],
    )
    return grouped.where(F.col("n") >= F.lit(minimum)) if minimum > 0 else grouped


def mean_money(column: str) -> Column:
    """Mean of an amount in cents precision. Whole cents add up exactly, so the mean does
    not depend on the order in which tasks deliver their partial sums."""
    return F.avg(F.floor(F.col(column) * 100 + 0.5)) / F.lit(100.0)


def split_totals(frame: DataFrame, split: TimeSplit) -> DataFrame:
    """Rows and positives per period, per split and overall: the wide input is read once,
    the roll-up works on period counts."""
    cells = frame.groupBy(split.period).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("p")
    )
    rolled = cells.withColumn("split", split_name(split)).rollup("split", split.period).agg(
        F.sum("n").alias("rows"), F.sum("p").alias("positives"),
        F.grouping_id("split", split.period).alias("gid"),
    )
    level = F.when(F.col("gid") == 0, "period").when(F.col("gid") == 1, "split").otherwise("total")
    return rolled.select(
        level.alias("level"), F.coalesce("split", F.lit("all")).alias("split"),
        F.coalesce(split.period, F.lit("all")).alias("period"), "rows", "positives",
    )


def pivot_labels(frame: DataFrame, period: str, label: str = "label") -> DataFrame:
    """Period by label counts, zero filled; columns are declared, so no distinct job."""
    y = F.col(label)
    return frame.groupBy(period).agg(
        F.count_if(y == 0).alias("label_0"), F.count_if(y == 1).alias("label_1")
    )


def latest_period_heatmap(frame: DataFrame, period: str, group: str, column: str,
                          values: Sequence[int], *, label: str = "label", minimum: int = 1,
                          prefix: str = "h", digits: int | None = None) -> DataFrame:
    """Group by column rates for the latest period; withheld cells stay NULL.

    The period bound is a scalar subquery: on a staged table it prunes partitions.
    """
    last = frame.agg(F.max(period)).scalar()
    cells = group_rates(
        frame.where(F.col(period) == last), [group, column], label=label, minimum=minimum, digits=digits
    )
    return (
        cells.groupBy(group).pivot(column, [str(v) for v in values]).agg(F.first("rate"))
        .select(group, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])
    )


def top_cells(frame: DataFrame, keys: Sequence[str], count: int, *, label: str = "label",
              digits: int | None = None) -> DataFrame:
    """Largest cells first, keys breaking ties: a bounded top-k, not a full sort."""
    cells = group_rates(frame, keys, label=label, digits=digits)
    return cells.orderBy(F.desc("n"), *keys).limit(count)


def exact_median(frame: DataFrame, keys: Sequence[str], value: str, *,
                 slices: int | None = None) -> DataFrame:
    """Rows and exact median per group, NULLs left out.

    The built-in ``median`` keeps every distinct value of a group in one task. Here
    values fold to counts, running counts come from the ranges of the
    evaluation module, and the one or two middle values are picked by rank.
    """
    rows = frame.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("score"), F.lit(0.0).alias("label"))
    totals = pin_small(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    # "fp" counts the rows at or above a value: its lowest rank follows from the total
    first, size = F.col("n") - F.col("fp"), F.col("neg")

    def holds(rank: Column) -> Column:
        return (first <= rank) & (rank < first + size)

    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = cumulative_counts(rows, keys, slices=slices).join(totals, list(keys))
    return middle.where(holds(low) | holds(high)).groupBy(*keys).agg(
        F.max("n").alias("n"), ((F.min("score") + F.max("score")) / 2.0).alias("median"))


def median_timings(frame: DataFrame, keys: Sequence[str], seconds: str) -> DataFrame:
    return exact_median(frame, keys, seconds).withColumnsRenamed({"n": "runs", "median": "median_seconds"})


# The cost table's columns and source notes.
UNPRICED = "unpriced"
BENCHMARK_ONLY = "benchmark only"
PRICED_NOTE = "(cluster rate only; no storage/egress)"
COST_COLUMNS = (
    "experiment", "model", "config", "sample_fraction", "rows", "wall_seconds",
    "usd_estimate", "cost_source",
)


def cost_table(measurements: DataFrame, price_per_hour: float | None = None, source: str = "") -> DataFrame:
    """Price every measurement, or mark it unpriced. A price needs a positive value and
    an https source."""
    seconds = F.round(F.col("wall_seconds"), 3)
    if price_per_hour is None:
        usd = F.lit(None).cast("double")
        note = F.when(F.col("experiment") == "training", UNPRICED).otherwise(BENCHMARK_ONLY)
    else:
        if not price_per_hour > 0 or not source.startswith("https://"):
            raise ValueError("a cluster price must be positive and cite an https source")
        usd = F.round(seconds / F.lit(3600.0) * F.lit(float(price_per_hour)), 4)
        note = F.lit(f"{source} {PRICED_NOTE}")
    return measurements.select(
        "experiment", "model", "config", "sample_fraction", "rows",
        seconds.alias("wall_seconds"), usd.alias("usd_estimate"), note.alias("cost_source"),
    )
