"""Input perturbation and the comparison of metrics before and after it."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators.marts import exact_median

SHIFTED, MASKED = "hour_shifted", "group_masked"
COMPARED = ("positive_f1", "auc_roc", "auc_pr")


@dataclasses.dataclass(frozen=True)
class Change:
    """Rows whose draw lies in [start, end) get ``value`` in ``column``; the boolean column
    ``name`` marks those where that is a real change."""

    name: str
    start: float
    end: float
    column: str
    value: Column
    real: Column | None = None

    def hits(self, draw: Column) -> Column:
        return (draw >= F.lit(self.start)) & (draw < F.lit(self.end))


def shift_and_hide(share: float, cycle: str = "hour", period: int = 24, group: str = "grp", sentinel: str = "Unknown") -> list[Change]:
    """One half of the share has its cyclic value a step on, the other its group hidden."""
    middle = share / 2
    return [
        Change(SHIFTED, 0.0, middle, cycle, C.shift_cycle(cycle, period)),
        Change(MASKED, middle, share, group, F.lit(sentinel), F.col(group) != F.lit(sentinel)),
    ]


def perturb(frame: DataFrame, draw: Column, changes: Sequence[Change]) -> DataFrame:
    """The frame with the changes made and marked, in one projection; labels stay.

    ``draw`` is a number in [0, 1) per row; a key draw keeps the choice stable. The
    changes must leave some rows alone and may not overlap.
    """
    spans = sorted((c.start, c.end) for c in changes)
    whole = all(lo < hi for lo, hi in spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    if not spans or not whole or spans[0][0] < 0 or spans[-1][1] >= 1:
        raise ValueError("changes need disjoint, non-empty shares within [0, 1) that leave rows alone")
    at = "_draw"
    made: dict[str, Column] = {}
    for c in changes:
        hit = c.hits(F.col(at))
        made[c.name] = hit if c.real is None else hit & c.real
        made[c.column] = F.when(hit, c.value).otherwise(made.get(c.column, F.col(c.column)))
    return frame.withColumn(at, draw).withColumns(made).drop(at)


def tallies(perturbed: DataFrame) -> DataFrame:
    return perturbed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col(SHIFTED)).alias(SHIFTED),
        F.count_if(F.col(MASKED)).alias(MASKED),
    )


def metric_deltas(before: DataFrame, after: DataFrame, key: str = "model",
                  metrics: Sequence[str] = COMPARED, digits: int | None = None) -> DataFrame:
    """Signed changes and the impact |dF1| + |dROC| per model."""
    b = before.select(key, *[F.col(m).alias(f"base_{m}") for m in metrics])
    a = after.select(key, *[F.col(m).alias(f"perturbed_{m}") for m in metrics])

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    joined = b.join(a, key).withColumns(
        {f"delta_{m}": F.col(f"perturbed_{m}") - F.col(f"base_{m}") for m in metrics}
    )
    impact = F.abs(F.col("delta_positive_f1")) + F.abs(F.col("delta_auc_roc"))
    return joined.withColumn("impact_score", impact).select(
        key, *[shown(F.col(c)).alias(c) for c in (
            *[f"base_{m}" for m in metrics], *[f"perturbed_{m}" for m in metrics],
            *[f"delta_{m}" for m in metrics], "impact_score")]
    )


def rank_by_impact(deltas: DataFrame, key: str = "model") -> DataFrame:
    """Rank 1 is the most stable; names break ties. One row per model enters the window."""
    w = Window.orderBy("impact_score", key)
    ranked = deltas.withColumn("rank", F.row_number().over(w))
    last = F.max("rank").over(Window.partitionBy())
    stability = F.when(F.col("rank") == 1, "most stable").when(F.col("rank") == last, "least stable")
    return ranked.withColumn("stability", stability)


def delta_summary(trials: DataFrame, key: str = "model", metric: str = "delta_auc_pr",
                  digits: int | None = None) -> DataFrame:
    """Mean, median and largest absolute change over repeated trials.

    The median is picked by rank, so any number of trials will do.
    """
    size = F.abs(F.col(metric))
    middle = exact_median(trials.withColumn("_size", size), [key], "_size").select(key, "median")

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    summed = trials.groupBy(key).agg(F.count(F.lit(1)).alias("trials"), F.avg(size).alias("mean"), F.max(size).alias("largest"))
    return summed.join(middle, key, "left").select(
        key, "trials", shown(F.col("mean")).alias("mean_abs_delta"), shown(F.col("median")).alias("median_abs_delta"),
        shown(F.col("largest")).alias("max_abs_delta"))
