"""Eligible cohort, label, features, splits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.spec import CohortSpec, TimeSplit


def eligibility(frame: DataFrame, spec: CohortSpec) -> Column:
    """One predicate for the whole cohort rule.

    Every term is a bare column compared with a literal of the column's own type, so
    all of them reach the Parquet reader and prune row groups.
    """
    return (
        C.in_window(spec.time, frame.schema[spec.time].dataType, spec.window)
        & (F.col(spec.channel) == F.lit(spec.channel_code))
        & C.is_good_number(spec.base, strict=True)
        & C.is_good_number(spec.part)
        & F.col(spec.place).isNotNull()
    )


def eligible(frame: DataFrame, spec: CohortSpec) -> DataFrame:
    return frame.where(eligibility(frame, spec))


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left equi-join that keeps unmatched facts.

    No hint: a lookup file is broadcast by Catalyst's own size check, and a lookup
    beyond the threshold is shuffled, with adaptive splitting of hot keys.
    """
    if fact_key == dim_key:
        return fact.join(dim, fact_key, "left")
    return fact.join(dim, F.col(fact_key) == F.col(dim_key), "left")


def processed_columns(spec: CohortSpec) -> list[Column]:
    """The staged fact: label, event-time features, descriptive measures."""
    ts = F.col(spec.time)
    month = F.month(ts)
    return [
        C.ratio_label(spec.part, spec.base, spec.ratio).alias("label"),
        C.as_category(spec.group).alias(spec.group),
        C.as_category(spec.vendor).alias(spec.vendor),
        C.as_category(spec.late_code).alias(spec.late_code),
        C.within_or_null(spec.occupancy, *spec.occupancy_range).alias(spec.occupancy),
        F.hour(ts).cast("string").alias("pickup_hour"),
        F.dayofweek(ts).cast("string").alias("pickup_dow"),
        month.cast("string").alias("pickup_month"),
        C.cycle_sin(month, 12).alias("pickup_month_sin"),
        C.cycle_cos(month, 12).alias("pickup_month_cos"),
        F.to_date(ts).alias("pickup_date"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
        F.col(spec.place).alias(spec.place),
        F.col(spec.distance).alias(spec.distance),
        F.col(spec.base).alias(spec.base),
        F.col(spec.part).alias(spec.part),
    ]


def build_cohort(raw: DataFrame, dim: DataFrame, spec: CohortSpec,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Filter, enrich and project in one narrow stage (the join is map-side for a small
    dimension). ``keep`` carries key columns through."""
    joined = join_dimension(eligible(raw, spec), dim, spec.place, spec.dim_key)
    return joined.select(*keep, *processed_columns(spec))


def leakage(features: Iterable[str], forbidden: Iterable[str]) -> list[str]:
    return sorted(set(features) & set(forbidden))


def require_no_leakage(features: Iterable[str], forbidden: Iterable[str]) -> None:
    found = leakage(features, forbidden)
    if found:
        raise ValueError(f"columns not known at event time used as features: {found}")


def leakage_report(frame: DataFrame, features: Sequence[str], forbidden: Sequence[str]) -> DataFrame:
    """One row per candidate feature: forbidden or not, and how many rows fill it."""
    banned = set(forbidden)
    counted = frame.agg(*[F.count(F.col(c)).alias(c) for c in features])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(c in banned).alias("forbidden"),
                 F.col(c).alias("filled_rows"))
        for c in features
    ])
    return counted.select(F.inline(rows))


def split_name(split: TimeSplit) -> Column:
    p = F.col(split.period)
    return (
        F.when(p < F.lit(split.validation_from), F.lit("train"))
        .when(p < F.lit(split.test_from), F.lit("validation"))
        .when(p.isNotNull(), F.lit("test"))
    )


def split_frames(frame: DataFrame, split: TimeSplit) -> dict[str, DataFrame]:
    """Three frames by plain comparison on the period key: partition pruning applies."""
    p = F.col(split.period)
    return {
        "train": frame.where(p < F.lit(split.validation_from)),
        "validation": frame.where((p >= F.lit(split.validation_from)) & (p < F.lit(split.test_from))),
        "test": frame.where(p >= F.lit(split.test_from)),
    }


def class_weights(frame: DataFrame, label: str = "label") -> DataFrame:
    """Inverse-prevalence weights, one row. A missing class is an error."""
    y = F.col(label)
    counted = frame.agg(
        F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives")
    )
    total = F.col("negatives") + F.col("positives")
    one_class = (F.col("negatives") == 0) | (F.col("positives") == 0)

    def weight(count: str) -> Column:
        value = F.try_divide(total.cast("double"), (F.lit(2) * F.col(count)).cast("double"))
        return F.when(one_class, F.raise_error(F.lit("both classes are needed"))).otherwise(value)

    return counted.select(
        "negatives", "positives",
        weight("negatives").cast("double").alias("w_negative"),
        weight("positives").cast("double").alias("w_positive"),
    )


def apply_weights(frame: DataFrame, weights: DataFrame, label: str = "label",
                  column: str = "class_weight") -> DataFrame:
    """Weight column from the one-row weight frame, as a scalar subquery: no join."""
    w = weights.select(F.struct("w_negative", "w_positive")).scalar()
    y = F.col(label)
    return frame.withColumn(
        column, F.when(y == 1, w.getField("w_positive")).otherwise(w.getField("w_negative"))
    )


def with_pinned_weights(frame: DataFrame, label: str = "label", column: str = "class_weight") -> DataFrame:
    """Same, with the two numbers fixed up front: iterative fits scan the frame often."""
    w = class_weights(frame, label).first()
    y = F.col(label)
    return frame.withColumn(column, F.when(y == 1, F.lit(w.w_positive)).otherwise(F.lit(w.w_negative)))
