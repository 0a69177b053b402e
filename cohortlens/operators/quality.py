"""Data-quality counts and gates, each from a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import columns as C
from cohortlens.operators.cohort import eligibility, split_name
from cohortlens.spec import CohortSpec, TimeSplit

FLAGS = (
    "outside_window", "wrong_channel", "invalid_base", "invalid_part", "missing_place",
    "missing_occupancy", "invalid_occupancy", "missing_vendor", "missing_late_code",
)


def flag_conditions(frame: DataFrame, spec: CohortSpec) -> dict[str, Column]:
    """Nine overlapping flags; a row may raise several."""
    low, high = spec.occupancy_range
    people = F.col(spec.occupancy)
    in_time = C.in_window(spec.time, frame.schema[spec.time].dataType, spec.window)
    tests = (
        C.failed(in_time),
        C.failed(F.col(spec.channel) == F.lit(spec.channel_code)),
        C.failed(C.is_good_number(spec.base, strict=True)),
        C.failed(C.is_good_number(spec.part)),
        F.col(spec.place).isNull(),
        people.isNull(),
        (people < F.lit(low)) | (people > F.lit(high)),
        F.col(spec.vendor).isNull(),
        F.col(spec.late_code).isNull(),
    )
    return dict(zip(FLAGS, tests))


def _flag_counts(frame: DataFrame, spec: CohortSpec) -> list[Column]:
    return [F.count_if(test).alias(name) for name, test in flag_conditions(frame, spec).items()]


def quality_flags(frame: DataFrame, spec: CohortSpec) -> DataFrame:
    """All flags and the row count in one aggregate; zeros on empty input."""
    return frame.agg(F.count(F.lit(1)).alias("raw_rows"), *_flag_counts(frame, spec))


def quality_table(frame: DataFrame, spec: CohortSpec, period: str, source_bytes: int | None = None) -> DataFrame:
    """Long table (section, metric, key, value): overall funnel, flags, clean rows per period,
    and the size of the source where it is given.

    Rows are aggregated once per period; the roll-up runs on that small result, so the
    wide input is neither scanned twice nor expanded.
    """
    per_period = frame.groupBy(period).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(eligibility(frame, spec)).alias("clean_rows"),
        *_flag_counts(frame, spec),
    )
    measures = ["raw_rows", "clean_rows", *FLAGS]
    rolled = per_period.rollup(period).agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping(period).alias("is_total")
    )

    def entry(section: str, metric: str, key: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(metric).alias("metric"),
            key.alias("key"), F.col(metric).alias("value"),
        )

    whole = F.lit("all")
    totals = [entry("overall", m, whole) for m in ("raw_rows", "clean_rows")]
    if source_bytes is not None:
        totals.append(F.struct(F.lit("overall").alias("section"), F.lit("source_bytes").alias("metric"), whole.alias("key"),
                               F.lit(source_bytes).cast("long").alias("value")))
    totals += [entry("quality_nonexclusive", m, whole) for m in FLAGS]
    period_key = F.coalesce(F.col(period).cast("string"), F.lit("Unknown"))
    monthly = entry("month", "clean_rows", period_key)
    rows = F.when(F.col("is_total") == 1, F.array(*totals)).otherwise(
        F.when(F.col("clean_rows") > 0, F.array(monthly))
    )
    return rolled.select(F.inline(rows))


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "numeric" if isinstance(data_type, T.NumericType) else "categorical"


def _sketched_counts(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, rows, filled, distinct_values) with one-pass sketches, one aggregate."""
    wide = frame.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"filled_{i}") for i, c in enumerate(names)],
        *[F.approx_count_distinct(c).alias(f"distinct_{i}") for i, c in enumerate(names)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("rows"), F.col(f"filled_{i}").alias("filled"), F.col(f"distinct_{i}").alias("distinct_values"))
        for i, c in enumerate(names)])))


def _exact_counts(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same with exact distinct values: narrow rows of a column's number and the 64-bit
    hash of a value are folded in the tasks before anything is shuffled, so each distinct
    value costs some bytes a task, however wide the frame. Number -1 counts the rows."""
    def hashed(c: str) -> Column:  # every NaN is one value, and -0.0 is 0.0
        floating = isinstance(frame.schema[c].dataType, (T.DoubleType, T.FloatType))
        return F.xxhash64(F.when(F.isnan(c), F.lit(float("nan"))).otherwise(F.col(c) + F.lit(0.0)) if floating else F.col(c))

    every = F.struct(F.lit(-1).alias("place"), F.lit(0).cast("long").alias("value"))
    cells = F.array(every, *[F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("place"), hashed(c).alias("value"))) for i, c in enumerate(names)])
    folded = frame.select(F.explode(F.array_compact(cells)).alias("cell")).groupBy("cell.place", "cell.value").agg(F.count(F.lit(1)).alias("n"))
    each = folded.groupBy("place").agg(F.sum("n").alias("filled"), F.count(F.lit(1)).alias("distinct_values"))
    found = each.agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct("filled", "distinct_values")))).alias("m"))  # a row a column
    of = lambda i, f: F.coalesce(F.try_element_at("m", F.lit(i)).getField(f), F.lit(0).cast("long"))
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), of(-1, "filled").alias("rows"), of(i, "filled").alias("filled"), of(i, "distinct_values").alias("distinct_values"))
        for i, c in enumerate(names)])))


def column_profile(frame: DataFrame, columns: Sequence[str] | None = None, *, exact: Sequence[str] = ()) -> DataFrame:
    """Missing share, distinct values and type family per column.

    Distinct values are one-pass sketches, but for the columns named in ``exact``, whose
    values are folded by their hashes: two values share one about once in 2**64 pairs.
    """
    names = list(columns or frame.columns)
    types = {f.name: _family(f.dataType) for f in frame.schema}
    exactly, roughly = [c for c in names if c in exact], [c for c in names if c not in exact]
    parts = [*([_exact_counts(frame, exactly)] if exactly else []), *([_sketched_counts(frame, roughly)] if roughly else [])]
    counts = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    family = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    return counts.select(
        "column_name", family[F.col("column_name")].alias("family"),
        F.round(F.lit(100.0) * C.safe_ratio(F.col("rows") - F.col("filled"), F.col("rows")), 6).alias("missing_pct"), "distinct_values")


def column_sketches(frame: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """(period, column_name, rows, filled, sketch): mergeable counts of distinct values.

    One aggregate over the frame. The rows can be kept: when a period is added or read
    anew only its own rows are made again, and ``merge_sketches`` gives the whole.
    """
    as_text = lambda c: F.col(c).cast("string")
    wide = frame.groupBy(F.col(period).alias("period")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"filled_{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(as_text(c), F.lit(14)).alias(f"sketch_{i}") for i, c in enumerate(columns)])
    return wide.select("period", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("rows"), F.col(f"filled_{i}").alias("filled"), F.col(f"sketch_{i}").alias("sketch")) for i, c in enumerate(columns)])))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Missing share and estimated distinct values per column over all periods given."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.round(F.lit(100.0) * C.safe_ratio(F.sum("rows") - F.sum("filled"), F.sum("rows")), 6).alias("missing_pct"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def volume_gate(frame: DataFrame, total_bytes: int, *, min_rows: int, min_columns: int,
                min_bytes: int) -> DataFrame:
    """Named volume checks as one row of booleans."""
    return frame.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(frame.columns)).cast("bigint").alias("columns"),
        (F.col("rows") >= F.lit(min_rows)).alias("enough_rows"),
        F.lit(len(frame.columns) >= min_columns).alias("enough_columns"),
        F.lit(total_bytes >= min_bytes).alias("enough_bytes"),
    )


def split_gate(frame: DataFrame, split: TimeSplit, *, minimum: int = 1, label: str = "label") -> DataFrame:
    """Per split: rows, positives, and the gates a fit relies on. Empty splits show up."""
    part, y = split_name(split), F.col(label)
    names = ("train", "validation", "test")
    wide = frame.select(part.alias("_part"), y.alias("_y")).agg(
        *[F.count_if(F.col("_part") == n).alias(f"{n}_rows") for n in names],
        *[F.count_if((F.col("_part") == n) & (F.col("_y") == 1)).alias(f"{n}_pos") for n in names],
    )

    def entry(n: str) -> Column:
        rows, pos = F.col(f"{n}_rows"), F.col(f"{n}_pos")
        return F.struct(
            F.lit(n).alias("split"), rows.alias("rows"), pos.alias("positives"),
            (rows > 0).alias("non_empty"), ((pos > 0) & (pos < rows)).alias("both_classes"),
            (rows >= F.lit(minimum)).alias("large_enough"),
        )

    return wide.select(F.inline(F.array(*[entry(n) for n in names])))


def require_gate(gate: DataFrame) -> None:
    """Raise when any boolean column of a (small) gate frame is false."""
    checks = [f.name for f in gate.schema if isinstance(f.dataType, T.BooleanType)]
    broken = gate.agg(*[F.count_if(~F.coalesce(F.col(c), F.lit(False))).alias(c) for c in checks]).first()
    bad = [c for c in checks if broken[c]]
    if bad:
        raise ValueError(f"gate failed: {bad}")


def reconcile_cohorts(base: DataFrame, other: DataFrame, label: str = "label") -> DataFrame:
    """Same rows and same positives on both sides? One row, one aggregate."""
    sides = base.select(F.lit(0).alias("side"), F.col(label).alias("y")).unionByName(
        other.select(F.lit(1).alias("side"), F.col(label).alias("y"))
    )
    side, y = F.col("side"), F.col("y")
    counted = sides.agg(
        F.count_if(side == 0).alias("base_rows"),
        F.count_if(side == 1).alias("other_rows"),
        F.count_if((side == 0) & (y == 1)).alias("base_positives"),
        F.count_if((side == 1) & (y == 1)).alias("other_positives"),
    )
    return counted.select(
        "*",
        (F.col("base_rows") == F.col("other_rows")).alias("same_rows"),
        (F.col("base_positives") == F.col("other_positives")).alias("same_positives"),
    )


def volume_summary(frame: DataFrame, spec: CohortSpec, period: str, source_columns: Sequence[int]) -> DataFrame:
    """Volume, spread over periods, source width, and invalid counts in one row."""
    invalid = ("outside_window", "invalid_base", "invalid_part", "missing_place")
    tests = flag_conditions(frame, spec)
    per_period = frame.groupBy(period).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(tests[k]).alias(k) for k in invalid]
    )
    return per_period.agg(
        F.sum("n").alias("raw_rows"),
        F.count(F.lit(1)).alias("periods"),
        F.min("n").alias("min_period_rows"),
        F.max("n").alias("max_period_rows"),
        *[F.sum(k).alias(k) for k in invalid],
    ).withColumns({
        "min_source_columns": F.lit(min(source_columns)).cast("bigint"),
        "max_source_columns": F.lit(max(source_columns)).cast("bigint"),
    })
