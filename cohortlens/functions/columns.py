"""Scalar column builders. All stay inside built-in, code-generated expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_category", "band", "cycle_cos", "cycle_sin", "day_fold", "day_number", "decide",
    "distance_band", "failed", "hash_draw", "in_window", "is_good_number", "key_draw",
    "poisson_weight", "ratio_label", "safe_ratio", "score_bucket", "shift_cycle",
    "typed_literal", "within_or_null",
]


def typed_literal(value, data_type) -> Column:
    """A literal in the column's own type, so a comparison never casts the column."""
    return F.lit(value).cast(data_type)


def in_window(column: str, data_type, window: tuple[str, str]) -> Column:
    """Half-open time range; both bounds reach the Parquet scan as pushed filters."""
    first, end = window
    c = F.col(column)
    return (c >= typed_literal(first, data_type)) & (c < typed_literal(end, data_type))


def is_good_number(column: str, *, minimum: float = 0.0, strict: bool = False) -> Column:
    """Number above a floor and not NaN (Spark orders NaN above every number)."""
    c = F.col(column)
    above = c > F.lit(minimum) if strict else c >= F.lit(minimum)
    return above & ~F.isnan(c)


def failed(condition: Column) -> Column:
    """True where a condition is false *or* undecided."""
    return ~F.coalesce(condition, F.lit(False))


def ratio_label(part: str, base: str, threshold: float) -> Column:
    """1.0 where part/base exceeds the threshold; a zero base gives NULL, not an error."""
    return (F.try_divide(F.col(part), F.col(base)) > F.lit(threshold)).cast("double")


def as_category(column: str | Column, sentinel: str = "Unknown") -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(sentinel))


def within_or_null(column: str, low: float, high: float) -> Column:
    c = F.col(column)
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def _angle(column: str | Column, period: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("double") * F.lit(2.0 * math.pi / period)


def cycle_sin(column: str | Column, period: int) -> Column:
    return F.sin(_angle(column, period))


def cycle_cos(column: str | Column, period: int) -> Column:
    return F.cos(_angle(column, period))


def day_number(column: str | Column) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date"))


def day_fold(column: str, folds: int, *, hashed: bool = True) -> Column:
    """Fold id shared by every row of one calendar day."""
    day = F.to_date(F.col(column))
    number = F.xxhash64(day) if hashed else day_number(F.col(column)).cast("bigint")
    return F.pmod(number, F.lit(folds)).cast("int")


def decide(score: str | Column, threshold) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (c >= t).cast("double")


def score_bucket(score: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bucket held inside [0, bins-1]; one bucket when low equals high."""
    slot = F.floor(F.try_divide(score - low, high - low) * F.lit(float(bins)))
    held = F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(bins - 1).cast("bigint"), slot))
    return F.when(high == low, F.lit(0).cast("bigint")).otherwise(held)


def band(column: str, edges: Sequence[float], labels: Sequence[str], other: str,
         *, last_inclusive: bool = True) -> Column:
    """Ordered bands ``< edge``; the last edge may include its bound. NULL, NaN and
    anything past the last edge get ``other``."""
    if len(edges) != len(labels):
        raise ValueError("band needs one label per edge")
    c = F.col(column)
    out = None
    for i, (edge, name) in enumerate(zip(edges, labels)):
        closes = last_inclusive and i == len(edges) - 1
        test = c <= F.lit(float(edge)) if closes else c < F.lit(float(edge))
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(other))


# Edges and names of the published distance bands.
DISTANCE_EDGES = (2, 5)
DISTANCE_NAMES = ("0-2 miles", "2-5 miles")
DISTANCE_OTHER = "unknown/outlier"


def distance_band(column: str, ceiling: float = 200.0) -> Column:
    edges = (*DISTANCE_EDGES, ceiling)
    return band(column, edges, (*DISTANCE_NAMES, f"5-{ceiling:g} miles"), DISTANCE_OTHER)


def shift_cycle(column: str, period: int, step: int = 1) -> Column:
    return F.pmod(F.col(column).cast("int") + F.lit(step), F.lit(period)).cast("string")


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def key_draw(key: str | Column, seed: int) -> Column:
    """Draw in [0, 1) from the leading 52 bits of md5('key:seed'): any SQL engine agrees."""
    c = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def hash_draw(*columns: str | Column, seed: int = 0) -> Column:
    """Well-mixed draw in [0, 1) from a 64-bit hash: same value on every retry and
    under every partitioning, unlike ``rand``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    mixed = F.xxhash64(*cols, F.lit(seed))
    return F.pmod(mixed, F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def poisson_weight(draw: Column, terms: int = 18) -> Column:
    """How often a row is drawn in one with-replacement trial: inverse Poisson(1)."""
    total, weight = 0.0, F.lit(0)
    for k in range(terms):
        total += math.exp(-1.0) / math.factorial(k)
        weight = weight + (draw >= F.lit(total)).cast("int")
    return weight
