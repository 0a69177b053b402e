"""Per-group decision audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import columns as C


def _cells(scored: DataFrame, threshold, group: str, sentinel: str, by: Sequence[str] = ()) -> DataFrame:
    y, d = F.col("label") == 1, C.decide("score", threshold) == 1
    return scored.where(F.col(group) != F.lit(sentinel)).groupBy(*by, group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y).alias("observed"),
        F.count_if(d).alias("flagged"),
        F.count_if(y & d).alias("hits"),
    )


def _shown(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def audit_groups(scored: DataFrame, threshold, group: str, *, minimum: int = 1000,
                 sentinel: str = "Unknown", digits: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rates per reported group; NULL where a rate has no denominator."""
    n, obs, flagged, hits = (F.col(c) for c in ("n", "observed", "flagged", "hits"))
    rates = {
        "observed_positive_rate": (obs, n),
        "predicted_positive_rate": (flagged, n),
        "tpr": (hits, obs),
        "fpr": (flagged - hits, n - obs),
        "precision": (hits, flagged),
    }
    kept = _cells(scored, threshold, group, sentinel, by).where(n >= F.lit(minimum))
    return kept.select(
        *by, group, "n",
        *[_shown(C.safe_ratio(a, b, None), digits).alias(name) for name, (a, b) in rates.items()],
    )


def suppressed_groups(scored: DataFrame, threshold, group: str, *, minimum: int = 1000,
                      sentinel: str = "Unknown") -> DataFrame:
    return _cells(scored, threshold, group, sentinel).where(F.col("n") < F.lit(minimum)).select(group, "n")


def parity_ratio(groups: DataFrame, rate: str = "predicted_positive_rate",
                 digits: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Smallest over largest rate; NULL without groups or when the largest is zero."""
    low, high = F.min(rate), F.max(rate)
    return groups.groupBy(*by).agg(
        F.count(F.lit(1)).alias("groups"),
        _shown(F.try_divide(low, high), digits).alias("min_over_max_rate"),
    )


def pair_ratio(scored: DataFrame, threshold, group: str, favoured: str, other: str, *,
               limit: float = 1.25, digits: int | None = None) -> DataFrame:
    """Ratio of two named groups' predicted rates, flagged above ``limit``."""
    d, g = C.decide("score", threshold), F.col(group)
    rates = scored.agg(
        F.avg(F.when(g == F.lit(favoured), d)).alias("favoured_rate"),
        F.avg(F.when(g == F.lit(other), d)).alias("other_rate"),
    )
    ratio = F.try_divide(F.col("favoured_rate"), F.col("other_rate"))
    return rates.select(
        _shown(F.col("favoured_rate"), digits).alias("favoured_rate"),
        _shown(F.col("other_rate"), digits).alias("other_rate"),
        _shown(ratio, digits).alias("impact_ratio"),
        (ratio > F.lit(limit)).alias("flagged"),
    )
