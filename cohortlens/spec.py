"""Column roles: operators take these instead of hard-wired column names."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping


@dataclasses.dataclass(frozen=True)
class CohortSpec:
    """Which column plays which part in a cohort, and the rules that bound it."""

    time: str = "pickup_ts"
    window: tuple[str, str] = ("2019-01-01", "2020-01-01")  # half-open
    channel: str = "payment_type"
    channel_code: int = 1
    base: str = "fare_amount"
    part: str = "tip_amount"
    ratio: float = 0.20
    place: str = "zone_id"
    dim_key: str = "zone_id"
    group: str = "grp"
    occupancy: str = "passenger_count"
    occupancy_range: tuple[float, float] = (1.0, 8.0)
    vendor: str = "vendor"
    late_code: str = "rate_code"
    distance: str = "trip_distance"


@dataclasses.dataclass(frozen=True)
class TimeSplit:
    """Three-way split on a sortable period key such as ``yyyy-MM``."""

    validation_from: str
    test_from: str
    period: str = "year_month"


@dataclasses.dataclass(frozen=True)
class FeatureSpec:
    """Model inputs: numerics (imputed), fixed-vocabulary categories, one cycle.

    ``cyclic`` maps a raw integer-like column to its period length; its sine and
    cosine become numerics named ``<col>_sin`` and ``<col>_cos``.
    """

    numeric: tuple[str, ...]
    vocabulary: Mapping[str, tuple[str, ...]]
    cyclic: tuple[str, int] | None = None
    forbidden: tuple[str, ...] = ()
    label: str = "label"
    weight: str = "class_weight"

    @property
    def numeric_inputs(self) -> list[str]:
        extra = [] if self.cyclic is None else [f"{self.cyclic[0]}_sin", f"{self.cyclic[0]}_cos"]
        return [*self.numeric, *extra]

    @property
    def categories(self) -> list[str]:
        return list(self.vocabulary)

    @property
    def width(self) -> int:
        # each one-hot block is the vocabulary plus an unseen slot plus an invalid slot
        return len(self.numeric_inputs) + sum(len(v) + 2 for v in self.vocabulary.values())

    def without(self, *columns: str) -> FeatureSpec:
        kept = {c: v for c, v in self.vocabulary.items() if c not in columns}
        return dataclasses.replace(
            self, vocabulary=kept, numeric=tuple(c for c in self.numeric if c not in columns)
        )
