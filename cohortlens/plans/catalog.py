"""Importing this module registers every query."""

from __future__ import annotations

from cohortlens.plans import (  # noqa: F401
    cohort_queries,
    eval_queries,
    mart_queries,
    model_queries,
    quality_queries,
    source_queries,
)
from cohortlens.plans.mart_queries import business  # noqa: F401
from cohortlens.plans.registry import ORACLES, QUERIES  # noqa: F401
