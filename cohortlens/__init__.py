"""Cohort, label, evaluation and audit analytics as Spark DataFrame operators."""
