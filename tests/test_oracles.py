"""Every query with SQL agrees with DuckDB and has rows; the others return rows."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
from tools.check_oracles import TABLES, compare

# the training-data operators have tests of their own
QUERIES = {n: q for n, q in entry_file.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLES = {n: q for n, q in entry_file.oracle_sql().items() if n in QUERIES}

@pytest.fixture(scope="module")
def tables(sf):
    """The next larger tables: the smallest have no cell beyond some disclosure limits."""
    return f"{sf}/../sf0.01"


@pytest.fixture(scope="module")
def con(tables):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, tables, name):
    verdict, _ = compare(spark, con, name, tables, QUERIES, ORACLES)
    assert verdict.startswith("ok"), verdict


FINITE = "__finite__"
# What each query without SQL must hold besides having rows; SQL cannot fit, time or hash files.
# Columns named here lie in a range.
RANGES = {
    **{f"ml_score_{m}": {"score": (0, 1), "table_score": (0, 1)} for m in ("lr", "rf", "mlp", "gbt")},
    "ml_score_svc": {"score": FINITE, "table_score": FINITE},
    "ml_cv_scores": {"metric": (0, 1)},
    **{n: {"auc_roc": (0, 1), "auc_pr": (0, 1), "positive_f1": (0, 1), "threshold": (0, 1)} for n in ("ml_refit", "ml_comparison")},
    "robust_run": {"delta_auc_roc": (-1, 1), "impact_score": (0, 2), "rank": (1, 4)},
    "robust_retrain": {"delta_auc_pr": (-1, 1), "delta_auc_roc": (-1, 1), "delta_positive_f1": (-1, 1), "train_rows": (100, 1e9), "threshold": (0, 1)},
    "explain_local": {"local_weight": FINITE, "surrogate_r2": (-1e-9, 1), "weight_gap": (0, 1e6)},
    "audit_blind_compare": {"auc_roc": (0, 1), "min_over_max_rate": (0, 1)},
    "ml_importance": {"global_split_importance": (0, 1)},
    "bench_shuffle": {"median_seconds": (0, 600)}, "bench_cache": {"fill_seconds": (0, 600)},
    "bench_fraction": {"group_by_seconds": (0, 600)}, "bench_fit_fraction": {"fit_seconds": (0, 600)},
    "src_file_inventory": {"bytes": (100, 1e12), "rows": (5, 1e12)},
}
ROWS = {"ml_cv_scores": 16, "ml_refit": 4, "ml_comparison": 4, "robust_run": 4, "robust_retrain": 12, "bench_fit_fraction": 20, "bench_fraction": 4,
        "audit_blind_compare": 2, "src_file_inventory": 8, "src_manifest": 8}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES))
def test_query_without_sql(spark, tables, name):
    got = QUERIES[name](spark, tables)
    outside = [F.count_if(~(F.abs(c) < float("inf")) | F.isnan(c) | F.col(c).isNull()) if r == FINITE else F.count_if(~F.col(c).between(*r) | F.col(c).isNull())
               for c, r in RANGES.get(name, {}).items()]
    n, *bad = got.agg(F.count(F.lit(1)), *outside).first()
    assert n > 0 and not any(bad) and n == ROWS.get(name, n)
    if name.startswith("ml_score_"):
        assert got.where("abs(score - table_score) > 1e-9").count() == 0
    if name == "ml_cv_scores":
        assert {(r.model, r.n) for r in got.where("is_best").groupBy("model").agg(F.count(F.lit(1)).alias("n")).collect()} == {
            (m, 1) for m in ("LogisticRegression", "RandomForestClassifier", "MultilayerPerceptronClassifier", "GBTClassifier")}
    if name == "ml_importance":
        assert all(abs(r.total - 1) < 1e-9 for r in got.groupBy("model").agg(F.sum("global_split_importance").alias("total")).collect())


def test_no_query_is_checked_by_a_constant():
    """SQL that says TRUE of a model's numbers says nothing; such queries have no SQL."""
    assert not [n for n in ORACLES if n.startswith(("ml_score", "ml_cv", "ml_refit", "robust_re", "robust_run", "explain", "bench"))]


def test_queries_leave_no_tables(spark, tables):
    """After a query only what its result reads, and results shared by content, are left."""
    from pathlib import Path

    from cohortlens.sources.shared import paths_read, shared_root

    root = Path(shared_root(spark))
    for name in ("ml_save_load", "sink_partitioned_write", "ml_onehot_width", "eval_model_table", "bench_shuffle", "audit_blind_compare", "ml_cv_scores"):
        before = {p.name for p in root.iterdir()}
        plan = paths_read(QUERIES[name](spark, tables))
        left = {p.name for p in root.iterdir()} - before
        assert all(p in plan or p.startswith(("grid-", "models-")) for p in left), (name, left)


def test_entry(spark):
    got = entry_file.entry(spark)
    assert got.columns == ["year_month", "grp", "pickup_hour", "n", "high_tip_rate", "mean_fare_usd"] and got.count() > 0
