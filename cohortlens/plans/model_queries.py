"""Model, robustness-run, explanation and experiment queries over the rides view."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators import audit, evaluation, experiments, explain, models, robustness, sampling, scoring, selection, tuning
from cohortlens.operators.cohort import split_frames
from cohortlens.plans import views as V
from cohortlens.plans.registry import query
from cohortlens.sources.shared import fresh_path, freeze
from cohortlens.sources.sinks import write_partitioned

SPEC = V.RIDE_FEATURES


# Rows that tuning sees in these queries, drawn by key; fits and scores use all rows.
TUNING_ROWS = 3_000
FOLDS = 3


def _staged(spark, d):
    """The rides view staged by day: splits on the day key prune folders, and every fit
    reads files instead of joining again."""
    rides = models.add_cycle(V.rides(spark, d), SPEC)
    path = fresh_path(spark, "rides")
    write_partitioned(rides, path, "day_key")
    return spark.read.schema(rides.schema).parquet(path)


def _splits(spark, d):
    parts = split_frames(_staged(spark, d), V.RIDE_SPLIT)
    parts["train"] = experiments.prepare_training(parts["train"].drop("month_day_sin", "month_day_cos"), SPEC)
    return parts


def _candidates():
    return {c.name: c for c in models.candidates(SPEC)}


def _grid_scores(spark, train):
    """Cross-validated grids of all four families on a key sample, best points marked.

    Queries that need it share one result, found by the content of the sample."""
    share = min(1.0, TUNING_ROWS / max(train.count(), 1))
    sample = freeze(sampling.by_key(train, "event_id", share, 8).withColumn("fold", C.day_fold("day", FOLDS)), "tuning")
    return selection.mark_best(tuning.shared_grid(sample, SPEC, list(_candidates().values()), fold="fold", folds=FOLDS))


def _selected(spark, train):
    """Each candidate with the grid point that cross-validation picks for it."""
    best = {r.model: r.grid_index for r in _grid_scores(spark, train).where("is_best").collect()}
    return [(c, c.grid[best[n]]) for n, c in _candidates().items()]


@query("ml_impute", V.RIDES_SQL + """
, m AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY balance) AS med FROM rides)
SELECT event_id, coalesce(balance, med) AS balance_filled FROM rides, m""")
def ml_impute(spark, d):
    rides = V.rides(spark, d).select("event_id", "balance")
    stage = models.Imputer(inputCols=["balance"], outputCols=["balance_filled"], strategy="median",
                           relativeError=models.MEDIAN_ERROR)
    return stage.fit(rides).transform(rides).select("event_id", "balance_filled")


@query("ml_index", """
SELECT event_type AS vendor, CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
       WHEN 'signup' THEN 3 ELSE 4 END AS DOUBLE) AS vendor_index, count(*) AS n FROM events GROUP BY 1, 2""")
def ml_index(spark, d):
    vendors = V.table(spark, d, "events").select(F.col("event_type").alias("vendor"))
    stage = models.StringIndexerModel.from_labels(
        list(SPEC.vocabulary["vendor"]), inputCol="vendor", outputCol="vendor_index", handleInvalid="keep")
    # fold before indexing: one row per distinct word
    return stage.transform(vendors.groupBy("vendor").agg(F.count(F.lit(1)).alias("n"))).select(
        "vendor", "vendor_index", "n")


def _prepared(spark, d):
    rides = _staged(spark, d)
    return models.preprocessing(SPEC).fit(rides), rides


@query("ml_onehot_width", " UNION ALL ".join(
    f"SELECT '{c}' AS block, CAST({len(words) + 2} AS INTEGER) AS width, count(*) AS rows, "
    f"CAST(count(*) AS DOUBLE) AS filled FROM events" for c, words in SPEC.vocabulary.items()))
def ml_onehot_width(spark, d):
    """Width and filled slots of each one-hot block, over all rides."""
    fitted, rides = _prepared(spark, d)
    out = fitted.transform(rides)
    blocks = F.array(*[
        F.struct(F.lit(c).alias("block"), models.vector_to_array(F.col(f"{c}__hot")).alias("v"))
        for c in SPEC.categories])
    return out.select(F.inline(blocks)).groupBy("block", F.size("v").alias("width")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.aggregate("v", F.lit(0.0), lambda a, x: a + x)).alias("filled"))


@query("ml_scale_stats", V.RIDES_SQL + """
, m AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY balance) AS med FROM rides)
SELECT 'balance' AS feature, round(stddev_samp(coalesce(balance, med)), 6) AS std FROM rides, m
UNION ALL SELECT 'month_day_sin', round(stddev_samp(sin(CAST(month_day AS DOUBLE) * 2 * pi() / 31)), 6) FROM rides
UNION ALL SELECT 'month_day_cos', round(stddev_samp(cos(CAST(month_day AS DOUBLE) * 2 * pi() / 31)), 6) FROM rides""")
def ml_scale_stats(spark, d):
    fitted, _ = _prepared(spark, d)
    std = fitted.stages[-1].std.toArray()
    rows = [(c, float(s)) for c, s in zip(SPEC.numeric_inputs, std)]
    return spark.createDataFrame(rows, "feature string, std double").withColumn("std", F.round("std", 6))


# each one-hot slot is scaled by the deviation of its share among the training rows
_SCALED_SQL = " UNION ALL ".join(
    f"""SELECT event_id, 1 / sqrt(n / (n - 1.0) * p * (1 - p)) AS part FROM rides JOIN
    (SELECT v, n, p FROM (SELECT {c} AS v, count(*) / (SELECT count(*)::DOUBLE FROM train) AS p FROM train GROUP BY 1), (SELECT count(*)::DOUBLE AS n FROM train))
    ON {c} = v""" for c in ("grp", "hour", "dow", "CASE WHEN vendor IN ('click', 'error', 'purchase', 'signup') THEN vendor ELSE 'unseen' END"))


@query("ml_preprocess_fit", V.RIDES_SQL + f"""
, train AS (SELECT * FROM rides WHERE ts < TIMESTAMP '2024-01-22'),
m AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY balance) AS med FROM train),
s AS (SELECT stddev_samp(coalesce(balance, med)) AS b, stddev_samp(sin(CAST(month_day AS DOUBLE) * 2 * pi() / 31)) AS x,
      stddev_samp(cos(CAST(month_day AS DOUBLE) * 2 * pi() / 31)) AS y FROM train, m),
parts AS (SELECT event_id, coalesce(balance, med) / b + sin(CAST(month_day AS DOUBLE) * 2 * pi() / 31) / x + cos(CAST(month_day AS DOUBLE) * 2 * pi() / 31) / y AS part
      FROM rides, m, s UNION ALL {_SCALED_SQL}),
sums AS (SELECT event_id, sum(part) AS total FROM parts GROUP BY 1)
SELECT strftime(ts, '%Y-%m-%d') AS day_key, count(*) AS n, CAST({SPEC.width} AS INTEGER) AS width, round(avg(total), 6) AS mean_sum
FROM rides JOIN sums USING (event_id) GROUP BY 1""")
def ml_preprocess_fit(spark, d):
    """Stages fitted on all training rows, then applied to every row."""
    rides = _staged(spark, d)
    fitted = models.preprocessing(SPEC).fit(split_frames(rides, V.RIDE_SPLIT)["train"])
    values = models.vector_to_array(F.col("features"))
    return fitted.transform(rides).select("day_key", values.alias("v")).groupBy("day_key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("width"),
        F.round(F.avg(F.aggregate("v", F.lit(0.0), lambda a, x: a + x)), 6).alias("mean_sum"))


_TEST_RIDES = "ts >= TIMESTAMP '2024-01-25'"


def _scored(spark, d, candidate):
    """Test rows with the score of a model fitted on all training rows, at the first point of
    its grid, and with the score that its table of weights or nodes gives."""
    parts = _splits(spark, d)
    return scoring.score_with_tables(models.fit(parts["train"], SPEC, candidate), parts["test"], ("event_id", "day_key"))


@query("ml_score_lr")
def ml_score_lr(spark, d):
    return _scored(spark, d, _candidates()["LogisticRegression"])


@query("ml_score_rf")
def ml_score_rf(spark, d):
    return _scored(spark, d, _candidates()["RandomForestClassifier"])


@query("ml_score_mlp")
def ml_score_mlp(spark, d):
    return _scored(spark, d, _candidates()["MultilayerPerceptronClassifier"])


@query("ml_score_gbt")
def ml_score_gbt(spark, d):
    return _scored(spark, d, _candidates()["GBTClassifier"])


@query("ml_score_svc")
def ml_score_svc(spark, d):
    return _scored(spark, d, models.svc_candidate(SPEC))


@query("ml_save_load", """
SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS largest_gap FROM events WHERE ts >= TIMESTAMP '2024-01-25'""")
def ml_save_load(spark, d):
    """A fitted model written and read back scores like the original."""
    parts = _splits(spark, d)
    model = models.fit(parts["train"], SPEC, _candidates()["LogisticRegression"])
    path = fresh_path(spark, "model")
    models.save(model, path)
    first = models.score(model, parts["test"], ["event_id"]).withColumnRenamed("score", "saved_score")
    again = models.score(models.load(path), parts["test"], ["event_id"]).select("event_id", "score")
    return first.join(again, "event_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("saved_score") - F.col("score"))).alias("largest_gap"))


@query("ml_cv_scores")
def ml_cv_scores(spark, d):
    """Day-grouped cross-validation of the full grids: four families, three folds."""
    rows = _grid_scores(spark, _splits(spark, d)["train"])
    return rows.select("model", "family", "grid_index", "params", "metric", "is_best", "cv_seconds")


def _tuned_fits(spark, d):
    """The selected points fitted on all training rows, once for all queries that need them."""
    parts = _splits(spark, d)
    chosen = _selected(spark, parts["train"])
    return tuning.shared_fits(parts["train"], SPEC, chosen), parts, chosen


def _thresholds(fitted, parts):
    return evaluation.select_threshold(experiments.score_all(fitted, parts["validation"]), by=["model"])


def _measured(fitted, frame, chosen):
    return evaluation.metric_rows(evaluation.attach_thresholds(experiments.score_all(fitted, frame), chosen, ["model"]), by=["model"])


@query("ml_refit")
def ml_refit(spark, d):
    """Each model's best point, refitted on all training rows, measured on test."""
    fitted, parts, chosen = _tuned_fits(spark, d)
    points = spark.createDataFrame([(c.name, json.dumps(dict(p), sort_keys=True)) for c, p in chosen], "model string, params string")
    return _measured(fitted, parts["test"], _thresholds(fitted, parts)).join(F.broadcast(points), "model")  # a row a model


@query("ml_importance")
def ml_importance(spark, d):
    parts, cs = _splits(spark, d), _candidates()
    tables = [
        models.tree_importance(spark, models.fit(parts["train"], SPEC, cs[n]), SPEC, n)
        for n in ("RandomForestClassifier", "GBTClassifier")
    ]
    return tables[0].unionByName(tables[1])


@query("ml_comparison")
def ml_comparison(spark, d):
    """Four fitted models: thresholds from validation scores, full metric rows on test."""
    parts = _splits(spark, d)
    fitted = tuning.shared_fits(parts["train"], SPEC, [(c, c.grid[0]) for c in _candidates().values()])
    return _measured(fitted, parts["test"], _thresholds(fitted, parts))


@query("robust_run")
def robust_run(spark, d):
    """Every tuned model scores one frozen perturbed test set at its fixed threshold."""
    fitted, parts, _ = _tuned_fits(spark, d)
    chosen = _thresholds(fitted, parts)
    perturbed = freeze(robustness.perturb(parts["test"], C.hash_draw("event_id", seed=17), robustness.shift_and_hide(0.20)), "perturbed")
    before, after = (_measured(fitted, f, chosen) for f in (parts["test"], perturbed))
    return robustness.rank_by_impact(robustness.metric_deltas(before, after))


@query("robust_retrain")
def robust_retrain(spark, d):
    """Each tuned model refitted three times on nine tenths of its rows, measured at its own threshold."""
    fitted, parts, chosen = _tuned_fits(spark, d)
    limits = {r.model: r.threshold for r in _thresholds(fitted, parts).collect()}
    return experiments.retraining_trials(
        parts["train"], parts["validation"], "event_id", SPEC, [tuning.Tuned(c, p, limits[c.name]) for c, p in chosen])


_EXPLAINED = (*SPEC.numeric, *SPEC.categories, "month_day")


@query("explain_local")
def explain_local(spark, d):
    """Local surrogate weights of every feature for every test row, NULL inputs included."""
    parts = _splits(spark, d)
    model = models.fit(parts["train"], SPEC, _candidates()["LogisticRegression"])
    base = sampling.background(parts["train"].select("event_id", *_EXPLAINED), "event_id", 200, 31)
    return explain.local_weights(model, parts["test"], "event_id", base, SPEC)


@query("audit_blind_compare")
def audit_blind_compare(spark, d):
    """Full model against one that never sees the group, on the same test rows."""
    parts = _splits(spark, d)
    lr = _candidates()["LogisticRegression"]
    fitted = {"full": models.fit(parts["train"], SPEC, lr), "blind": models.fit(parts["train"], SPEC.without("grp"), lr)}
    test = experiments.score_all(fitted, parts["test"], ["grp"])
    metrics = evaluation.metric_rows(test, 0.5, ["model"]).select("model", "auc_roc", "auc_pr", "positive_f1")
    return metrics.join(audit.parity_ratio(audit.audit_groups(test, 0.5, "grp", minimum=20, by=["model"]), by=["model"]), "model")


@query("bench_shuffle")
def bench_shuffle(spark, d):
    return experiments.shuffle_widths(V.rides(spark, d), ["grp", "hour"], [16, 4])


@query("bench_cache")
def bench_cache(spark, d):
    return experiments.cache_effect(V.rides(spark, d), ["grp", "hour"])


@query("bench_fraction")
def bench_fraction(spark, d):
    return experiments.fraction_scaling(V.rides(spark, d), ["grp", "hour"], 8)


@query("bench_fit_fraction")
def bench_fit_fraction(spark, d):
    """Fit time of all four models on five shares of the training rows."""
    train = freeze(_splits(spark, d)["train"], "train")
    return experiments.fit_scaling(train, "event_id", SPEC, list(_candidates().values()), 8)
