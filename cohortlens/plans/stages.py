"""The four stages end to end: ingest, train, assess, publish.

Each stage reads what the one before it wrote below ``work`` and writes tables there,
so any stage can be rerun alone and a lost executor only costs a re-read.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import presets
from cohortlens.functions import columns as C
from cohortlens.operators import (
    audit,
    cohort,
    evaluation,
    experiments,
    explain,
    marts,
    models,
    quality,
    robustness,
    sampling,
    selection,
    tuning,
)
from cohortlens.sources import conform, dimension, files, sinks
from cohortlens.spec import CohortSpec, FeatureSpec, TimeSplit


@dataclasses.dataclass(frozen=True)
class Job:
    """Everything the stages share."""

    work: str
    cohort: CohortSpec = presets.TRIP_COHORT
    split: TimeSplit = presets.TRIP_SPLIT
    features: FeatureSpec = presets.TRIP_FEATURES
    schema: T.StructType = presets.TRIP_SCHEMA
    required: tuple[str, ...] = presets.TRIP_REQUIRED
    # Defaults of a full run.
    seed: int = 2026
    folds: int = 3
    parallelism: int = 2
    tuning_fraction: float = 0.08  # share of the training rows, drawn by key, that tuning sees
    bins: int = 150
    minimum_group: int = 1000
    perturbed_fraction: float = 0.20
    background_rows: int = 300
    explain_samples: int = 500
    price_per_hour: float | None = None
    price_source: str = ""
    grids: Mapping[str, Sequence[Mapping]] | None = None

    def at(self, *parts: str) -> str:
        return "/".join([self.work.rstrip("/"), *parts])


def _table(job: Job, name: str, frame: DataFrame) -> DataFrame:
    """A result table as Parquet, read back so later users do not recompute it."""
    path = job.at("tables", name)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _read(spark: SparkSession, job: Job, name: str) -> DataFrame:
    return dimension.read_staged(spark, job.at("tables", name))


def staged(spark: SparkSession, job: Job) -> DataFrame:
    return dimension.read_staged(spark, job.at("staged"))


def ingest(spark: SparkSession, job: Job, raw_dir: str, dimension_csv: str, *, expected: Sequence[str],
           period_pattern: str, key: str, value: str, min_rows: int = 10_000_000,
           min_columns: int = 10, min_bytes: int = 1 << 30) -> DataFrame:
    """Raw periods to the staged fact: completeness, drift, quality, cohort, gates.

    The raw files are scanned twice: once for every quality count, once for the write.
    Split counts come from the staged table.
    """
    listed = files.file_inventory(spark, raw_dir)
    files.require_files(listed, expected)
    log = _table(job, "schema_log", conform.schema_log(spark, listed))
    size = listed.agg(F.sum("bytes")).first()[0]
    raw = conform.load_periods(log, job.schema, period_pattern, job.required)
    dim = dimension.read_dimension(
        spark, dimension_csv, key, value, key_as=job.cohort.dim_key, value_as=job.cohort.group)

    # a row counts for the month it was picked up in, whatever file it was filed in
    monthly = raw.withColumn("year_month", F.date_format(job.cohort.time, "yyyy-MM"))
    counts = _table(job, "quality", quality.quality_table(monthly, job.cohort, "year_month", size))
    chosen = conform.load_periods(log, job.schema, period_pattern, job.required, rule=lambda f: cohort.eligibility(f, job.cohort))
    fact = cohort.build_cohort(chosen, dim, job.cohort)
    sinks.write_partitioned(fact, job.at("staged"), "year_month", ["pickup_date", job.cohort.place])
    fact = staged(spark, job)

    gate = _table(job, "split_gate", quality.split_gate(fact, job.split))
    quality.require_gate(gate.where(F.col("split").isNotNull()).select("split", "non_empty"))
    _table(job, "period_label", marts.rows_by(fact, "year_month", "label"))

    rows = counts.where((F.col("section") == "overall") & (F.col("metric") == "raw_rows")).first().value
    narrowest = log.agg(F.min("n_columns")).first()[0]
    volume = spark.createDataFrame(
        [(rows, narrowest, size, rows >= min_rows, narrowest >= min_columns, size >= min_bytes)],
        "rows long, columns int, bytes long, enough_rows boolean, enough_columns boolean, enough_bytes boolean")
    quality.require_gate(_table(job, "volume_gate", volume))
    return fact


def train(spark: SparkSession, job: Job) -> DataFrame:
    """Tune, refit, save, pick thresholds, score and measure every candidate."""
    parts = cohort.split_frames(staged(spark, job), job.split)
    weighted = cohort.with_pinned_weights(parts["train"], job.features.label, job.features.weight)
    keyed = weighted.withColumn("_row", F.xxhash64(*weighted.columns))
    tune = sampling.by_key(keyed, "_row", job.tuning_fraction, job.seed).drop("_row").withColumn("fold", C.day_fold("pickup_date", job.folds))
    tune = tune.persist(StorageLevel.MEMORY_AND_DISK)
    classes = tune.groupBy("fold").agg(F.count_if(F.col(job.features.label) == 1).alias("p"), F.count_if(F.col(job.features.label) != 1).alias("q")).collect()
    if len(classes) < job.folds or any(not (r.p and r.q) for r in classes):
        raise ValueError("every tuning fold needs rows of both classes; raise tuning_fraction")
    keep = ["year_month", job.cohort.group, "pickup_date", job.cohort.place, job.cohort.distance]

    grids, timings, importances = [], [], []
    for c in models.candidates(job.features, grids=job.grids):
        grid = models.cross_validate(
            tune, job.features, c, fold="fold", folds=job.folds, parallelism=job.parallelism, seed=job.seed)
        best = selection.best_points(grid).first()
        seconds, model = experiments.timed(lambda: models.fit(weighted, job.features, c, c.grid[best.grid_index]))
        models.save(model, job.at("models", c.name))
        for part in ("validation", "test"):
            scored = models.score(model, parts[part], keep, label=job.features.label)
            scored.write.mode("overwrite").parquet(job.at("predictions", part, f"model={c.name}"))
        grids.append(grid)
        cv_seconds = grid.first().cv_seconds
        timings.append((c.name, c.family, float(best.metric), cv_seconds, seconds, cv_seconds + seconds, job.folds))
        if hasattr(model.stages[-1], "featureImportances"):
            importances.append(models.tree_importance(spark, model, job.features, c.name))

    tune.unpersist()
    _table(job, "cv_grid", selection.mark_best(conform.union_frames(grids)))
    _table(job, "importance", conform.union_frames(importances))
    times = spark.createDataFrame(
        timings, "model string, family string, cv_auc_pr double, cv_seconds double, refit_seconds double, "
                 "total_seconds double, folds int")
    times = _table(job, "timings", times)

    chosen = _table(job, "thresholds", evaluation.select_threshold(predictions(spark, job, "validation"), job.bins, by=["model"]))
    test = predictions(spark, job, "test")
    metrics = evaluation.metric_rows(evaluation.attach_thresholds(test, chosen, ["model"]), by=["model"])
    metrics = _table(job, "metrics", metrics)
    _table(job, "curves", evaluation.curve(test, job.bins, ["model"]))
    _table(job, "recommended", selection.recommend(times, metric="cv_auc_pr", cost="total_seconds"))
    return metrics


def predictions(spark: SparkSession, job: Job, part: str) -> DataFrame:
    return dimension.read_staged(spark, job.at("predictions", part))


def _saved_models(spark: SparkSession, job: Job) -> dict:
    names = [r.model for r in _read(spark, job, "timings").select("model").collect()]
    return {n: models.load(job.at("models", n)) for n in names}


def assess(spark: SparkSession, job: Job, *, repeats: int = 3, explained_rows: int = 1,
           retraining_share: float | None = None, retraining_trials: int = 3) -> DataFrame:
    """Benchmarks, perturbed test set, local explanations, group audit.

    ``retraining_share`` adds the costly refits on subsamples of that share.
    """
    fact = staged(spark, job)
    keys = [job.cohort.group, "pickup_hour"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _table(job, "bench_shuffle", experiments.shuffle_widths(fact, keys, [width, max(1, width // 2)], repeats))
    _table(job, "bench_cache", experiments.cache_effect(fact, keys, repeats))
    parts = cohort.split_frames(fact, job.split)
    _table(job, "bench_fraction", experiments.fraction_scaling(parts["train"], keys, job.seed))

    # a random draw is fixed by writing the perturbed rows once, for all models
    changes = robustness.shift_and_hide(job.perturbed_fraction, cycle="pickup_hour", group=job.cohort.group)
    changed = robustness.perturb(parts["test"], F.rand(job.seed), changes)
    changed.write.mode("overwrite").parquet(job.at("perturbed"))
    changed = dimension.read_staged(spark, job.at("perturbed"))
    same = quality.reconcile_cohorts(parts["test"], changed, job.features.label)
    quality.require_gate(_table(job, "reconciled", same))
    tally = _table(job, "perturb_tallies", robustness.tallies(changed)).first()
    if tally[robustness.SHIFTED] + tally[robustness.MASKED] == 0:
        raise ValueError("the perturbation changed no row")

    fitted = _saved_models(spark, job)
    chosen = _read(spark, job, "thresholds")
    after = evaluation.metric_rows(
        evaluation.attach_thresholds(experiments.score_all(fitted, changed, label=job.features.label), chosen, ["model"]),
        by=["model"])
    deltas = robustness.metric_deltas(_read(spark, job, "metrics"), after)
    ranked = _table(job, "robustness", robustness.rank_by_impact(deltas))

    winner = _read(spark, job, "recommended").first().model
    inputs = [*job.features.numeric, *job.features.categories, *([job.features.cyclic[0]] if job.features.cyclic else [])]
    threshold = chosen.where(F.col("model") == winner).first().threshold
    # distinct profiles: two rows with equal features have one and the same explanation
    profiles = parts["test"].select(*inputs).dropna(subset=list(job.features.numeric)).distinct()
    cases = profiles.withColumn("case_id", F.xxhash64(*inputs)).orderBy("case_id").limit(explained_rows)
    pool = parts["train"].select(*inputs).orderBy(F.rand(job.seed)).limit(job.background_rows)
    _table(job, "local_weights", explain.local_weights(
        fitted[winner], cases, "case_id", pool, job.features, samples=job.explain_samples, seed=job.seed))

    scored = predictions(spark, job, "test").where(F.col("model") == winner)
    groups = _table(job, "audit", audit.audit_groups(scored, threshold, job.cohort.group, minimum=job.minimum_group))
    _table(job, "audit_suppressed", audit.suppressed_groups(scored, threshold, job.cohort.group, minimum=job.minimum_group))
    _table(job, "audit_ratio", audit.parity_ratio(groups))

    if retraining_share is not None:
        keyed = {n: p.withColumn("row_key", F.xxhash64(*p.columns)) for n, p in parts.items()}
        train_rows = cohort.with_pinned_weights(keyed["train"], job.features.label, job.features.weight)
        limits = {r.model: r.threshold for r in chosen.collect()}
        best = {r.model: r.grid_index for r in _read(spark, job, "cv_grid").where("is_best").collect()}
        tuned = [tuning.Tuned(c, c.grid[best[c.name]], limits[c.name]) for c in models.candidates(job.features, grids=job.grids)]
        trials = _table(job, "retraining", experiments.retraining_trials(
            train_rows, keyed["validation"], "row_key", job.features, tuned,
            share=retraining_share, trials=retraining_trials, seed=job.seed, at_once=job.parallelism))
        _table(job, "retraining_summary", robustness.delta_summary(trials))
    return ranked


# Configuration names in the cost table.
TRAINED = "CV + refit"
CACHE_CONFIGS = {
    "median_uncached": "uncached repeated median",
    "median_cached": "cached repeated median excludes fill",
    "fill_seconds": "cache fill",
}


def cost_measurements(spark: SparkSession, job: Job) -> DataFrame:
    """Training, shuffle, cache and sampling times in one long shape."""
    def shape(frame, experiment, model, config, seconds, fraction=None, rows=None):
        null_d, null_l = F.lit(None).cast("double"), F.lit(None).cast("bigint")
        return frame.select(
            F.lit(experiment).alias("experiment"), model.alias("model"), config.alias("config"),
            (null_d if fraction is None else fraction).alias("sample_fraction"),
            (null_l if rows is None else rows).alias("rows"), seconds.alias("wall_seconds"))

    plain = F.lit("Spark groupBy")
    cache = _read(spark, job, "bench_cache")
    fraction = F.col("sample_fraction")
    return conform.union_frames([
        shape(_read(spark, job, "timings"), "training", F.col("model"), F.lit(TRAINED), F.col("total_seconds")),
        shape(_read(spark, job, "bench_shuffle"), "shuffle", plain, F.col("partitions").cast("string"), F.col("median_seconds")),
        *[shape(cache, "cache", plain, F.lit(config), F.col(c)) for c, config in CACHE_CONFIGS.items()],
        shape(_read(spark, job, "bench_fraction"), "groupby_fraction", plain,
              F.concat(F.lit("sample="), fraction.cast("string")), F.col("group_by_seconds"), fraction, F.col("rows")),
    ])


def publish(spark: SparkSession, job: Job) -> list[str]:
    """Aggregate CSV marts and JSON documents; no row-level data leaves the staged table."""
    fact, group = staged(spark, job), job.cohort.group
    metrics = _read(spark, job, "metrics")
    performance = metrics.join(_read(spark, job, "timings"), "model").withColumnRenamed("threshold", "selected_threshold")
    cells = F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(c).alias("count")) for c in ("tn", "fp", "fn", "tp")])
    business = marts.group_rates(
        fact, ["year_month", group, "pickup_hour"], minimum=job.minimum_group, rate="high_tip_rate",
        measures={"mean_fare_usd": marts.mean_money(job.cohort.base)},
    ).withColumnsRenamed({"year_month": "month", group: "borough"}).orderBy("month", "borough", "pickup_hour")
    banded = fact.withColumn("distance_band", C.distance_band(job.cohort.distance))
    # Column order of each published table.
    tables = {
        "quality": (_read(spark, job, "quality").orderBy("section", "metric", "key"), "section metric key value"),
        "performance": (performance, "model family auc_roc auc_pr accuracy positive_precision positive_recall "
                                     "positive_f1 specificity cv_seconds refit_seconds folds selected_threshold"),
        "confusion": (metrics.select("model", F.inline(cells)), "model cell count"),
        "curves": (_read(spark, job, "curves"), "model fpr tpr recall precision threshold"),
        "importance": (_read(spark, job, "importance"), "model feature global_split_importance"),
        "local_weights": (_read(spark, job, "local_weights"), "case_id feature local_weight surrogate_r2"),
        "business": (business, "month borough pickup_hour n high_tip_rate mean_fare_usd"),
        "distance": (marts.group_rates(banded, ["distance_band"], minimum=job.minimum_group), "distance_band n rate"),
        "group_audit": (_read(spark, job, "audit").withColumnRenamed(group, "borough"),
                        "borough n observed_positive_rate predicted_positive_rate tpr fpr precision"),
        "cost": (marts.cost_table(cost_measurements(spark, job), job.price_per_hour, job.price_source),
                 " ".join(marts.COST_COLUMNS)),
    }
    for name, (frame, headers) in tables.items():
        sinks.write_csv(frame, job.at("marts", name), headers.split())
    for name in ("metrics", "curves", "robustness", "audit"):
        sinks.write_json(_read(spark, job, name), job.at("documents", name))
    return list(tables)
