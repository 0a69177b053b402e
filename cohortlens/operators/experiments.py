"""Timed experiments: shuffle width, caching, sample size, retraining.

These run jobs and return small tables of what they measured.
"""

from __future__ import annotations

import contextlib
import functools
import math
import statistics
import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators import cohort, evaluation, models, sampling, tuning
from cohortlens.operators.marts import group_rates
from cohortlens.sources.shared import freeze
from cohortlens.spec import FeatureSpec


def timed(action: Callable[[], object]) -> tuple[float, object]:
    start = time.perf_counter()
    result = action()
    return time.perf_counter() - start, result


def _cells(frame: DataFrame, keys: Sequence[str]) -> int:
    """Run the group-by and count its cells on the executors."""
    return group_rates(frame, keys).count()


def rounds(arms: dict[object, Callable[[], object]], repeats: int) -> dict[object, tuple[list[float], object]]:
    """Seconds of each arm over ``repeats`` rounds, and its result.

    Every arm runs once unmeasured; then the arms take turns, so that a machine growing
    slower or faster does not favour one. An arm whose result changes is an error.
    """
    results = {name: arm() for name, arm in arms.items()}
    seconds = {name: [] for name in arms}
    for _ in range(repeats):
        for name, arm in arms.items():
            took, result = timed(arm)
            if result != results[name]:
                raise ValueError(f"arm {name} gave {results[name]}, then {result}")
            seconds[name].append(took)
    return {name: (seconds[name], results[name]) for name in arms}


def paired_ratio(own: Sequence[float], base: Sequence[float]) -> tuple[float, float, float]:
    """(median, least, largest) of own over base, round by round: rounds share the state of
    the machine, so their ratios spread less than the seconds do."""
    ratios = sorted(a / b for a, b in zip(own, base))
    return statistics.median(ratios), ratios[0], ratios[-1]


@contextlib.contextmanager
def _setting(spark, name: str, value: object):
    held = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, held)


_RATIO = "ratio double, ratio_low double, ratio_high double"


def shuffle_widths(frame: DataFrame, keys: Sequence[str], widths: Sequence[int], repeats: int = 3) -> DataFrame:
    """The same aggregate at several shuffle widths, which must all give the same cells.

    ``ratio`` is a width's time over the first width's, as ``paired_ratio`` has it.
    """
    spark = frame.sparkSession

    def arm(width: int) -> int:
        with _setting(spark, "spark.sql.shuffle.partitions", width):
            return _cells(frame, keys)

    measured = rounds({w: functools.partial(arm, w) for w in widths}, repeats)
    if len({cells for _, cells in measured.values()}) > 1:
        raise ValueError("the number of groups depends on the shuffle width")
    first = measured[widths[0]][0]
    return spark.createDataFrame(
        [(w, repeats, cells, statistics.median(s), *paired_ratio(s, first)) for w, (s, cells) in measured.items()],
        f"partitions int, runs int, group_count long, median_seconds double, {_RATIO}")


def cache_effect(frame: DataFrame, keys: Sequence[str], repeats: int = 3) -> DataFrame:
    """The aggregate from its source and from memory, and what filling the memory costs.

    ``ratio`` is the time from memory over the time from the source; ``repays_after`` the
    number of runs after which the fill has paid for itself, NULL if it never does.
    """
    copy = frame.select("*")  # persisting marks equal plans, so the source is measured first
    (source, cells), = rounds({"source": lambda: _cells(frame, keys)}, repeats).values()
    copy.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fill, rows = timed(copy.count)
        (memory, same), = rounds({"memory": lambda: _cells(copy, keys)}, repeats).values()
    finally:
        copy.unpersist(blocking=True)
    if same != cells:
        raise ValueError("the number of groups depends on the cache")
    saved = statistics.median(source) - statistics.median(memory)
    return frame.sparkSession.createDataFrame(
        [(rows, repeats, statistics.median(source), statistics.median(memory), fill, sum(source), fill + sum(memory),
          *paired_ratio(memory, source), math.ceil(fill / saved) if saved > 0 else None)],
        "rows long, runs int, median_uncached double, median_cached double, "
        f"fill_seconds double, total_uncached double, total_cached_with_fill double, {_RATIO}, repays_after long")


def fraction_scaling(frame: DataFrame, keys: Sequence[str], seed: int,
                     fractions: Sequence[float] = (0.10, 0.25, 0.50, 1.0), repeats: int = 3) -> DataFrame:
    """Count and group-by time as the sampled share grows; ``ratio`` is a share's group-by
    over that of the smallest share, as ``paired_ratio`` has it."""
    parts = {f: sampling.bernoulli(frame, f, seed) for f in fractions}
    counted = rounds({f: p.count for f, p in parts.items()}, repeats)
    grouped = rounds({f: functools.partial(_cells, p, keys) for f, p in parts.items()}, repeats)
    first = grouped[min(fractions)][0]
    rows = [(f, counted[f][1], statistics.median(counted[f][0]), statistics.median(grouped[f][0]), grouped[f][1], repeats, *paired_ratio(grouped[f][0], first))
            for f in fractions]
    return frame.sparkSession.createDataFrame(
        rows, f"sample_fraction double, rows long, count_seconds double, group_by_seconds double, group_count long, runs int, {_RATIO}")


def fit_scaling(train: DataFrame, key: str, spec: FeatureSpec, candidates: Sequence[models.Candidate],
                seed: int, fractions: Sequence[float] = (0.10, 0.25, 0.50, 0.75, 1.0)) -> DataFrame:
    """Fit time per model and training share.

    The feature stages of a share are the same for all models: they are fitted once, and their
    seconds count in each model's."""
    rows = []
    for f in fractions:
        part = sampling.by_key(train, key, f, seed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = part.count()
            before, stages = timed(lambda: models.preprocessing(spec).fit(part))
            ready = models.spread(models.prepared(stages, part, spec), n, train.sparkSession.sparkContext.defaultParallelism)
            for c in candidates:
                seconds, _ = timed(lambda: models.fit_prepared(stages, ready, c))
                rows.append((c.name, f, n, before + seconds))
        finally:
            part.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "model string, sample_fraction double, rows long, fit_seconds double")


def retraining_trials(train: DataFrame, validation: DataFrame, key: str, spec: FeatureSpec, tuned: Sequence[tuning.Tuned], *,
                      share: float = 1.0, kept: float = 0.9, trials: int = 3, seed: int = 8, least: int = 100, at_once: int = 8) -> DataFrame:
    """How metrics move when tuned models are refitted on parts of their rows.

    Which rows a trial holds is drawn by their key and marked in a list; trial 0 holds all.
    The marked rows are written and gated once. Features are prepared once a trial, for all
    models: its own rows to fit on and the fixed validation rows to measure with, in one
    table of a folder a trial. All refits of all trials then run at the same time, all
    scores are measured at once at each model's own threshold, and differences to trial 0
    come from one window over a few rows.
    """
    if trials < 2 or not (0 < kept < 1 and 0 < share <= 1):
        raise ValueError("at least two trials, a kept part below 1 and a share in (0, 1] are needed")
    spark = train.sparkSession
    member = [F.lit(0), *[F.when(C.hash_draw(key, seed=seed + t) < kept, F.lit(t)) for t in range(1, trials + 1)]]
    table = freeze(sampling.by_key(train, key, share, seed).withColumn("trials", F.array_compact(F.array(*member))), "trials")
    fixed = freeze(sampling.by_key(validation, key, share, seed), "fixed")
    sizes = {r.trial: r.n for r in table.select(F.explode("trials").alias("trial")).groupBy("trial").agg(F.count(F.lit(1)).alias("n")).collect()}
    checked = fixed.count()
    if min(checked, *(sizes.get(t, 0) for t in range(trials + 1))) < least:
        raise ValueError(f"fewer than {least} rows in a trial or in validation; raise the share")

    each = range(trials + 1)
    own = [table.where(F.array_contains("trials", t)).drop("trials") for t in each]
    stages = tuning.run_together(spark, [lambda t=t: models.preprocessing(spec).fit(own[t]) for t in each], at_once)
    to_fit = tuning.stage_parts([models.prepared(stages[t], own[t], spec, F.lit(t).alias("part")) for t in each], "trial-rows", sizes[0])
    to_check = tuning.stage_parts([models.prepared(stages[t], fixed, spec, F.lit(t).alias("part")) for t in each], "trial-checks", checked)
    cells = [(u, t) for u in tuned for t in each]
    done = tuning.run_together(spark, [
        lambda u=u, t=t: timed(lambda: u.candidate.with_params(u.point).fit(models.spread(to_fit.where(F.col("part") == t), sizes[t])))
        for u, t in cells], tuning.at_same_time(spark, sizes[0], at_once))

    by_trial = {t: [(u.candidate.name, model) for (u, v), (_, model) in zip(cells, done) if v == t] for t in each}
    limits = spark.createDataFrame([(u.candidate.name, float(u.threshold)) for u in tuned], "model string, threshold double")
    scored = evaluation.attach_thresholds(tuning.score_parts(to_check, by_trial, spec.label), limits, ["model"])
    measured = evaluation.metric_rows(scored, by=["model", "part"])
    notes = spark.createDataFrame([(u.candidate.name, t, sizes[t], seconds) for (u, t), (seconds, _) in zip(cells, done)],
                                  "model string, part int, train_rows long, fit_seconds double")
    few, metrics = Window.partitionBy("model"), ("auc_pr", "auc_roc", "positive_f1")
    whole = {m: F.max(F.when(F.col("part") == 0, F.col(m))).over(few) for m in metrics}
    return measured.join(notes, ["model", "part"]).select(
        "model", F.col("part").alias("trial"), "train_rows", "fit_seconds", "threshold", *[F.col(m) for m in metrics],
        *[(F.col(m) - whole[m]).alias(f"delta_{m}") for m in metrics]).where("trial > 0")


def score_all(fitted: dict, frame: DataFrame, keep: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Every model's scores over one frame as a long table, frozen: later actions read
    files instead of scoring again.

    The frame is scanned once: each model adds its score column, then every row fans out
    in place. Many rows of few files are dealt to all cores first.
    """
    wide, entries = models.spread(frame, frame.count(), frame.sparkSession.sparkContext.defaultParallelism), []
    for i, (name, model) in enumerate(fitted.items()):
        wide = models.score(model, wide, wide.columns, label=label, into=f"score_{i}")
        entries.append(F.struct(F.lit(name).alias("model"), F.col(f"score_{i}").alias("score")))
    long = wide.select(F.col(label).cast("double").alias("label"), *keep, F.inline(F.array(*entries)))
    return freeze(long, "scores")


def prepare_training(frame: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Cycle columns and pinned class weights, ready for any candidate."""
    return cohort.with_pinned_weights(models.add_cycle(frame, spec), spec.label, spec.weight)
