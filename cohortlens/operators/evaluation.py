"""Binary-classifier evaluation: histograms, curves, exact areas, metric rows.

A scored frame has ``label`` (0/1), ``score`` and, for several models at once, key
columns named in ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.sources.shared import freeze, pin_small


def _positive() -> Column:
    return F.col("label") == 1


def score_stats(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_positive()).alias("positives"),
    )


def bucketed(scored: DataFrame, bins: int = 150, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``low``, ``high`` and the equal-width ``bucket`` of each score."""
    if bins < 2:
        raise ValueError("at least two score bins are needed")
    stats = score_stats(scored, by)
    if by:
        bounds = pin_small(stats.select(*by, F.col("min_score").alias("low"), F.col("max_score").alias("high")))
        ranged = scored.join(bounds, list(by))
    else:
        s = stats.select(F.struct("min_score", "max_score")).scalar()
        ranged = scored.withColumns({"low": s.getField("min_score"), "high": s.getField("max_score")})
    return ranged.withColumn("bucket", C.score_bucket(F.col("score"), F.col("low"), F.col("high"), bins))


def histogram(scored: DataFrame, bins: int = 150, by: Sequence[str] = ()) -> DataFrame:
    """At most ``bins`` rows per model leave the scan, whatever the input size."""
    return bucketed(scored, bins, by).groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_positive()).alias("positives"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def _needs_both(p: Column, n: Column, value: Column) -> Column:
    """Value, or an error at run time when a class is missing."""
    undefined = F.raise_error(F.lit("areas and curves need both classes; one class is missing"))
    return F.when((p == 0) | (n == 0), undefined.cast("double")).otherwise(value)


def curve(scored: DataFrame, bins: int = 150, by: Sequence[str] = ()) -> DataFrame:
    """ROC/PR points by falling threshold, starting with the nothing-flagged point.

    The running sums see only the histogram. The first point is emitted beside the top
    bucket, so the scored frame is not read again for it.
    """
    small = histogram(scored, bins, by)
    group = Window.partitionBy(*by)
    falling = group.orderBy(F.desc("bucket"))
    upto = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cell_neg = F.col("n") - F.col("positives")
    running = small.withColumns({
        "tp": F.sum("positives").over(upto),
        "fp": F.sum(cell_neg).over(upto),
        "p": F.sum("positives").over(group),
        "q": F.sum(cell_neg).over(group),
        "place": F.row_number().over(falling),
    })
    tp, fp, p, q = (F.col(c) for c in ("tp", "fp", "p", "q"))
    step = (F.col("high") - F.col("low")) / F.lit(float(bins))
    at = F.col("low") + F.col("bucket") * step

    def point(threshold, tp, fp, precision) -> Column:
        tpr = _needs_both(p, q, F.try_divide(tp.cast("double"), p.cast("double")))
        return F.struct(
            threshold.cast("double").alias("threshold"),
            _needs_both(p, q, F.try_divide(fp.cast("double"), q.cast("double"))).alias("fpr"),
            tpr.alias("tpr"), tpr.alias("recall"), precision.alias("precision"),
            tp.alias("tp"), fp.alias("fp"), (p - tp).alias("fn"), (q - fp).alias("tn"),
        )

    zero = F.lit(0).cast("bigint")
    own = point(at, tp, fp, C.safe_ratio(tp, tp + fp))
    first = point(F.col("high") + F.lit(1e-9), zero, zero, F.lit(1.0))
    rows = F.when(F.col("place") == 1, F.array(first, own)).otherwise(F.array(own))
    return running.select(*by, F.inline(rows))


def pick_threshold(points: DataFrame, beta: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest F-beta; the higher threshold wins a tie."""
    b2 = float(beta) ** 2
    pr, rc = F.col("precision"), F.col("recall")
    f = C.safe_ratio(F.lit(1.0 + b2) * pr * rc, F.lit(b2) * pr + rc)
    real = points.where(F.col("tp") + F.col("fp") > 0).withColumn("fbeta", f)
    best = F.max_by(F.struct("threshold", "fbeta", "precision", "recall"), F.struct("fbeta", "threshold"))
    whole = F.max(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return real.groupBy(*by).agg(best.alias("b"), whole.alias("validation_rows")).select(
        *by,
        F.col("b.threshold").alias("threshold"),
        F.round("b.fbeta", 6).alias("validation_fbeta"),
        F.round("b.precision", 6).alias("validation_precision"),
        F.round("b.recall", 6).alias("validation_recall"),
        "validation_rows",
    )


def select_threshold(scored: DataFrame, bins: int = 150, beta: float = 0.5,
                     by: Sequence[str] = ()) -> DataFrame:
    return pick_threshold(curve(scored, bins, by), beta, by)


def decisions(scored: DataFrame, threshold) -> DataFrame:
    return scored.withColumn("decision", C.decide("score", threshold))


def confusion(scored: DataFrame, threshold, by: Sequence[str] = ()) -> DataFrame:
    """Four cells per model in long form; an empty cell is a zero, not a missing row."""
    y, d = _positive(), C.decide("score", threshold) == 1
    cells = {"tn": ~y & ~d, "fp": ~y & d, "fn": y & ~d, "tp": y & d}
    wide = scored.groupBy(*by).agg(*[F.count_if(t).alias(c) for c, t in cells.items()])
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(c).alias("count")) for c in cells
    ])))


def base_rates(frame: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """No-skill precision per group."""
    return frame.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg("label").alias("base_rate"))


def sampled_auc(scored: DataFrame, metric: str, bins: int = 1000) -> float:
    """Spark's evaluator (areaUnderROC or areaUnderPR), down-sampled to ``bins`` points."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName=metric, numBins=bins
    ).evaluate(scored)


def cumulative_counts(scored: DataFrame, by: Sequence[str] = (), *, extra: Sequence[str] = (),
                      slices: int | None = None) -> DataFrame:
    """Per distinct score: ``pos``, ``neg`` and running ``tp``, ``fp`` from the top down.

    Rows fold into distinct scores, which are range-partitioned from the top, written once
    and summed: each range adds the totals of the ranges above it. It is the same path at
    every size; a score that a third of all rows share is one folded row. NaN ranks above
    every number and NULL below, infinities where they belong. ``extra`` columns are
    constant per model and ride along. ``slices`` fixes the number of ranges; the session's
    shuffle settings decide otherwise.
    """
    y = _positive()
    folded = scored.groupBy(*by, "score").agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"),
        *[F.first(c).alias(c) for c in extra],
    )
    falling = [*by, F.desc("score")]
    ranged = folded.repartitionByRange(*falling) if slices is None else folded.repartitionByRange(slices, *falling)
    kept = freeze(ranged.withColumn("slice", F.spark_partition_id()), "folded-scores")
    above = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = kept.groupBy(*by, "slice").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col("slice").alias("_slice"),
        F.coalesce(F.sum("p").over(above), zero).alias("tp_above"),
        F.coalesce(F.sum("q").over(above), zero).alias("fp_above"),
    )
    local = (Window.partitionBy(*by, "slice").orderBy(F.desc("score"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col("slice") == F.col("_slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    ranked = kept.withColumns({"tp": F.sum("pos").over(local), "fp": F.sum("neg").over(local)})
    return (
        ranked.join(offsets, same)
        .withColumns({"tp": F.col("tp") + F.col("tp_above"), "fp": F.col("fp") + F.col("fp_above")})
        .drop("slice", "_slice", "tp_above", "fp_above", *[f"_{c}" for c in by])
    )


def _area_sums() -> list[Column]:
    """Unscaled trapezoids: both areas still need dividing by the class totals."""
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    before_tp, before_all = tp - pos, tp - pos + fp - neg
    precision = tp / (tp + fp)
    # the curve starts flat: before the first score, precision equals the first one
    earlier = F.when(before_all > 0, F.try_divide(before_tp, before_all)).otherwise(precision)
    return [
        F.sum(neg * (tp - pos / F.lit(2.0))).alias("roc_sum"),
        F.sum(pos * (precision + earlier) / F.lit(2.0)).alias("pr_sum"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
    ]


def _areas() -> dict[str, Column]:
    p, q = F.col("p"), F.col("q")
    roc = F.try_divide(F.col("roc_sum"), p.cast("double") * q.cast("double"))
    pr = F.try_divide(F.col("pr_sum"), p.cast("double"))
    return {"auc_roc": _needs_both(p, q, roc), "auc_pr": _needs_both(p, q, pr)}


def exact_areas(scored: DataFrame, by: Sequence[str] = (), *, slices: int | None = None) -> DataFrame:
    """ROC and PR areas over every distinct score, no down-sampling."""
    summed = cumulative_counts(scored, by, slices=slices).groupBy(*by).agg(*_area_sums())
    return summed.select(*by, *[c.alias(n) for n, c in _areas().items()])


def metric_rows(scored: DataFrame, threshold=None, by: Sequence[str] = (), *,
                slices: int | None = None, digits: int | None = None) -> DataFrame:
    """One full metric row per model.

    ``threshold`` is a number, or None when the frame carries a ``threshold`` column that
    is constant per model. Confusion cells and both areas come from the same fold over
    distinct scores: the scored frame is shuffled once, already pre-aggregated.
    """
    framed = scored if threshold is None else scored.withColumn("threshold", F.lit(float(threshold)))
    ranked = cumulative_counts(framed, by, extra=("threshold",), slices=slices)
    zero = F.lit(0).cast("bigint")
    on = F.col("score") >= F.col("threshold")
    summed = ranked.groupBy(*by).agg(
        *_area_sums(),
        F.sum(F.when(on, F.col("pos")).otherwise(zero)).alias("tp"),
        F.sum(F.when(on, F.col("neg")).otherwise(zero)).alias("fp"),
        F.first("threshold").alias("threshold"),
    )
    tp, fp, p, q = (F.col(c) for c in ("tp", "fp", "p", "q"))
    fn, tn = p - tp, q - fp
    precision, recall = C.safe_ratio(tp, tp + fp), C.safe_ratio(tp, p)
    specificity = C.safe_ratio(tn, q)
    values = {
        "rows": p + q, "base_rate": C.safe_ratio(p, p + q),
        "tn": tn, "fp": fp, "fn": fn, "tp": tp,
        "accuracy": C.safe_ratio(tp + tn, p + q),
        "positive_precision": precision,
        "positive_recall": recall,
        "positive_f1": C.safe_ratio(F.lit(2.0) * precision * recall, precision + recall),
        "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / F.lit(2.0),
        **_areas(),
        "threshold": F.col("threshold"),
    }
    counts = {"rows", "tn", "fp", "fn", "tp"}
    shown = [
        (v if n in counts or digits is None else F.round(v, digits)).alias(n) for n, v in values.items()
    ]
    return summed.select(*by, *shown)


def attach_thresholds(scored: DataFrame, thresholds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each model's own threshold beside its scores."""
    chosen = pin_small(thresholds.select(*by, "threshold"))
    return scored.join(chosen, list(by))
