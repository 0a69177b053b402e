"""Evaluation, robustness-delta and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.operators import audit as A
from cohortlens.operators import evaluation as E
from cohortlens.operators import robustness as R
from cohortlens.plans import views as V
from cohortlens.plans.cohort_queries import cohort
from cohortlens.plans.registry import query
from cohortlens.sources.shared import pin_small

BINS = 150
T = 0.35

# ---- SQL building blocks -------------------------------------------------------------


def hist_sql(source: str, keys: str = "", bins: int = BINS) -> str:
    """CTEs ``stats``, ``hist`` and ``points`` over a scored source."""
    by = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    link = f"USING ({keys})" if keys else "ON TRUE"
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""
, stats AS (SELECT {by}min(score) AS low, max(score) AS high FROM {source} {group}),
hist AS (SELECT {by}CASE WHEN high = low THEN CAST(0 AS BIGINT) ELSE CAST(greatest(0, least({bins - 1},
           floor((score - low) / (high - low) * CAST({bins} AS DOUBLE)))) AS BIGINT) END AS bucket,
           count(*) AS n, count(*) FILTER (WHERE label = 1) AS positives, min(low) AS low, max(high) AS high
         FROM {source} JOIN stats {link} GROUP BY ALL_KEYS),
runs AS (SELECT {by}low, high, bucket,
           CAST(sum(positives) OVER w AS BIGINT) AS tp, CAST(sum(n - positives) OVER w AS BIGINT) AS fp,
           CAST(sum(positives) OVER ({part}) AS BIGINT) AS p, CAST(sum(n - positives) OVER ({part}) AS BIGINT) AS q
         FROM hist WINDOW w AS ({part} ORDER BY bucket DESC ROWS UNBOUNDED PRECEDING)),
points AS (
  SELECT {by}low + bucket * ((high - low) / CAST({bins} AS DOUBLE)) AS threshold, tp, fp, p, q,
         CAST(tp AS DOUBLE) / (tp + fp) AS precision FROM runs
  UNION ALL
  SELECT DISTINCT {by}high + CAST(1e-9 AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), p, q, CAST(1 AS DOUBLE) FROM runs)
""".replace("GROUP BY ALL_KEYS", f"GROUP BY {by}2" if keys else "GROUP BY 1")


def area_sql(source: str, keys: str = "") -> str:
    """CTE ``areas`` with exact ROC and PR areas over distinct scores."""
    by = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
, folded AS (SELECT {by}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
             FROM {source} GROUP BY {by}score),
cum AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp FROM folded
        WINDOW w AS ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
prec AS (SELECT *, tp / (tp + fp) AS pr,
                coalesce(lag(tp / (tp + fp)) OVER ({part} ORDER BY score DESC), tp / (tp + fp)) AS pr0 FROM cum),
areas AS (SELECT {by}sum(neg * (tp - pos / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc_roc,
                 sum(pos * (pr + pr0) / CAST(2 AS DOUBLE)) / CAST(sum(pos) AS DOUBLE) AS auc_pr
          FROM prec {group})
"""


def metric_select(cells: str, keys: str = "", join: str = "", extra: str = "") -> str:
    """Metric row from a CTE with tp, fp, fn, tn, auc_roc, auc_pr, threshold."""
    by = f"{keys}, " if keys else ""
    z = "CAST(0 AS DOUBLE)"
    return f"""
SELECT {by}tp + fp + fn + tn AS rows, round(CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn), 6) AS base_rate,
       tn, fp, fn, tp, round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy,
       round(pr, 6) AS positive_precision, round(rc, 6) AS positive_recall,
       round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE {z} END, 6) AS positive_f1,
       round(sp, 6) AS specificity, round((rc + sp) / 2, 6) AS balanced_accuracy,
       round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr, round(threshold, 6) AS threshold {extra}
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE {z} END AS pr,
             CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE {z} END AS rc,
             CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE {z} END AS sp
      FROM {cells}) m {join}"""


_CELL_COUNTS = """count(*) FILTER (WHERE label = 0 AND NOT {d}) AS tn, count(*) FILTER (WHERE label = 0 AND {d}) AS fp,
       count(*) FILTER (WHERE label = 1 AND NOT {d}) AS fn, count(*) FILTER (WHERE label = 1 AND {d}) AS tp"""

# ---- scores of one model -------------------------------------------------------------


@query("eval_score_stats", V.SCORES_SQL + """
SELECT min(score) AS min_score, max(score) AS max_score, count(*) AS rows,
       count(*) FILTER (WHERE label = 1) AS positives FROM scores""")
def eval_score_stats(spark, d):
    return E.score_stats(V.scores(spark, d))


@query("eval_score_buckets", V.SCORES_SQL + hist_sql("scores") + """
SELECT label, score, bucket FROM (
  SELECT label, score, CAST(greatest(0, least(149, floor((score - low) / (high - low) * CAST(150 AS DOUBLE)))) AS BIGINT) AS bucket
  FROM scores, stats)""")
def eval_score_buckets(spark, d):
    return E.bucketed(V.scores(spark, d), BINS).select("label", "score", "bucket")


@query("eval_histogram", V.SCORES_SQL + hist_sql("scores") + "SELECT bucket, n, positives FROM hist")
def eval_histogram(spark, d):
    return E.histogram(V.scores(spark, d), BINS).select("bucket", "n", "positives")


_POINTS = """round(threshold, 9) AS threshold, round(CAST(fp AS DOUBLE) / q, 6) AS fpr, round(CAST(tp AS DOUBLE) / p, 6) AS tpr,
       round(CAST(tp AS DOUBLE) / p, 6) AS recall, round(precision, 6) AS precision, tp, fp, p - tp AS fn, q - fp AS tn"""


def _shown(points):
    return points.withColumns({
        "threshold": F.round("threshold", 9),
        **{c: F.round(c, 6) for c in ("fpr", "tpr", "recall", "precision")},
    })


@query("eval_curve", V.SCORES_SQL + hist_sql("scores") + f"SELECT {_POINTS} FROM points")
def eval_curve(spark, d):
    return _shown(E.curve(V.scores(spark, d), BINS))


@query("eval_curve_by_model", V.MODEL_SCORES_SQL + hist_sql("model_scores", "model") + f"SELECT model, {_POINTS} FROM points")
def eval_curve_by_model(spark, d):
    return _shown(E.curve(V.model_scores(spark, d), BINS, ["model"]))


_PICK = """
, cand AS (SELECT *, CAST(tp AS DOUBLE) / p AS recall FROM points WHERE tp + fp > 0),
fb AS (SELECT *, CASE WHEN 0.25 * precision + recall > 0
                 THEN CAST(1.25 AS DOUBLE) * precision * recall / (CAST(0.25 AS DOUBLE) * precision + recall)
                 ELSE CAST(0 AS DOUBLE) END AS f FROM cand)
"""


@query("eval_select_threshold", V.SCORES_SQL + hist_sql("scores") + _PICK + """
SELECT round(threshold, 9) AS threshold, round(f, 6) AS validation_fbeta, round(precision, 6) AS validation_precision,
       round(recall, 6) AS validation_recall, p + q AS validation_rows
FROM fb ORDER BY f DESC, threshold DESC LIMIT 1""")
def eval_select_threshold(spark, d):
    return E.select_threshold(V.scores(spark, d), BINS).withColumn("threshold", F.round("threshold", 9))


@query("eval_decision", V.SCORES_SQL + f"""
SELECT label, score, CASE WHEN score >= {T} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS decision FROM scores""")
def eval_decision(spark, d):
    return E.decisions(V.scores(spark, d), T)


@query("eval_confusion", V.SCORES_SQL + f"""
, c AS (SELECT {_CELL_COUNTS.format(d=f'(score >= {T})')} FROM scores)
SELECT 'tn' AS cell, tn AS count FROM c UNION ALL SELECT 'fp', fp FROM c
UNION ALL SELECT 'fn', fn FROM c UNION ALL SELECT 'tp', tp FROM c""")
def eval_confusion(spark, d):
    return E.confusion(V.scores(spark, d), T)


@query("eval_auc_roc", V.SCORES_SQL + area_sql("scores") + "SELECT round(auc_roc, 9) AS auc_roc FROM areas")
def eval_auc_roc(spark, d):
    return E.exact_areas(V.scores(spark, d)).select(F.round("auc_roc", 9).alias("auc_roc"))


@query("eval_auc_pr", V.SCORES_SQL + area_sql("scores") + "SELECT round(auc_pr, 9) AS auc_pr FROM areas")
def eval_auc_pr(spark, d):
    return E.exact_areas(V.scores(spark, d)).select(F.round("auc_pr", 9).alias("auc_pr"))


@query("eval_auc_evaluator", V.SCORES_SQL + area_sql("scores")
       + "SELECT round(auc_roc, 9) AS auc_roc, round(auc_pr, 9) AS auc_pr FROM areas")
def eval_auc_evaluator(spark, d):
    """Spark's own evaluator: below its 1000 points it keeps every distinct score."""
    scored = V.scores(spark, d).persist()
    try:
        areas = [E.sampled_auc(scored, m) for m in ("areaUnderROC", "areaUnderPR")]
    finally:
        scored.unpersist()
    row = spark.createDataFrame([tuple(areas)], "auc_roc double, auc_pr double")
    return row.select(*[F.round(c, 9).alias(c) for c in row.columns])


@query("eval_auc_sliced", V.MODEL_SCORES_SQL + area_sql("model_scores", "model")
       + "SELECT model, round(auc_roc, 9) AS auc_roc, round(auc_pr, 9) AS auc_pr FROM areas")
def eval_auc_sliced(spark, d):
    """Both areas over many ranges of scores."""
    areas = E.exact_areas(V.model_scores(spark, d), ["model"], slices=40)
    return areas.select("model", F.round("auc_roc", 9).alias("auc_roc"), F.round("auc_pr", 9).alias("auc_pr"))


@query("eval_metrics", V.SCORES_SQL + area_sql("scores") + f"""
, cells AS (SELECT * FROM (SELECT {_CELL_COUNTS.format(d=f'(score >= {T})')}, CAST({T} AS DOUBLE) AS threshold FROM scores), areas)
""" + metric_select("cells"))
def eval_metrics(spark, d):
    return E.metric_rows(V.scores(spark, d), T, digits=6)


@query("eval_base_rate", V.MODEL_SCORES_SQL + """
SELECT part, count(*) AS rows, round(avg(label), 6) AS base_rate FROM base GROUP BY 1""")
def eval_base_rate(spark, d):
    item = V.table(spark, d, "lineitem").select(
        (F.col("l_discount") > 0.055).cast("double").alias("label"),
        F.when(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "validation")
        .otherwise("test").alias("part"))
    return E.base_rates(item, ["part"]).withColumn("base_rate", F.round("base_rate", 6))


# ---- several models: threshold on validation, metrics on test --------------------------

_TUNED = V.MODEL_SCORES_SQL + """
, val AS (SELECT model, label, score FROM model_scores WHERE part = 'validation'),
tst AS (SELECT model, label, score FROM model_scores WHERE part = 'test')
""" + hist_sql("val", "model") + _PICK + """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f DESC, threshold DESC) AS rn FROM fb),
chosen AS (SELECT model, threshold, f FROM ranked WHERE rn = 1)
"""
_TEST_CELLS = area_sql("tst", "model") + f"""
, cells AS (SELECT * FROM (
    SELECT model, threshold, {_CELL_COUNTS.format(d='(score >= threshold)')}
    FROM tst JOIN chosen USING (model) GROUP BY model, threshold) JOIN areas USING (model))
"""


def tuned(spark, d):
    scored = V.model_scores(spark, d)
    chosen = E.select_threshold(scored.where(F.col("part") == "validation"), BINS, by=["model"])
    return E.attach_thresholds(scored.where(F.col("part") == "test"), chosen, ["model"]), chosen


@query("eval_model_table", _TUNED + _TEST_CELLS + metric_select("cells", "model"))
def eval_model_table(spark, d):
    test, _ = tuned(spark, d)
    return E.metric_rows(test, by=["model"], digits=6)


@query("eval_winner_decisions", _TUNED + """
, win AS (SELECT model, threshold FROM chosen ORDER BY round(f, 6) DESC, model LIMIT 1)
SELECT model, label, CASE WHEN score >= threshold THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS decision,
       count(*) AS n FROM tst JOIN win USING (model) GROUP BY 1, 2, 3""")
def eval_winner_decisions(spark, d):
    scored = V.model_scores(spark, d)
    chosen = E.select_threshold(scored.where(F.col("part") == "validation"), BINS, by=["model"])
    winner = chosen.orderBy(F.desc("validation_fbeta"), "model").limit(1)
    picked = E.attach_thresholds(scored.where(F.col("part") == "test"), winner, ["model"])
    decided = picked.withColumn("decision", C.decide("score", F.col("threshold")))
    return decided.groupBy("model", "label", "decision").agg(F.count(F.lit(1)).alias("n"))


# ---- perturbed metrics ------------------------------------------------------------------


def _before_after(spark, d):
    """Formula models before and after moving a fifth of the scores, at fixed thresholds.

    Both sides of a row fan out in place, so one pass measures them together.
    """
    scored = V.model_scores(spark, d).where(F.col("part") == "test")
    moved = F.when(C.key_draw(F.floor(F.col("score") * 1000).cast("bigint"), 31) < 0.2, F.col("score") * 0.5).otherwise(F.col("score"))
    sides = scored.select("model", "label", F.inline(F.array(
        F.struct(F.lit("base").alias("side"), F.col("score").alias("score")),
        F.struct(F.lit("moved").alias("side"), moved.alias("score")))))
    measured = pin_small(E.metric_rows(sides, 0.45, ["model", "side"]))
    return measured.where("side = 'base'"), measured.where("side = 'moved'")


_MOVED = V.MODEL_SCORES_SQL + """
, src AS (SELECT model, label, score, CASE WHEN """ + V.draw_sql("CAST(floor(score * 1000) AS BIGINT)", 31) + """ < 0.2
                 THEN score * CAST(0.5 AS DOUBLE) ELSE score END AS moved FROM model_scores WHERE part = 'test'),
sides AS (SELECT model || '|base' AS mk, label, score FROM src UNION ALL SELECT model || '|pert', label, moved FROM src)
""" + area_sql("sides", "mk") + f"""
, cells AS (SELECT * FROM (SELECT mk, CAST(0.45 AS DOUBLE) AS threshold, {_CELL_COUNTS.format(d='(score >= 0.45)')}
            FROM sides GROUP BY mk) JOIN areas USING (mk)),
f AS (SELECT split_part(mk, '|', 1) AS model, split_part(mk, '|', 2) AS side, auc_roc, auc_pr,
             CASE WHEN tp > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE CAST(0 AS DOUBLE) END AS f1 FROM cells),
deltas AS (SELECT b.model, b.f1 AS base_positive_f1, b.auc_roc AS base_auc_roc, b.auc_pr AS base_auc_pr,
             p.f1 AS perturbed_positive_f1, p.auc_roc AS perturbed_auc_roc, p.auc_pr AS perturbed_auc_pr,
             p.f1 - b.f1 AS delta_positive_f1, p.auc_roc - b.auc_roc AS delta_auc_roc, p.auc_pr - b.auc_pr AS delta_auc_pr,
             abs(p.f1 - b.f1) + abs(p.auc_roc - b.auc_roc) AS impact_score
           FROM f b JOIN f p ON b.model = p.model AND b.side = 'base' AND p.side = 'pert')
"""
_DELTA_COLUMNS = [f"{s}_{m}" for s in ("base", "perturbed", "delta") for m in R.COMPARED] + ["impact_score"]


@query("robust_delta_join", _MOVED + "SELECT model, "
       + ", ".join(f"round({c}, 6) + CAST(0 AS DOUBLE) AS {c}" for c in _DELTA_COLUMNS) + " FROM deltas")
def robust_delta_join(spark, d):
    return R.metric_deltas(*_before_after(spark, d), digits=6)


@query("robust_rank", _MOVED + """
SELECT model, round(impact_score, 6) AS impact_score, CAST(row_number() OVER (ORDER BY impact_score, model) AS INTEGER) AS rank,
       CASE row_number() OVER (ORDER BY impact_score, model) WHEN 1 THEN 'most stable'
            WHEN (SELECT count(*) FROM deltas) THEN 'least stable' END AS stability FROM deltas""")
def robust_rank(spark, d):
    ranked = R.rank_by_impact(R.metric_deltas(*_before_after(spark, d)))
    return ranked.select("model", F.round("impact_score", 6).alias("impact_score"), "rank", "stability")


@query("robust_delta_summary", """
WITH t AS (SELECT event_type AS model, hour(ts) AS trial, avg(value) AS m FROM events GROUP BY 1, 2),
b AS (SELECT event_type AS model, avg(value) AS m FROM events GROUP BY 1),
x AS (SELECT t.model, abs(t.m - b.m) AS size FROM t JOIN b USING (model))
SELECT model, count(*) AS trials, round(avg(size), 6) AS mean_abs_delta, round(median(size), 6) AS median_abs_delta,
       round(max(size), 6) AS max_abs_delta FROM x GROUP BY 1""")
def robust_delta_summary(spark, d):
    """Hourly means against the overall mean, folded from one pass over the events."""
    hourly = V.table(spark, d, "events").groupBy(F.col("event_type").alias("model"), F.hour("ts").alias("trial")).agg(
        F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
    overall = hourly.groupBy("model").agg((F.sum("s") / F.sum("n")).alias("m"))
    trials = hourly.join(overall, "model").select("model", "trial", (F.col("s") / F.col("n") - F.col("m")).alias("delta_auc_pr"))
    return R.delta_summary(trials, digits=6)


# ---- group audit ------------------------------------------------------------------------

_AUDIT_MIN = 2500
_AUDIT = V.TRIPS_SQL + f"""
, a AS (SELECT grp, count(*) AS n, count(*) FILTER (WHERE label = 1) AS obs, count(*) FILTER (WHERE score >= {T}) AS flagged,
          count(*) FILTER (WHERE label = 1 AND score >= {T}) AS hits FROM cohort WHERE grp <> 'Unknown' GROUP BY 1)
"""


@query("audit_groups", _AUDIT + """
SELECT grp, n, round(CAST(obs AS DOUBLE) / n, 6) AS observed_positive_rate,
       round(CAST(flagged AS DOUBLE) / n, 6) AS predicted_positive_rate,
       round(CAST(hits AS DOUBLE) / nullif(obs, 0), 6) AS tpr, round(CAST(flagged - hits AS DOUBLE) / nullif(n - obs, 0), 6) AS fpr,
       round(CAST(hits AS DOUBLE) / nullif(flagged, 0), 6) AS precision FROM a WHERE n >= 1000""")
def audit_groups(spark, d):
    return A.audit_groups(cohort(spark, d), T, "grp", minimum=1000, digits=6)


@query("audit_suppressed", _AUDIT + f"SELECT grp, n FROM a WHERE n < {_AUDIT_MIN * 2}")
def audit_suppressed(spark, d):
    return A.suppressed_groups(cohort(spark, d), T, "grp", minimum=_AUDIT_MIN * 2)


@query("audit_ratio", _AUDIT + """
SELECT count(*) AS groups, round(min(CAST(flagged AS DOUBLE) / n) / nullif(max(CAST(flagged AS DOUBLE) / n), 0), 6) AS min_over_max_rate
FROM a WHERE n >= 1000""")
def audit_ratio(spark, d):
    return A.parity_ratio(A.audit_groups(cohort(spark, d), T, "grp", minimum=1000), digits=6)


@query("audit_pair_ratio", V.TRIPS_SQL + f"""
, r AS (SELECT avg(CASE WHEN score >= {T} THEN 1.0 ELSE 0.0 END) FILTER (WHERE grp = 'ASIA') AS a,
               avg(CASE WHEN score >= {T} THEN 1.0 ELSE 0.0 END) FILTER (WHERE grp = 'AFRICA') AS b FROM cohort)
SELECT round(a, 6) AS favoured_rate, round(b, 6) AS other_rate, round(a / b, 6) AS impact_ratio, a / b > 1.25 AS flagged FROM r""")
def audit_pair_ratio(spark, d):
    return A.pair_ratio(cohort(spark, d), T, "grp", "ASIA", "AFRICA", digits=6)
