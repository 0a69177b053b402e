"""Evaluation operators against brute force in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import audit as A
from cohortlens.operators import evaluation as E
from cohortlens.operators import robustness as R
from cohortlens.operators import sampling, selection

SCHEMA = "model string, label double, score double, grp string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for model in ("a", "b"):
        for i in range(400):
            y = float(rng.random() < 0.4)
            s = 0.25 if i % 3 == 0 else round(rng.random() * 0.8 + 0.2 * y, 3)  # a third share one score
            out.append((model, y, s, rng.choice(["x", "y", "z", "Unknown"])))
    return out


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_areas(pairs):
    """Pairwise ROC area; PR area by trapezoids over falling distinct scores."""
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    tp = fp = 0
    last_recall, last_precision, pr = 0.0, None, 0.0
    for s in sorted({s for _, s in pairs}, reverse=True):
        tp += sum(1 for p in pos if p == s)
        fp += sum(1 for n in neg if n == s)
        recall, precision = tp / len(pos), tp / (tp + fp)
        pr += (recall - last_recall) * (precision + (precision if last_precision is None else last_precision)) / 2
        last_recall, last_precision = recall, precision
    return roc, pr


@pytest.mark.parametrize("slices", [None, 1, 12])
def test_exact_areas(scored, rows, slices):
    got = {r.model: (r.auc_roc, r.auc_pr) for r in E.exact_areas(scored, ["model"], slices=slices).collect()}
    for model in ("a", "b"):
        roc, pr = brute_areas([(y, s) for m, y, s, _ in rows if m == model])
        assert abs(got[model][0] - roc) < 1e-12 and abs(got[model][1] - pr) < 1e-12


def test_areas_match_the_builtin_evaluator(scored):
    one = scored.where("model = 'a'")
    ours = E.exact_areas(one).first()
    assert abs(ours.auc_roc - E.sampled_auc(one, "areaUnderROC", bins=0)) < 1e-12
    assert abs(ours.auc_pr - E.sampled_auc(one, "areaUnderPR", bins=0)) < 1e-12


@pytest.mark.parametrize("odd", [[None], [float("nan")], [float("inf"), float("-inf")], [None, float("nan"), float("-inf"), float("inf")]])
def test_odd_scores_have_fixed_places(spark, odd):
    """NaN above infinity, NULL below minus infinity, the same at any number of ranges."""
    rows = [(float(i % 2), i / 100) for i in range(100)] + [(y, s) for s in odd for y in (1.0, 0.0, 1.0)]
    f = spark.createDataFrame(rows, "label double, score double")
    one, many = E.exact_areas(f, slices=1).first(), E.exact_areas(f, slices=9).first()
    assert abs(one.auc_roc - many.auc_roc) < 1e-12 and abs(one.auc_pr - many.auc_pr) < 1e-12
    big = float("1e9")
    place = {None: -2 * big, float("-inf"): -big, float("inf"): big}
    plain = [(y, place.get(s, s) if s is None or s == s else 2 * big) for y, s in rows]
    roc, pr = brute_areas(plain)
    assert abs(one.auc_roc - roc) < 1e-12 and abs(one.auc_pr - pr) < 1e-12


def test_no_scores_at_all(spark):
    f = spark.createDataFrame([(1.0, None), (0.0, None)], "label double, score double")
    assert E.exact_areas(f).first().auc_roc == 0.5


def test_metric_row(scored, rows):
    r = E.metric_rows(scored.where("model = 'a'"), 0.5).first()
    mine = [(y, s) for m, y, s, _ in rows if m == "a"]
    tp = sum(y == 1 and s >= 0.5 for y, s in mine)
    fp = sum(y == 0 and s >= 0.5 for y, s in mine)
    assert (r.tp, r.fp, r.tp + r.fn + r.fp + r.tn, r.rows) == (tp, fp, 400, 400)
    assert abs(r.positive_precision - tp / (tp + fp)) < 1e-12
    cells = {c.cell: c["count"] for c in E.confusion(scored.where("model = 'a'"), 0.5).collect()}
    assert cells == {"tn": r.tn, "fp": r.fp, "fn": r.fn, "tp": r.tp}


def test_nothing_flagged_gives_zero_not_error(scored):
    r = E.metric_rows(scored.where("model = 'a'"), 9.0).first()
    assert (r.tp, r.fp, r.positive_precision, r.positive_recall, r.positive_f1) == (0, 0, 0.0, 0.0, 0.0)


def test_curve_points(scored, rows):
    got = E.curve(scored.where("model = 'a'"), 20).orderBy(F.desc("threshold")).collect()
    first, last = got[0], got[-1]
    top = max(s for m, _, s, _ in rows if m == "a")
    assert (first.tp, first.fp, first.precision, first.recall) == (0, 0, 1.0, 0.0)
    assert abs(first.threshold - (top + 1e-9)) < 1e-12
    assert (last.tpr, last.fpr, last.fn, last.tn) == (1.0, 1.0, 0, 0)
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(got, got[1:])) and len(got) <= 21


def test_curve_refuses_one_class(spark):
    f = spark.createDataFrame([(1.0, 0.1), (1.0, 0.9)], "label double, score double")
    with pytest.raises(Exception, match="one class is missing"):
        E.curve(f, 10).collect()
    with pytest.raises(Exception, match="one class is missing"):
        E.metric_rows(f, 0.5).collect()
    with pytest.raises(ValueError):
        E.histogram(f, 1)


def test_equal_scores_make_one_bucket(spark):
    f = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5)], "label double, score double")
    got = E.curve(f, 10).orderBy("tp").collect()
    assert [(p.tp, p.fp) for p in got] == [(0, 0), (1, 1)] and got[1].threshold == 0.5


def test_threshold_maximises_fbeta(scored):
    points = [p for p in E.curve(scored.where("model = 'b'"), 30).collect() if p.tp + p.fp]

    def f(p):
        d = 0.25 * p.precision + p.recall
        return 1.25 * p.precision * p.recall / d if d else 0.0

    best = max(points, key=lambda p: (f(p), p.threshold))
    got = E.select_threshold(scored.where("model = 'b'"), 30).first()
    assert got.threshold == best.threshold and got.validation_fbeta == round(f(best), 6) and got.validation_rows == 400


def test_audit_and_ratio(spark):
    rows = [(1.0, 0.9, "a"), (0.0, 0.8, "a"), (1.0, 0.1, "b"), (0.0, 0.2, "b"), (1.0, 0.9, "Unknown"), (1.0, 0.9, "c")]
    f = spark.createDataFrame(rows, "label double, score double, grp string")
    groups = A.audit_groups(f, 0.5, "grp", minimum=2)
    got = {r.grp: r for r in groups.collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].tpr, got["a"].fpr, got["a"].precision) == (1.0, 1.0, 0.5)
    assert (got["b"].tpr, got["b"].precision) == (0.0, None)
    assert [r.grp for r in A.suppressed_groups(f, 0.5, "grp", minimum=2).collect()] == ["c"]
    assert A.parity_ratio(groups).first().min_over_max_rate == 0.0
    assert A.parity_ratio(A.audit_groups(f, 5.0, "grp", minimum=2)).first().min_over_max_rate is None
    assert A.parity_ratio(A.audit_groups(f, 0.5, "grp", minimum=99)).first().min_over_max_rate is None
    pair = A.pair_ratio(f, 0.5, "grp", "a", "b").first()
    assert (pair.favoured_rate, pair.other_rate, pair.impact_ratio) == (1.0, 0.0, None)


def test_perturbation(spark):
    f = spark.range(400).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "23").otherwise("8").alias("hour"),
        F.when(F.col("id") % 4 == 0, "Unknown").otherwise("Queens").alias("grp"), (F.col("id") % 2).cast("double").alias("label"))
    draw = lambda seed: R.C.hash_draw("row_id", seed=seed)
    got = R.perturb(f, draw(3), R.shift_and_hide(0.4))
    assert sorted(got.collect()) == sorted(R.perturb(f.repartition(7), draw(3), R.shift_and_hide(0.4)).collect())
    assert sorted(got.collect()) != sorted(R.perturb(f, draw(4), R.shift_and_hide(0.4)).collect())
    rows = {r.row_id: r for r in got.collect()}
    for old in f.collect():
        new = rows[old.row_id]
        assert new.label == old.label and not (new.hour_shifted and new.group_masked)
        assert new.hour == ({"23": "0", "8": "9"}[old.hour] if new.hour_shifted else old.hour)
        if new.group_masked:
            assert old.grp == "Queens" and new.grp == "Unknown"
    t = R.tallies(got).first()
    assert t.rows == 400 and t.positives == 200 and 50 < t.hour_shifted + t.group_masked < 160
    for bad in (0, 1):
        with pytest.raises(ValueError):
            R.perturb(f, draw(3), R.shift_and_hide(bad))


def test_ranking_and_selection(spark):
    before = spark.createDataFrame([("a", .5, .6, .7), ("b", .5, .6, .7), ("c", .5, .6, .7)], "model string, positive_f1 double, auc_roc double, auc_pr double")
    after = spark.createDataFrame([("a", .4, .6, .7), ("b", .5, .5, .7), ("c", .5, .6, .7)], before.schema)
    got = {r.model: (r["rank"], r.stability) for r in R.rank_by_impact(R.metric_deltas(before, after)).collect()}
    assert got["c"] == (1, "most stable") and {got["a"][0], got["b"][0]} == {2, 3}
    grid = spark.createDataFrame([("m", 0, .7), ("m", 1, .9), ("m", 2, .9)], "model string, grid_index int, metric double")
    assert selection.best_points(grid).first().grid_index == 1
    assert [r.is_best for r in selection.mark_best(grid).orderBy("grid_index").collect()] == [False, True, False]
    fits = spark.createDataFrame([("slow", .9, 100.0), ("fast", .896, 5.0), ("poor", .5, 1.0)], "model string, m double, cost double")
    assert selection.recommend(fits, metric="m", cost="cost").first().model == "fast"


def test_samples(spark):
    f = spark.range(5000).withColumn("label", (F.col("id") % 2).cast("double"))
    a, b = (sampling.by_key(f.repartition(n), "id", 0.2, 9) for n in (2, 5))
    assert sorted(a.collect()) == sorted(b.collect()) and 850 < a.count() < 1150
    back = sampling.background(f, "id", 50, 1)
    assert back.count() == 50 and sorted(back.collect()) == sorted(sampling.background(f.repartition(6), "id", 50, 1).collect())
    with pytest.raises(ValueError):
        sampling.background(f, "id", 5, 1)
    wide = sampling.background(spark.range(1_000_000), "id", 200, 29, hashed=False).collect()
    assert min(r.id for r in wide) < 50_000 and max(r.id for r in wide) > 950_000
    assert [sum(k * 100_000 <= r.id < (k + 1) * 100_000 for r in wide) > 5 for k in range(10)] == [True] * 10
    trials = sampling.bootstrap_rates(f, "id", 4, 2).collect()
    assert [t.trial for t in trials] == [1, 2, 3, 4]
    assert all(4700 < t.rows_drawn < 5300 and abs(t.rate - .5) < .05 for t in trials)
