"""Local explanations for many rows at once.

Each explained row gets synthetic neighbours drawn from a background set; the
fitted model scores them all in one pass; a weighted linear surrogate per row is solved
from aggregated moments. Rows never gather in one task: moments fold in each Arrow batch
and one small vector per explained row reaches the solver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import columns as C
from cohortlens.operators import models
from cohortlens.spec import FeatureSpec


def explained_features(spec: FeatureSpec) -> tuple[list[str], list[str]]:
    """Numerics, and categories with the raw cyclic column among them."""
    cyclic = [] if spec.cyclic is None else [spec.cyclic[0]]
    return list(spec.numeric), [*spec.categories, *cyclic]


def background_profile(background: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One struct: mean and spread of numerics, and for each category its values with the
    rows up to and including each. Its width is the vocabulary, whatever the row count."""
    numeric, category = explained_features(spec)
    moments = []
    for c in numeric:
        moments += [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}__mean"),
                    F.coalesce(F.stddev_pop(c), F.lit(1.0)).alias(f"{c}__std")]
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias("value")) for c in category])
    counted = background.select(F.inline(cells)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rising = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("upto", F.sum("n").over(rising))
    lists = [F.sort_array(F.collect_list(F.when(F.col("feature") == c, F.struct("upto", "value")))).alias(f"{c}__values") for c in category]
    values = summed.agg(*lists)
    if not moments:
        return values.select(F.struct(*values.columns).alias("profile"))
    return values.select(F.struct(*values.columns, background.agg(*moments).select(F.struct("*")).scalar().alias("_moments")).alias("profile"))


# Background rows up to which a draw looks its value up in a list with an entry a row.
LISTED = 4096


def _value_at(place: Column, values: list, kind: T.DataType) -> Column:
    """The first value whose running count is above ``place``; NULL without values.

    A short list has an entry a background row, so the compiled code stays small; a long
    one is halved, one comparison a level.
    """
    if values and values[-1]["upto"] <= LISTED:
        entries = [v["value"] for v, before in zip(values, [0, *(u["upto"] for u in values)]) for _ in range(v["upto"] - before)]
        return F.element_at(F.lit(entries), (place + 1).cast("int")).cast(kind)
    if len(values) < 2:
        return F.lit(values[0]["value"] if values else None).cast(kind)
    middle = len(values) // 2
    return F.when(place < F.lit(values[middle - 1]["upto"]), _value_at(place, values[:middle], kind)).otherwise(_value_at(place, values[middle:], kind))


def neighbours(instances: DataFrame, key: str, background: DataFrame, spec: FeatureSpec, *,
               samples: int, seed: int) -> DataFrame:
    """``samples`` neighbours per row, the first being the row itself.

    Draws come from hashes of (key, sample number, feature): stable under retries.
    ``x_<feature>`` holds the surrogate input: a standardised numeric, or 1 where a
    category equals the explained row's. The background's profile is computed first and
    becomes literals: every draw is then plain arithmetic on the row.
    """
    numeric, category = explained_features(spec)
    profile = background_profile(background, spec).first()["profile"]
    # Spread the rows while they are narrow: each becomes many, and the grouping by key
    # that follows keeps this partitioning instead of shuffling again.
    tasks = int(instances.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own_values = instances.select(key, *[F.col(c).alias(f"{c}__own") for c in (*numeric, *category)])
    fanned = own_values.repartition(tasks, key).select(
        "*",
        F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample_no"),
    )
    first = F.col("sample_no") == 0
    moment = {c: (F.lit(profile["_moments"][f"{c}__mean"]), F.lit(profile["_moments"][f"{c}__std"])) for c in numeric}
    listed = {c: profile[f"{c}__values"] for c in category}

    def uniform(tag: int) -> Column:
        return C.hash_draw(key, "sample_no", seed=seed * 1009 + tag)

    # each place is a column of its own, drawn once and compared often
    places = {f"{c}__at": F.floor(uniform(1000 + i) * F.lit(listed[c][-1]["upto"] if listed[c] else None)) for i, c in enumerate(category)}
    cols: dict[str, Column] = {}
    for i, c in enumerate(numeric):
        mean, std = moment[c]
        own = F.coalesce(F.col(f"{c}__own"), mean)
        # one normal deviate from two uniforms; the first is kept off zero
        radius = F.sqrt(F.lit(-2.0) * F.log(F.greatest(uniform(2 * i), F.lit(1e-12))))
        normal = radius * F.cos(F.lit(2.0 * math.pi) * uniform(2 * i + 1))
        cols[c] = F.when(first, own).otherwise(mean + std * normal)
    for c in category:
        cols[c] = F.when(first, F.col(f"{c}__own")).otherwise(_value_at(F.col(f"{c}__at"), listed[c], instances.schema[c].dataType))
    drawn = fanned.withColumns(places).withColumns(cols)

    inputs: dict[str, Column] = {}
    for c in numeric:
        mean, std = moment[c]
        scale = F.when(std > 0, std).otherwise(F.lit(1.0))
        inputs[f"x_{c}"] = (F.col(c) - mean) / scale
        own = F.coalesce(F.col(f"{c}__own"), mean)
        inputs[f"d_{c}"] = F.pow((F.col(c) - own) / scale, F.lit(2.0))
    for c in category:
        same = F.coalesce((F.col(c) == F.col(f"{c}__own")), F.lit(False)).cast("double")
        inputs[f"x_{c}"] = same
        inputs[f"d_{c}"] = F.lit(1.0) - same
    names = [*numeric, *category]
    distance = sum((F.col(f"d_{c}") for c in names), F.lit(0.0))
    width = 0.75 * math.sqrt(len(names))
    kernel = F.sqrt(F.exp(-distance / F.lit(width * width)))
    return (
        drawn.withColumns(inputs).withColumn("kernel", kernel)
        .select(key, "sample_no", *names, *[f"x_{c}" for c in names], "kernel")
    )


def _moments(n: int):
    """Arrow batches of (key, sample_no, kernel, score, n inputs) to a row for each stretch of
    one key: the moments of its even and of its odd samples. Stretches of a key add up."""
    upper = np.triu_indices(n)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, odd = batch.column(0), batch.column(1).to_numpy() % 2 == 1
            w, y, *xs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 4 + n))
            x = np.stack(xs)
            wx = w * x
            terms = np.concatenate([[w, w * y, w * y * y], wx, wx * y, wx[upper[0]] * x[upper[1]]])
            here, before = key.slice(1), key.slice(0, batch.num_rows - 1)
            other = pc.fill_null(pc.not_equal(here, before), True).to_numpy(zero_copy_only=False)
            other &= ~(here.is_null().to_numpy(zero_copy_only=False) & before.is_null().to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], np.flatnonzero(other) + 1])
            sums = [np.add.reduceat(np.where(half, terms, 0.0), starts, axis=1) for half in (~odd, odd)]
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(starts)), *[pa.array(m) for half in sums for m in half]],
                names=["key", *[f"m{i}_{h}" for h in (0, 1) for i in range(len(terms))]])

    return run


def _fit(m: np.ndarray, n: int, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(weights, centred inputs times target, centred inputs squared, target's spread) of moments, a row each."""
    w, wy, wyy = m[:, 0], m[:, 1], m[:, 2]
    sx = m[:, 3:3 + n]
    sxy = m[:, 3 + n:3 + 2 * n]
    upper = np.triu_indices(n)
    sxx = np.zeros((len(m), n, n))
    sxx[:, upper[0], upper[1]] = m[:, 3 + 2 * n:]
    sxx[:, upper[1], upper[0]] = m[:, 3 + 2 * n:]
    # centring by weighted means leaves the intercept free of the penalty
    sxx -= sx[:, :, None] * sx[:, None, :] / w[:, None, None]
    sxy = sxy - sx * (wy / w)[:, None]
    beta = np.linalg.solve(sxx + ridge * np.eye(n), sxy[:, :, None])[:, :, 0]
    return beta, sxy, sxx, wyy - wy * wy / w


def _r2(beta: np.ndarray, sxy: np.ndarray, sxx: np.ndarray, total: np.ndarray) -> np.ndarray:
    left = total - 2 * (beta * sxy).sum(1) + np.einsum("bi,bij,bj->b", beta, sxx, beta)
    return np.where(total > 1e-12, 1 - left / np.where(total > 1e-12, total, 1), 0.0)


def _solver(n: int, ridge: float):
    """Scalar Pandas UDF over the moments of both halves of a row's neighbours: n weights,
    R squared, n differences between the halves' weights, and the R squared that the weights
    of one half have on the other."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(first: pd.Series, second: pd.Series) -> pd.Series:
        one, two = np.stack(first.to_numpy()), np.stack(second.to_numpy())
        beta, *rest = _fit(one + two, n, ridge)
        a, b = _fit(one, n, ridge), _fit(two, n, ridge)
        other = (_r2(a[0], *b[1:]) + _r2(b[0], *a[1:])) / 2
        return pd.Series(list(np.column_stack([beta, _r2(beta, *rest), np.abs(a[0] - b[0]), other])))

    return solve


def local_weights(model: PipelineModel, instances: DataFrame, key: str, background: DataFrame,
                  spec: FeatureSpec, *, samples: int = 500, seed: int = 31, ridge: float = 1.0,
                  top: int = 7) -> DataFrame:
    """(key, feature, local_weight, surrogate_r2, weight_gap, second_draw_r2): the ``top`` largest weights per row.

    Neighbours are two independent draws, even and odd ones, whose moments add up. Each half
    is also solved alone: ``weight_gap`` is how far its weights lie apart, and
    ``second_draw_r2`` how well weights of one draw explain the other. A weight below its
    gap, or a low second value, is noise of the sample, not of the model.
    """
    if samples < 4:
        raise ValueError("two draws of at least two neighbours are needed")
    numeric, category = explained_features(spec)
    names = [*numeric, *category]
    n = len(names)
    near = neighbours(instances, key, background, spec, samples=samples, seed=seed)
    ready = models.add_cycle(near, spec).withColumn(spec.label, F.lit(0.0))
    scored = models.score(model, ready, [key, "sample_no", *[f"x_{c}" for c in names], "kernel"], label=spec.label)

    # moments fold as arrays in each task; the grouping then sees few rows a key
    size = 3 + 2 * n + n * (n + 1) // 2
    columns = [f"m{i}_{h}" for h in (0, 1) for i in range(size)]
    kind = instances.schema[key].dataType.simpleString()
    folded = scored.select(F.col(key).alias("key"), "sample_no", "kernel", "score", *[f"x_{c}" for c in names]).mapInArrow(
        _moments(n), f"key {kind}, " + ", ".join(f"{c} double" for c in columns))
    summed = folded.groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])
    halves = summed.select(F.col("key").alias(key), *[F.array(*[f"m{i}_{h}" for i in range(size)]).alias(f"half_{h}") for h in (0, 1)])
    solved = halves.select(key, _solver(n, ridge)("half_0", "half_1").alias("s"))
    s = F.col("s")
    entries = F.array(*[
        F.struct(F.abs(s[i]).alias("size"), F.lit(c).alias("feature"), s[i].alias("local_weight"), s[n + 1 + i].alias("weight_gap"))
        for i, c in enumerate(names)
    ])
    largest = F.slice(F.sort_array(entries, asc=False), 1, min(top, n))
    return solved.select(key, s[n].alias("surrogate_r2"), s[2 * n + 1].alias("second_draw_r2"), F.inline(largest)).select(
        key, "feature", "local_weight", "surrogate_r2", "weight_gap", "second_draw_r2")
