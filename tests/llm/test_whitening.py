"""Whitening against a dense eigenvalue solver and whole-number sums."""

import numpy as np
import pytest

from cohortlens.llm import whitening as W
from cohortlens.llm.queries import QUERIES


@pytest.mark.parametrize("kind", ["random", "equal", "low rank", "diagonal", "blocks", "close", "one", "two"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.standard_normal((48, 48)))[0]
    half = rng.standard_normal((48, 48))
    matrix = {
        "random": half @ half.T, "equal": turn @ np.diag(np.repeat([5.0, 1.0, 0.0], 16)) @ turn.T, "low rank": half[:, :3] @ half[:, :3].T,
        "diagonal": np.diag(np.arange(20.0)), "blocks": np.kron(np.eye(6), [[2.0, 1.0], [1.0, 2.0]]),
        "close": turn @ np.diag(1 + 1e-10 * np.arange(48)) @ turn.T, "one": np.array([[3.0]]), "two": np.array([[2.0, 1.0], [1.0, 5.0]]),
    }[kind]
    values, vectors = W.leading_pairs(matrix, 16)
    scale, k = np.abs(matrix).max(), min(16, len(matrix))
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() < 1e-13 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def brute(rows, components):
    """The contract by dense linear algebra: {(id, component): values}, eigenvalues."""
    usable = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in usable:
        y = [n * a - s for a, s in zip(x, sums)]
        out.append((i, n, sum(d * d for d in y), np.array(y) / n @ vectors / np.sqrt(values)))
    return out, values, np.trace(centred.T @ centred / n)


def test_query_is_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, values, trace = brute([(r.vec_id, r.embedding) for r in rows], 16)
    got = {(r.vec_id, r.component): r for r in QUERIES["op13_whiten"](spark, sf).collect()}
    assert len(got) == 16 * len(want)
    gap = np.abs(np.diff(values)).min()
    for k in range(16):
        mine = np.array([got[i, k + 1].whitened for i, *_ in want])
        theirs = np.array([w[k] for *_, w in want])
        theirs *= np.sign(mine @ theirs)
        assert np.abs(mine - theirs).max() < 1e-8 * max(1, 1 / gap)
        assert got[want[0][0], k + 1].explained == pytest.approx(values[k] / trace, rel=1e-9)
    for i, n, deviation, _ in want:
        assert (got[i, 1].n, got[i, 1].deviation) == (n, deviation)
    assert {r.identity_error for r in got.values()} == {next(iter(got.values())).identity_error}
    assert 0 <= next(iter(got.values())).identity_error < 1e-9


def test_edges(spark):
    schema = "vec_id string, embedding array<float>, component string, x string, n string"
    good = [[1.0, 2.0, 0.5], [0.0, 1.0, 0.25], [3.0, -1.0, 2.0], [0.5, 0.5, 0.5]]
    rows = [(str(i), v, "c", "x", "n") for i, v in enumerate(good)]
    bad = [(None, good[0], "c", None, None), ("0", good[0], None, None, None), ("n", None, "c", "x", "n"), ("p", [1.0, None, 2.0], "c", "x", "n"),
           ("q", [1.0, float("nan"), 2.0], "c", "x", "n"), ("i", [float("inf"), 1.0, 2.0], "c", "x", "n"), ("s", [1.0], "c", "x", "n"), ("e", [], "c", "x", "n")]
    frame = spark.createDataFrame(rows + bad, schema)
    got = W.whiten(frame)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    assert sorted((r.vec_id or "") for r in found) == sorted(["0", "0", "", "1", "2", "3"] * 3)
    want, values, trace = brute([(r[0], r[1]) for r in rows + bad[:2]], 3)
    assert {(r.vec_id, r.n, r.deviation) for r in found} == {(i, n, d) for i, n, d, _ in want}
    assert sorted({round(r.explained, 9) for r in found}) == sorted(round(v / trace, 9) for v in values)
    assert W.whiten(frame.where("false")).collect() == []
    same = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], "vec_id string, embedding array<double>")
    assert W.whiten(same).collect() == []


def test_large_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1e15, 2.0]), (4, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = W.whiten(frame).collect()
    assert len({r.vec_id for r in found}) == 4
    assert {r.deviation for r in found if r.vec_id in (1, 2)} == {None}
