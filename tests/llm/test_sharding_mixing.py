import collections

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import mixing, sharding
from cases import EDGES, words


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_one_to_one_and_walks_back(n):
    permutation = sharding.Permutation(n, seed=5)
    places = permutation(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert (permutation(places, back=True) == np.arange(n)).all()


def test_permutation_depends_on_the_seed_and_scatters():
    a, b = (sharding.Permutation(10_000, s)(np.arange(10_000)) for s in (1, 2))
    assert (a != b).mean() > 0.99
    assert abs(np.corrcoef(np.arange(10_000), a)[0, 1]) < 0.05


def test_shards_are_even_gapless_and_independent_of_layout(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [{(r.doc_id, r.shard, r.slot) for r in sharding.shard_rows(d, [F.col("doc_id")], 7, 3).collect()} for d in (docs, docs.repartition(5, "text"))]
    assert rows[0] == rows[1]
    by = collections.defaultdict(list)
    for _, shard, slot in rows[0]:
        by[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = sorted(r[0] for r in rows[0])
    place = sharding.Permutation(len(order), 3)(np.arange(len(order)))
    assert {(d, int(p) % 7, int(p) // 7) for d, p in zip(order, place)} == rows[0]


def test_whole_rows_are_written_nowhere_and_equal_rows_share_places(spark, monkeypatch):
    """Rows alike but for a NULL's place, a zero's sign or the text stay apart; copies are counted."""
    kinds = "doc_id long, text string, lang string, x double"
    some = [(1, "a", None, 0.0), (1, None, "a", 0.0), (1, "a", None, -0.0), (None, "b", "c", 1.0), *[(2, "t", "u", 2.0)] * 9, (2, "v", "u", 2.0)]
    kept = []
    keep = sharding.Scratch.keep
    monkeypatch.setattr(sharding.Scratch, "keep", lambda self, frame, label: kept.append(frame.columns) or keep(self, frame, label))
    got = sharding.shard_rows(spark.createDataFrame(some, kinds).repartition(4), [F.col("doc_id")], 3, 2).collect()
    text = lambda r: repr((r[0], r[1], r[2], r[3]))
    assert sorted(map(text, got)) == sorted(map(text, some))
    assert sorted(r.row_number for r in got) == sorted(r.slot * 3 + r.shard for r in got) == list(range(len(some)))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.row_number)] == [None, 1, 1, 1, *[2] * 10]
    assert kept and not any("text" in columns for columns in kept)


def test_sharding_edges(edges, nothing):
    out = sharding.shard_rows(edges, [F.col("doc_id")], 4, 1)
    got = out.select("shard", "slot", "n").collect()
    assert len(got) == len(EDGES) and {r.n for r in got} == {"x"}
    assert sorted((r.slot * 4 + r.shard) for r in got) == list(range(len(EDGES)))
    assert sharding.shard_rows(nothing, [F.col("doc_id")], 4, 1).count() == 0


def mixed_in_sql(frame):
    con = duckdb.connect()
    con.register("documents", frame.select("doc_id", "text", "source").toPandas())
    return con.sql(mixing.MIX_SQL).fetchall()


def test_mix_agrees_with_sql_and_nears_its_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source").collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(mixed_in_sql(docs))
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_excess_is_reshared_until_no_target_is_above_its_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 400, None: 90}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), [5, 2, 1], 1.5, 2.0).collect()
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    free, left, expect = dict(weight), 1.5 * sum(sizes.values()), {}
    while True:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > 2 * sizes[s]]
        if not over:
            expect.update(share)
            break
        for s in over:
            expect[s] = 2.0 * sizes[s]
            left -= expect[s]
            del free[s]
    assert {r.source: pytest.approx(r.target) for r in got} == expect


def test_mixing_edges(edges, nothing):
    got = mixing.mix_sources(edges).select("doc_id", "text", "size", "taken").collect()
    assert len(got) == len(EDGES)
    assert all(r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size for r in got)
    again = mixing.mix_sources(edges.repartition(3)).select("doc_id", "text", "size", "taken").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_sources(nothing).count() == 0
