"""SimHash trie join against brute force."""

import re

import numpy as np
import pytest
import xxhash
from cases import LOWER, words

from cohortlens.llm import simhash_trie as S
from cohortlens.llm.queries import QUERIES
from cohortlens.llm.tables import Scratch


def fingerprint(text):
    found = words((text or "").translate(LOWER))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i:i + 4]).encode(), 42) for i in range(max(1, len(found) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, most=4):
    """The least place of each print's component, by comparing all pairs."""
    prints, label = np.asarray(prints, np.uint64), list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ p) <= most) + i + 1:
            a, b = sorted((top(i), top(int(j))))
            label[b] = a
    return [top(i) for i in range(len(prints))]


def ball(rng, n, flips):
    out = np.full(n, 0xC0FFEE123456789A, np.uint64)
    for _ in range(flips):
        out ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return out


def test_traversal_finds_all_pairs():
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([ball(rng, 150, k) for k in (2, 4, 7)] + [rng.integers(0, 1 << 63, 200, dtype=np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)]))
    tries = S.Tries(values, np.array([0]))
    found = {(min(a, b), max(a, b)) for x, y in tries.near(np.array([0]), np.array([0]), 4, frontier=64) for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    assert found == {(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def test_two_tries_meet():
    rng = np.random.default_rng(4)
    a, b = np.unique(ball(rng, 80, 3)), np.unique(ball(rng, 60, 5))
    tries = S.Tries(np.concatenate([a, b]), np.array([0, a.size]))
    found = {(i, j - a.size) for x, y in tries.near(np.array([0]), np.array([1]), 4) for i, j in zip(x.tolist(), y.tolist())}
    assert found == set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 4))))


@pytest.mark.parametrize("most", [0, 1, 4])
@pytest.mark.parametrize("n", [1, 10**7, 10**10])
def test_blocks_cover_the_bits(n, most):
    blocks, agree = S.plan_blocks(n, most)
    assert sum(w for _, w in blocks) == 64 and len(blocks) == most + agree


@pytest.mark.parametrize("leaves", [8, 512])
def test_links_in_parts_and_whole(spark, leaves):
    """A dense family, one with strays around it, and single prints; parts lose nothing."""
    rng = np.random.default_rng(5)
    far = ball(rng, 40, 12)
    values = np.unique(np.concatenate([ball(rng, 120, 1), ball(rng, 120, 4), far, far ^ np.uint64(0b1011), rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long")
    got = {r.node: r.root for r in S.link_prints(frame, 4, Scratch(spark), leaves=leaves).collect()}
    roots = [got.get(int(v), int(v)) for v in values.view(np.int64)]
    want = brute_groups(values)
    assert len(set(zip(roots, want))) == len(set(roots)) == len(set(want))


def test_query_is_brute_force(spark, sf):
    rows = {r.doc_id: r for r in QUERIES["op12_simhash"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    prints = [fingerprint(d.text) for d in docs]
    assert len(rows) == len(docs)
    assert [rows[d.doc_id].fingerprint for d in docs] == [f"{p:016x}" for p in prints]
    assert [rows[d.doc_id].component_id for d in docs] == [docs[i].doc_id for i in brute_groups(prints)]


def test_edges(edges, nothing):
    got = S.near_duplicates(edges)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = got.collect()
    assert len(rows) == edges.count()
    want = {(r.doc_id, f"{fingerprint(r.text):016x}") for r in edges.collect()}
    assert {(r.doc_id, r.fingerprint) for r in rows} == want
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}  # NULL, empty, blank
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 2}
    assert S.near_duplicates(nothing).collect() == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two three"), ("a", "one two three"), (None, "other words here")], "doc_id string, text string")
    got = {(r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == {("a", "a"), ("b", "a"), (None, None)}


def test_only_ascii_case_and_six_blanks():
    assert S.fingerprint("Ä B c d".encode(), 4) == fingerprint("Ä B c d")
    assert re.fullmatch(r"[0-9a-f]{16}", f"{S.fingerprint(b'x' * 70_000, 4):016x}")
