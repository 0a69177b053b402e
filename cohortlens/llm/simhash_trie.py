"""SimHash near-duplicates by a self-join of binary tries of fingerprints.

Each text gets a 64-bit fingerprint of its shingles; texts link when their fingerprints
differ in at most ``most`` bits. Equal fingerprints are one leaf. The bits are cut into
blocks: of ``most + k`` blocks any linked pair agrees in ``k``, so each choice of ``k``
blocks, put in front, gives tries whose top levels agree and whose rest is joined with the
whole error budget. Node pairs are traversed together, whole frontiers at a time; the bits
in which they differ so far are added up, and a pair beyond the budget is left with
everything below it. Of the links in a trie only a spanning forest leaves the task.

A trie of more than ``LEAVES`` leaves is cut into parts. First every part is joined with
itself and all leaves with the trie's hub; what is connected then needs no further look,
so only parts of different components meet afterwards. No pair is lost on the way.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import Scratch, contract, extend

BITS = 64
SHINGLE_SEED = 42
# Leaves of one part of a trie, and the mean number for which the block count is chosen.
LEAVES, MEAN = 512, 64
# Texts taken from a batch at once, in bytes, and hashes counted at once.
SLICE_BYTES, HASHES = 4 << 20, 1 << 16
_U = np.uint64
# _TOP[k]: the first k bits
_TOP = np.array([(1 << BITS) - (1 << BITS - k) for k in range(BITS + 1)], _U)


def fingerprint(text: bytes, width: int) -> int:
    """Majority of the bits of all shingle hashes, repeats counted; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and the six white-space characters only
    if not words:
        return 0
    line, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    first = (ends - sizes)[: max(1, len(words) - width + 1)].tolist()
    last = ends[min(width, len(words)) - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for k in range(0, len(first), HASHES):
        hashes = np.array([digest(line[a:b], SHINGLE_SEED) for a, b in zip(first[k:k + HASHES], last[k:k + HASHES])], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(first)).tobytes(), "big")


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of text, at least one row each."""
    upto, i = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + most, "right")))
        yield batch.slice(i, j - i)
        i = j


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [fingerprint(t or b"", width) for t in part.column("text").cast(pa.binary()).to_pylist()]
                prints = pa.array(np.array(found, _U).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), prints],
                                                 names=[*(c for c in part.schema.names if c != "text"), "print"])

    return run


def _depth(differ: np.ndarray) -> np.ndarray:
    """The place of the first set bit, 64 where none is."""
    for k in (1, 2, 4, 8, 16, 32):
        differ = differ | differ >> _U(k)
    return BITS - np.bitwise_count(differ).astype(np.int64)


class Tries:
    """Binary tries over runs of sorted distinct values; chains without branches are one node.

    Node ``i`` covers values ``low[i]`` to ``high[i]``; ``depth[i]`` is the first bit in
    which they differ (64 at a leaf), ``child[i]`` its two children. The first nodes are
    the roots of the runs, which begin at ``starts``.
    """

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        self.values = values
        low, high = starts, np.append(starts[1:], values.size)
        lows, highs, depths, children, made = [], [], [], [], 0
        while low.size:
            depth = _depth(values[low] ^ values[high - 1])
            inner = np.flatnonzero(depth < BITS)
            a, b, bit = low[inner], high[inner], _U(1) << (BITS - 1 - depth[inner]).astype(_U)
            while (a < b).any():  # the first value whose bit is set
                mid = (a + b) >> 1
                one = (values[np.minimum(mid, values.size - 1)] & bit != 0) | (a >= b)
                a, b = np.where(one, a, mid + 1), np.where(one, np.minimum(b, mid), b)
            made += low.size
            child = np.full((low.size, 2), -1)
            child[inner] = made + np.arange(2 * inner.size).reshape(-1, 2)
            for all_, new in ((lows, low), (highs, high), (depths, depth), (children, child)):
                all_.append(new)
            low, high = np.column_stack([low[inner], a]).ravel(), np.column_stack([a, high[inner]]).ravel()
        self.low, self.high, self.depth, self.child = (np.concatenate(x) for x in (lows, highs, depths, children))

    def near(self, u: np.ndarray, v: np.ndarray, most: int, frontier: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of values below the node pairs (u, v) that differ in at most ``most`` bits.

        ``u == v`` stands for a trie against itself. A frontier that grows too wide is cut
        and its parts are taken one after the other, so memory stays bounded.
        """
        stack = [(u, v, np.zeros(u.size, np.int64), np.zeros(u.size, np.int64))]
        while stack:
            u, v, seen, differ = stack.pop()
            if u.size > frontier:
                stack += [tuple(x[half] for x in (u, v, seen, differ)) for half in (slice(frontier, None), slice(0, frontier))]
                continue
            # bits between the last branch above and the next one below
            down = np.minimum(self.depth[u], self.depth[v])
            gap = self.values[self.low[u]] ^ self.values[self.low[v]]
            differ = differ + np.bitwise_count(gap & _TOP[down] & ~_TOP[seen])
            leaf, own = down == BITS, u == v
            found = leaf & ~own & (differ <= most)
            if found.any():
                yield self.low[u[found]], self.low[v[found]]
            open_ = ~leaf & (differ <= most)
            u, v, own, down, differ = (x[open_] for x in (u, v, own, down, differ))
            if not u.size:
                continue
            first = ~own & (self.depth[u] == down)  # u branches here, else v
            second = ~own & ~first
            cu, cv = self.child[u], self.child[v]
            pairs = [(cu[own, 0], cu[own, 0], own), (cu[own, 1], cu[own, 1], own), (cu[own, 0], cu[own, 1], own),
                     (cu[first, 0], v[first], first), (cu[first, 1], v[first], first),
                     (u[second], cv[second, 0], second), (u[second], cv[second, 1], second)]
            stack.append((np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]),
                          np.concatenate([down[p[2]] for p in pairs]), np.concatenate([differ[p[2]] for p in pairs])))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels after the pairs (a, b) are joined: each node's is the least of its component."""
    while (label[a] != label[b]).any():
        low = np.minimum(label[a], label[b])
        label = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while ((up := label[label]) != label).any():
            label = up
    return label


def _join_cells(most: int):
    """Sorted rows (head, cell, side, value, print) -> links (a, b) of prints within each cell.

    Rows with side 0 meet each other, rows with side 1 those with side 2. Rows of a cell are
    next to each other and at most two parts; a batch is cut behind its last whole cell, and
    the rest waits for the next batch. At most rows - 1 links leave a cell.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(pieces)
        head, cell, side, value, prints = (rows.column(c).to_numpy() for c in ("head", "cell", "side", "value", "print"))
        new = (head[1:] != head[:-1]) | (cell[1:] != cell[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new | (side[1:] != side[:-1])]))
        tries = Tries(value.view(_U), starts)
        alone = np.flatnonzero(side[starts] == 0)
        joins_last = np.concatenate([[False], ~new])[starts] & (side[starts] == 2)
        second = np.flatnonzero(joins_last)
        label = np.arange(cell.size)
        for a, b in tries.near(np.concatenate([alone, second - 1]), np.concatenate([alone, second]), most):
            label = merge(label, a, b)
        other = np.flatnonzero(label != np.arange(cell.size))
        return pa.RecordBatch.from_arrays([pa.array(prints[label[other]]), pa.array(prints[other])], schema=schema)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            head, cell = batch.column("head").to_numpy(), batch.column("cell").to_numpy()
            if held and (held[-1].column("head")[-1].as_py(), held[-1].column("cell")[-1].as_py()) != (head[0], cell[0]):
                yield links(held)
                held = []
            ends = np.flatnonzero((head[1:] != head[:-1]) | (cell[1:] != cell[:-1])) + 1
            if ends.size:
                yield links([*held, batch.slice(0, ends[-1])])
                held, batch = [], batch.slice(ends[-1])
            held.append(batch)
        if held:
            yield links(held)

    return run, "a long, b long"


def _cells_to_links(cells: DataFrame, most: int) -> DataFrame:
    run, schema = _join_cells(most)
    rows = cells.select("head", "cell", "side", "value", "print")
    return rows.repartition("head", "cell").sortWithinPartitions("head", "cell", "side", F.shiftrightunsigned("value", 1), "value").mapInArrow(run, schema)


def plan_blocks(n: int, most: int, mean: int = MEAN) -> tuple[list[tuple[int, int]], int]:
    """Blocks as (first bit, width) and how many of them agree, so that tries of ``n``
    evenly spread fingerprints hold about ``mean`` leaves."""
    for agree in range(1, BITS - most + 1):
        count = most + agree
        edges = [BITS * i // count for i in range(count + 1)]
        if agree * (BITS // count) >= math.log2(max(n / mean, 1)) or agree == 4:
            return [(a, b - a) for a, b in itertools.pairwise(edges)], agree
    raise AssertionError


def _rotations(prints: DataFrame, most: int, n: int) -> DataFrame:
    """(rot, head, value, print): for each choice of agreeing blocks their bits, and the
    fingerprint with these bits in front."""
    blocks, agree = plan_blocks(n, most)
    entries = []
    for rot, chosen in enumerate(itertools.combinations(range(len(blocks)), agree)):
        order = [*(blocks[i] for i in chosen), *(blocks[i] for i in range(len(blocks)) if i not in chosen)]
        value, at = F.lit(0).cast("long"), BITS
        for first, width in order:
            at -= width
            bits = F.shiftrightunsigned("print", BITS - first - width).bitwiseAND((1 << width) - 1)
            value = value.bitwiseOR(F.shiftleft(bits, at))
        head = sum(blocks[i][1] for i in chosen)
        entries.append(F.struct(F.lit(rot).alias("rot"), F.shiftrightunsigned(value, BITS - head).alias("head"), value.alias("value")))
    return prints.select("print", F.inline(F.array(*entries)))


def link_prints(prints: DataFrame, most: int, scratch: Scratch, leaves: int = LEAVES) -> DataFrame:
    """(node, root) for every fingerprint (column ``print``, distinct longs) that has a link."""
    trie = ["rot", "head"]
    spread = scratch.keep(_rotations(prints, most, prints.count()), "rotations")
    # the hub of a trie is the leaf with the least hash, any would do
    tries = spread.groupBy(*trie).agg(F.count(F.lit(1)).alias("m"), F.min_by("print", F.xxhash64("print")).alias("hub")).where("m > 1")
    tries = scratch.keep(tries.withColumn("parts", F.ceil(F.col("m") / leaves).cast("int")), "tries")
    placed = spread.join(tries, trie).select(*trie, "value", "print", "hub", "parts", F.pmod(F.xxhash64("print", F.lit(12)), F.col("parts")).alias("part"))
    placed = scratch.keep(placed, "placed")
    own = placed.select("head", (F.col("part") * 65536 + F.col("rot")).alias("cell"), F.lit(0).alias("side"), "value", "print")
    to_hub = placed.where("parts > 1 and bit_count(print ^ hub) <= " + str(most)).select(F.col("print").alias("a"), F.col("hub").alias("b"))
    near = scratch.keep(_cells_to_links(own, most).union(to_hub), "near")
    roots = scratch.keep(contract(near, scratch), "roots")
    large = scratch.keep(placed.where("parts > 1").select(*trie, "value", "print"), "large")
    scratch.drop(spread, placed)
    if large.isEmpty():
        return roots

    # large tries: leaves of one large component form parts of their own, the others share parts
    rooted = large.join(roots, large["print"] == roots["node"], "left").select(*trie, "value", "print", F.coalesce("root", "print").alias("root"))
    rooted = scratch.keep(rooted, "rooted")
    kinds = rooted.groupBy(*trie, "root").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= leaves)
    kinds = scratch.keep(kinds.select(*trie, "root", F.col("root").alias("kind"), F.ceil(F.col("m") / leaves).alias("own_parts")), "kinds")
    kinded = rooted.join(kinds, [*trie, "root"], "left").select(*trie, "value", "print", "kind", "own_parts")
    pool = kinded.where("kind is null").groupBy(*trie).agg(F.ceil(F.count(F.lit(1)) / leaves).alias("pool_parts"))
    pool = scratch.keep(pool, "pool")
    every = kinds.select(*trie, "kind", F.col("own_parts").alias("parts")).union(pool.select(*trie, F.lit(None).cast("long"), "pool_parts"))
    every = every.select(*trie, "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    every = scratch.keep(every.withColumn("mark", F.xxhash64("kind", "part")), "parts")
    # parts of one component are connected already; a part of the others also meets itself
    x, y = every.alias("x"), every.alias("y")
    meet = x.join(y, trie).where("x.mark <= y.mark and (x.kind is null or y.kind is null or x.kind <> y.kind)")
    tiles = scratch.keep(meet.select(*trie, F.col("x.mark").alias("i"), F.col("y.mark").alias("j"), F.xxhash64("rot", "x.mark", "y.mark").alias("cell")), "tiles")
    sides = tiles.select(*trie, "cell", F.inline(F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("mark"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("mark"), F.lit(1).alias("side")), F.struct(F.col("j").alias("mark"), F.lit(2).alias("side"))))))
    marked = kinded.join(pool, trie, "left").select(*trie, "value", "print", F.xxhash64(
        "kind", F.pmod(F.xxhash64("print", F.lit(13)), F.coalesce("own_parts", "pool_parts"))).alias("mark"))
    far = scratch.keep(_cells_to_links(marked.join(sides, [*trie, "mark"]), most), "far")
    out = scratch.keep(extend(roots, far, scratch), "roots")
    scratch.drop(large, rooted, kinds, pool, every, tiles, near, far, roots)
    return out


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", most: int = 4, width: int = 4) -> DataFrame:
    """(ident, fingerprint, component_id): one row for each document.

    ``component_id`` is the smallest id that links of at most ``most`` differing bits reach,
    the document itself included. NULL, empty or wordless text: fingerprint zero, linked like
    any other. A NULL id is never the smallest one; a component of NULL ids only has a NULL
    component. Rows with one id are looked at one by one and share no link for it. Ids may
    have any type that can be ordered; other columns are not read. Very long texts are read
    whole, in bounded steps. Ties between equal fingerprints are one leaf. An empty frame
    stays empty.
    """
    if not 0 <= most <= 16:
        raise ValueError("most must lie in 0..16")
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = keyed.schema["ident"].dataType.simpleString()
    signed = scratch.keep(keyed.mapInArrow(_fingerprints(width), f"ident {kind}, print long"), "prints")
    leads = scratch.keep(signed.groupBy("print").agg(F.min("ident").alias("lead")), "leads")
    roots = link_prints(leads.select("print"), most, scratch)
    rooted = scratch.keep(leads.join(roots, leads["print"] == roots["node"], "left").select("print", "lead", F.coalesce("root", "print").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("lead").alias("least"))
    final = scratch.keep(rooted.join(least, "root").select("print", "least"), "final")
    out = signed.join(final, "print")
    return out.select(F.col("ident").alias(ident), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))
