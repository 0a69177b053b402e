"""Exact set-similarity join over word shingles with prefix trees.

Two documents link when ``100 * |A and B| >= percent * |A or B|``. Sets are globally ordered:
by how many documents a sample met them in, then by hash. Every linked pair shares a shingle among
the first ``n - ceil(n * percent / 100) + 1`` of both, so candidates meet on these prefixes;
within a candidate group the sets stand in a trie that a probe walks, sharing the overlap
of common paths and leaving subtrees whose remaining lengths cannot reach the bound.

Equal sets become one class first. Large groups of near copies are joined to a hub found by
min-hashing before prefixes are compared; after that only classes in different groups need
a look, and no pairs are listed within a group. The result is exact whatever the hubs are.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.simhash_trie import text_slices
from cohortlens.llm.tables import Scratch, bit_filter, contract, has_bit, roomy_bits
from cohortlens.llm.text import mix, shingle_sets

HUB_HASHES = 8
HUB_SHARED = 3
# One document in so many tells how frequent shingles are; it orders, it drops nothing. A level
# holds those met so often in the sample, and has a filter of so many bits.
ORDER_SAMPLE = 8
ORDER_LEVELS = ((2, 1 << 25), (4, 1 << 24), (8, 1 << 24), (32, 1 << 23), (128, 1 << 23))
GROUP = 64
SLICE_BYTES = 1 << 20
# Groups beyond which a shared shingle is settled in tiles of its cluster, not pair by pair.
MANY, TILE = 64, 256
# Sets of a cluster that every block of it meets, and probes after which marks are renewed.
PIVOTS, RENEW = 32, 16
# Pairs, and tiles, whose sets are shuffled at the same time: some 2 GB of sets of 500 shingles.
PAIRS_AT_ONCE, TILES_AT_ONCE = 1 << 19, 1 << 10
SHORT = 2048
_SEEDS = np.random.default_rng(4).integers(1, 1 << 63, (HUB_HASHES, 1), dtype=np.uint64) | np.uint64(1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def class_of(tokens: np.ndarray) -> int:
    """64 bits that name the set."""
    parts = np.array([np.bitwise_xor.reduce(mix(tokens)), np.sum(mix(tokens ^ np.uint64(0x5851F42D4C957F2D))), tokens.size], np.uint64)
    return int(_signed(mix(mix(parts[:1]) + mix(parts[1:2]) * np.uint64(3) + parts[2:]))[0])


def needed_overlap(n: int, m: int, percent: int) -> int:
    """The least overlap of sets of n and m that links them."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class Trie:
    """Sorted sets as paths; a chain without branches is one node holding all its tokens."""

    __slots__ = ("tokens", "held", "children", "ends", "low", "high", "kind")

    def __init__(self, tokens: np.ndarray):
        self.tokens, self.children, self.ends = tokens, {}, []
        self.held = frozenset(tokens.tolist()) if tokens.size <= SHORT else None  # quicker to intersect
        self.low = self.high = 0  # fewest and most tokens from the node's start to a set's end
        self.kind = None  # the component of all sets below, if it is one

    @classmethod
    def of(cls, named: list[tuple[int, np.ndarray]]) -> Trie:
        root = cls(np.zeros(0, np.uint64))
        root._fill(named)
        return root

    def _fill(self, named: list[tuple[int, np.ndarray]]) -> None:
        groups: dict[int, list] = {}
        for name, rest in named:
            if rest.size:
                groups.setdefault(int(rest[0]), []).append((name, rest))
            else:
                self.ends.append(name)
        for token, members in groups.items():
            shared = min(r.size for _, r in members)
            first = members[0][1][:shared]
            for _, r in members[1:]:
                differ = np.flatnonzero(r[:shared] != first[:shared])
                shared = int(differ[0]) if differ.size else shared
            node = Trie(first[:shared])
            node._fill([(name, r[shared:]) for name, r in members])
            self.children[token] = node
        reach = [(c.low, c.high) for c in self.children.values()] + [(0, 0)] * bool(self.ends)
        self.low = self.tokens.size + min((x for x, _ in reach), default=0)
        self.high = self.tokens.size + max((x for _, x in reach), default=0)

    def mark(self, component) -> int | None:
        """Notes at every node the one component of all sets below, asked by name; None if several."""
        kinds = {component(name) for name in self.ends} | {child.mark(component) for child in self.children.values()}
        self.kind = kinds.pop() if len(kinds) == 1 else None
        return self.kind

    def search(self, probe: np.ndarray, percent: int, known=None) -> Iterator[tuple[int, int, int]]:
        """(name, size, overlap) of the stored sets that the probe links with.

        Subtrees for whose component ``known`` is true are left out.
        """
        own = frozenset(probe.tolist())
        stack = [(self, 0, 0, 0)]  # node, tokens above it, overlap so far, place in the probe
        while stack:
            node, depth, overlap, place = stack.pop()
            if known is not None and node.kind is not None and known(node.kind):
                continue
            if node.held is not None:
                overlap += len(own & node.held)
            else:
                overlap += np.intersect1d(probe, node.tokens, assume_unique=True).size
            if node.children and node.tokens.size:
                place = int(np.searchsorted(probe, node.tokens[-1], "right"))
            depth += node.tokens.size
            for name in node.ends:
                if overlap >= needed_overlap(probe.size, depth, percent):
                    yield name, depth, overlap
            for child in node.children.values():
                # no set below is shorter than this, and neither side can add more than it has left
                least = needed_overlap(probe.size, depth + child.low, percent)
                if overlap + min(child.high, probe.size - place) >= least:
                    stack.append((child, depth, overlap, place))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of their texts, so sets of a few texts are held at a time."""
    for batch in batches:
        yield from text_slices(batch, "text", SLICE_BYTES)


def _signatures(width: int, kind: str):
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches):
        for batch in _slices(batches):
            rows = []
            for tokens in shingle_sets(batch.column("text"), width):
                if not tokens.size:
                    rows.append((None, 0, None, None))
                    continue
                name = class_of(tokens)
                rows.append((name, tokens.size, _signed((tokens * _SEEDS).min(1)), _signed(tokens) if name % ORDER_SAMPLE == 0 else None))
            yield pa.RecordBatch.from_arrays([batch.column("ident"), batch.column("key"), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                                             names=["ident", "key", "class", "n", "hashes", "sample"])

    return run, f"ident {kind}, key long, class long, n long, hashes array<long>, sample array<long>"


def _some_sets(width: int, wanted: np.ndarray):
    """(class, tokens) of the documents whose key may be wanted."""
    schema = pa.schema([("class", pa.int64()), ("tokens", pa.binary())])

    def run(batches):
        for batch in _slices(batches):
            keep = has_bit(wanted, batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            some = batch.filter(pa.array(keep))
            sets = [x for x in shingle_sets(some.column("text"), width)]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(x) if x.size else None for x in sets], pa.int64()),
                                              pa.array([x.tobytes() for x in sets], pa.binary())], schema=schema)

    return run, "class long, tokens binary"


def frequency_level(tokens: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many of the filters hold each token. What a filter holds by chance only comes later."""
    return sum((has_bit(f, tokens).astype(np.int64) for f in levels), np.zeros(tokens.size, np.int64))


def _prefixes(percent: int, width: int, leads: np.ndarray, levels: list[np.ndarray]):
    schema = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("edge", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        for batch in _slices(batches):
            keep = has_bit(leads, batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            some = batch.filter(pa.array(keep))
            names, sizes, edges, starts = [], [], [], []
            for tokens in shingle_sets(some.column("text"), width):
                if tokens.size:
                    level = frequency_level(tokens, levels)
                    order = np.argsort(level, kind="stable")[:prefix_length(tokens.size, percent)]
                    names.append(class_of(tokens))
                    sizes.append(tokens.size)
                    edges.append(int(tokens[order[-1]] >> np.uint64(4)) | int(level[order[-1]]) << 60)
                    starts.append(_signed(tokens[order]))
            flat = pa.array(np.concatenate(starts) if starts else np.zeros(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s) for s in starts)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(edges, pa.int64()), lists], schema=schema)

    return run, "class long, n long, edge long, prefix array<long>"


def _matching(mixed: np.ndarray):
    names = ["class", "n", "edge"]
    schema = pa.schema([*((c, pa.int64()) for c in names), ("token", pa.int64())])

    def run(batches):
        for batch in batches:
            lists = batch.column("prefix")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            keep = has_bit(mixed, flat.view(np.uint64)) if flat.size else np.zeros(0, bool)
            owner = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(owner) for c in names), pa.array(flat[keep])], schema=schema)

    return run, "class long, n long, edge long, token long"


def _rounds(frame: DataFrame, keys: list[str], rows: int, at_once: int) -> list[DataFrame]:
    """The frame's rows dealt by a hash of the keys to frames of about ``at_once`` of its ``rows``."""
    rounds = max(1, -(-rows // at_once))
    return [frame.where(F.pmod(F.xxhash64(*keys, F.lit(6)), F.lit(rounds)) == k) for k in range(rounds)] if rounds > 1 else [frame]


def _written(frames: Iterator[DataFrame], label: str, scratch: Scratch) -> DataFrame:
    """All rows, each frame written before the next one runs, so that only its shuffles lie on disk."""
    parts = [scratch.keep(f, label) for f in frames]
    if len(parts) == 1:
        return parts[0]
    whole = scratch.keep(functools.reduce(DataFrame.union, parts), label)
    scratch.drop(*parts)
    return whole


def verified(pairs: DataFrame, keyed: DataFrame, classes: DataFrame, percent: int, width: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of classes that link, with their overlap.

    Sets are read again for the classes named only. Probes meet tries of about ``GROUP``
    sets: a probe with many partners is repeated beside each part of them. Sets are
    shuffled for ``PAIRS_AT_ONCE`` pairs at a time.
    """
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = bit_filter(ends.join(classes, "class").select("lead"), "lead")
    run, schema = _some_sets(width, wanted)
    sets = scratch.keep(keyed.mapInArrow(run, schema).where("class is not null"), "sets")
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"))
    parted = scratch.keep(pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / GROUP)).cast("int").alias("part")), "parted")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        probe, others = rows[rows["probe"]], rows[~rows["probe"]]
        named = [(int(b), np.frombuffer(t, np.uint64)) for b, t in zip(others["b"], others["tokens"])]
        found = list(Trie.of(named).search(np.frombuffer(probe["tokens"].iloc[0], np.uint64), percent)) if len(probe) and named else []
        return pd.DataFrame({"a": np.full(len(found), rows["a"].iloc[0], np.int64), "b": np.array([x[0] for x in found], np.int64),
                             "overlap": np.array([x[2] for x in found], np.int64)})

    def met(some: DataFrame) -> DataFrame:
        stored = some.join(sets.withColumnRenamed("class", "b"), "b").select("a", "part", "b", "tokens", F.lit(False).alias("probe"))
        probes = some.select("a", "part").distinct().join(sets.withColumnRenamed("class", "a"), "a").select("a", "part", F.lit(0).cast("long").alias("b"), "tokens", F.lit(True).alias("probe"))
        return stored.union(probes).groupBy("a", "part").applyInPandas(walk, "a long, b long, overlap long")

    out = _written(map(met, _rounds(parted, ["a", "part"], parted.count(), PAIRS_AT_ONCE)), "verified", scratch)
    scratch.drop(sets, parted)
    return out


def _shortfall(n: str, m: str, left: str, percent: int) -> str:
    """SQL: shared prefix tokens that a pair of sizes n and m needs when ``left`` more can follow."""
    return f"ceil({percent} * ({n} + {m}) / {100 + percent}) - {left}"


def _open_pairs(posts: DataFrame, roots: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): classes of different groups that share enough of their prefixes to link.

    Up to the end of the prefix that ends first, both prefixes show every shared token;
    behind it, no more can be shared than that set has left. So the tokens shared must
    make up the rest of the overlap. First groups are compared, with bounds over the sizes
    of their members, so a large group is one row a token; then members of those left.
    """
    behind = lambda n: f"(ceil({percent} * {n} / 100) - 1)"
    x, y = roots.alias("x"), roots.alias("y")
    met = x.join(y, F.col("x.token") == F.col("y.token")).where(
        f"x.root < y.root and 100 * y.hi >= {percent} * x.lo and 100 * x.hi >= {percent} * y.lo")
    corner = lambda n, m: _shortfall(n, m, f"greatest({behind(n)}, {behind(m)})", percent)
    groups = met.groupBy(F.col("x.root").alias("left"), F.col("y.root").alias("right")).agg(
        F.count(F.lit(1)).alias("shared"), F.min("x.lo").alias("x1"), F.max("x.hi").alias("x2"), F.min("y.lo").alias("y1"), F.max("y.hi").alias("y2"))
    # the shortfall falls as the larger set grows and the smaller shrinks; 2 covers rounding
    groups = scratch.keep(groups.where(f"shared >= least({corner('x2', 'y1')}, {corner('x1', 'y2')}) - 2").select("left", "right"), "group-pairs")
    ours = posts.join(groups, posts["root"] == groups["left"]).select("token", "right", F.col("class").alias("a"), F.col("n").alias("n"), F.col("edge").alias("edge"))
    theirs = posts.select("token", F.col("root").alias("right"), F.col("class").alias("b"), F.col("n").alias("m"), F.col("edge").alias("other"))
    both = ours.join(theirs, ["token", "right"]).where(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    counted = both.groupBy("a", "b", "n", "m", "edge", "other").agg(F.count(F.lit(1)).alias("shared"))
    left = f"case when edge < other then {behind('n')} when other < edge then {behind('m')} else greatest({behind('n')}, {behind('m')}) end"
    return counted.where(f"shared >= {_shortfall('n', 'm', left, percent)}").select("a", "b").distinct()


def _joins(probes: list[tuple[int, np.ndarray]], stored: list[tuple[int, np.ndarray]], root: dict[int, int], percent: int) -> list[tuple[int, int]]:
    """Links between the roots of the sets, as many as join what they join and no more.

    What is joined already is not looked at again: marks in the trie are renewed now and
    then, and subtrees of the probe's own component are left out.
    """
    top = {r: r for r in root.values()}

    def find(r: int) -> int:
        while top[r] != r:
            top[r] = r = top[top[r]]
        return r

    trie, links, left = Trie.of(stored), [], len(top)
    for k, (name, tokens) in enumerate(probes):
        if left == 1:
            break
        if k % RENEW == 0:
            trie.mark(lambda c: find(root[c]))
        own = root[name]
        for other, _, _ in trie.search(tokens, percent, lambda kind: find(kind) == find(own)):
            a, b = find(own), find(root[other])
            if a != b:
                top[max(a, b)] = min(a, b)
                links.append((own, root[other]))
                left -= 1
    return links


def _walk_tile(percent: int):
    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        """Sets of side 0 meet each other, those of side 1 meet those of side 2."""
        root = dict(zip(rows["class"].tolist(), rows["root"].tolist()))
        named = [(c, np.frombuffer(t, np.uint64)) for c, t in zip(rows["class"].tolist(), rows["tokens"])]
        side = rows["side"].to_numpy()
        probes, stored = ([x for x, s in zip(named, side) if s in wanted] for wanted in ((0, 1), (0, 2)))
        links = _joins(probes, stored, root, percent) if probes and stored else []
        return pd.DataFrame({"a": np.array([a for a, _ in links], np.int64), "b": np.array([b for _, b in links], np.int64)})

    return walk


def _in_tiles(members: DataFrame, keyed: DataFrame, classes: DataFrame, percent: int, width: int, scratch: Scratch) -> DataFrame:
    """(a, b): links between the roots of members (cluster, class, root) of one cluster.

    A cluster is cut into blocks of about ``TILE`` sets. First each block is joined with
    itself and with the same ``PIVOTS`` sets of its cluster, so that a dense family is one
    component after as many rows as it has sets. Then sets of one large component form
    parts of their own, the others share parts, and only parts that are not of one
    component meet, ``TILES_AT_ONCE`` tiles at a time. Of the links in a tile only a spanning
    forest leaves it.
    """
    run, schema = _some_sets(width, bit_filter(members.join(classes, "class").select("lead"), "lead"))
    sets = scratch.keep(keyed.mapInArrow(run, schema).where("class is not null"), "cluster-sets")
    sized = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"), F.ceil(F.count(F.lit(1)) / PIVOTS).alias("shares"))
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    placed = members.join(sized, "cluster").select("cluster", "class", "root", "blocks", block.alias("block"), (F.pmod(F.xxhash64("class", F.lit(4)), F.col("shares")) == 0).alias("pivot"))
    rows = placed.select("cluster", "class", "root", F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))).alias("block"))
    filled = rows.join(sets, "class").withColumn("side", F.lit(0))
    near = scratch.keep(filled.groupBy("cluster", "block").applyInPandas(_walk_tile(percent), "a long, b long"), "block-links")

    joined = scratch.keep(contract(near, scratch), "block-roots")
    rooted = members.join(joined, members["root"] == joined["node"], "left").select("cluster", "class", F.coalesce(joined["root"], members["root"]).alias("root"))
    rooted = scratch.keep(rooted, "rooted")
    kinds = rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= TILE / 4)
    kinds = scratch.keep(kinds.select("cluster", "root", F.col("root").alias("kind"), F.ceil(F.col("m") / TILE).alias("own_parts")), "kinds")
    kinded = rooted.join(kinds, ["cluster", "root"], "left")
    pool = scratch.keep(kinded.where("kind is null").groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("pool_parts")), "pool")
    every = kinds.select("cluster", "kind", F.col("own_parts").alias("parts")).union(pool.select("cluster", F.lit(None).cast("long"), "pool_parts"))
    every = every.select("cluster", "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    every = scratch.keep(every.withColumn("mark", F.xxhash64("kind", "part")), "parts")
    x, y = every.alias("x"), every.alias("y")
    # a cluster of one block has met itself in the first step and is left out below
    meet = x.join(y, "cluster").where("x.mark <= y.mark and (x.kind is null or y.kind is null or x.kind <> y.kind)")
    tiles = scratch.keep(meet.select("cluster", F.col("x.mark").alias("i"), F.col("y.mark").alias("j")), "tiles")
    single = sized.where("blocks = 1").select("cluster")
    marked = kinded.join(pool, "cluster", "left").join(single, "cluster", "left_anti").select("cluster", "class", "root", F.xxhash64(
        "kind", F.pmod(F.xxhash64("class", F.lit(5)), F.coalesce("own_parts", "pool_parts"))).alias("mark"))

    def walked(some: DataFrame) -> DataFrame:
        sides = some.select("cluster", "i", "j", F.inline(F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("mark"), F.lit(0).alias("side")))).otherwise(
            F.array(F.struct(F.col("i").alias("mark"), F.lit(1).alias("side")), F.struct(F.col("j").alias("mark"), F.lit(2).alias("side"))))))
        far = marked.join(sides, ["cluster", "mark"]).join(sets, "class")
        return far.groupBy("cluster", "i", "j").applyInPandas(_walk_tile(percent), "a long, b long")

    far = _written(map(walked, _rounds(tiles, ["cluster", "i", "j"], tiles.count(), TILES_AT_ONCE)), "tile-links", scratch)
    out = scratch.keep(near.union(far), "links")
    scratch.drop(sets, near, joined, rooted, kinds, pool, every, tiles, far)
    return out


def similar_groups(docs: DataFrame, ident: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5) -> DataFrame:
    """(ident, n_shingles, component_id): one row for each document.

    ``component_id`` is the smallest id that links reach, the document itself included.
    NULL, empty or wordless text: no shingles, linked with nothing. A NULL id is never the
    smallest; a component of NULL ids only has a NULL component. Ids may have any type that
    can be ordered. Rows with one id are looked at one by one and share no link for it. Very
    long texts are read whole, a few texts at a time. Words are lower-cased in A-Z only.
    Other columns are not read. An empty frame stays empty.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    given = docs.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{text}`").cast("string").alias("text"))
    given = given.select("ident", F.xxhash64("ident", "text").alias("key"), "text")  # the key only finds rows again
    keyed = given.select("key", "text")
    run, schema = _signatures(width, given.schema["ident"].dataType.simpleString())
    signed = scratch.keep(given.mapInArrow(run, schema), "signatures")
    classes = scratch.keep(signed.where("n > 0").groupBy("class").agg(
        F.min("key").alias("lead"), F.min("ident").alias("least"), F.first("n").alias("n"), F.first("hashes").alias("hashes")), "classes")

    # what is needed once is not kept beside the sets: sampled shingles here, min-hashes below
    met = signed.select(F.explode("sample").alias("token")).groupBy("token").count()
    met = scratch.keep(met.where(F.col("count") >= ORDER_LEVELS[0][0]), "met")
    levels = [bit_filter(met.where(F.col("count") >= hits), "token", bits) for hits, bits in ORDER_LEVELS]
    held, signed = signed, scratch.keep(signed.select("ident", "class", "n"), "documents")
    scratch.drop(held, met)

    # hubs: classes that share many of their min-hashes with the smallest class of a bucket
    each = classes.select("class", "n", F.posexplode("hashes").alias("k", "low"))
    buckets = scratch.keep(each.groupBy("k", "low").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1").select("k", "low", "hub"), "buckets")
    stars = each.join(buckets, ["k", "low"]).where("class <> hub").groupBy(F.col("hub").alias("a"), F.col("class").alias("b"), "n").agg(F.count(F.lit(1)).alias("shared"))
    stars = stars.where(F.col("shared") >= HUB_SHARED).join(classes.select(F.col("class").alias("a"), F.col("n").alias("m")), "a")
    stars = scratch.keep(stars.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").select("a", "b"), "stars")
    held, classes = classes, scratch.keep(classes.select("class", "lead", "least"), "class-leads")
    scratch.drop(held, buckets)
    near = verified(stars, keyed, classes, percent, width, scratch).select("a", "b")
    joined = scratch.keep(contract(near, scratch), "joined")
    scratch.drop(stars)

    # every pair that may link and is not joined yet, through the prefixes
    run, schema = _prefixes(percent, width, bit_filter(classes, "lead"), levels)
    prefixes = scratch.keep(keyed.mapInArrow(run, schema), "prefixes")
    shared = scratch.keep(prefixes.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token"), "shared")
    run, schema = _matching(bit_filter(shared, "token", roomy_bits(shared.count())))
    posts = prefixes.mapInArrow(run, schema)
    posts = scratch.keep(posts.join(joined, posts["class"] == joined["node"], "left").select(
        "token", "class", "n", "edge", F.coalesce("root", "class").alias("root")), "posts")
    scratch.drop(prefixes, shared)
    roots = scratch.keep(posts.groupBy("token", "root").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "roots")
    spread = scratch.keep(roots.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min("root").alias("hub")).where("k > 1"), "spread")
    few, many = spread.where(f"k <= {MANY}").select("token"), spread.where(f"k > {MANY}").select("token", "hub")
    open_ = scratch.keep(posts.join(few, "token", "left_semi"), "open")
    open_roots = scratch.keep(roots.join(few, "token", "left_semi"), "open-roots")
    # shingles of many groups, which only large families of near copies or short texts have in front
    crowd = scratch.keep(posts.join(many, "token").select("class", "root", "hub").distinct(), "crowd")
    scratch.drop(posts, roots, spread)
    pairs = scratch.keep(_open_pairs(open_, open_roots, percent, scratch), "pairs")
    scratch.drop(open_, open_roots)
    rest = verified(pairs, keyed, classes, percent, width, scratch).select("a", "b")
    scratch.drop(pairs)
    clusters = contract(crowd.select(F.col("root").alias("a"), F.col("hub").alias("b")), scratch)
    clusters = clusters.select(F.col("node").alias("group"), F.col("root").alias("cluster"))
    members = crowd.select("class", F.col("root").alias("group")).distinct().join(clusters, "group")
    members = scratch.keep(members.select("cluster", "class", F.col("group").alias("root")), "members")
    rest = rest.union(_in_tiles(members, keyed, classes, percent, width, scratch))
    groups = scratch.keep(contract(near.union(rest), scratch), "groups")

    rooted = classes.select("class", "least").join(groups, classes["class"] == groups["node"], "left")
    rooted = rooted.select("class", "least", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("smallest"))
    final = scratch.keep(rooted.join(smallest, "root").select("class", "smallest"), "final")
    scratch.drop(joined, crowd, members)
    out = signed.select("ident", "class", "n").join(final, "class", "left")
    return out.select(F.col("ident").alias(ident), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("ident")).alias("component_id"))
