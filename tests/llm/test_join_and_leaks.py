import collections
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import decontaminate, prefix_tree_join
from cohortlens.llm.tables import FILTER_BITS, MOST_FILTER_BITS, Scratch, bit_filter, components, has_bit, roomy_bits
from cohortlens.llm.text import rolling, shingle_sets
from cases import EDGES, LOWER, words


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    return set() if not w else {tuple(w)} if len(w) < width else {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}


def groups_by_force(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    least = list(range(len(rows)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i in range(len(rows)):
        for j, both in collections.Counter(j for g in sets[i] for j in where[g] if j < i).items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    ids = collections.defaultdict(list)
    for i in range(len(rows)):
        ids[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(ids[find(i)])) for i in range(len(rows))]


def edited(text, rng, share):
    out = []
    for w in text.split(" "):
        x = rng.random()
        if x < share / 3:
            out.append(rng.choice(["new", "other", "word", "here"]))
        elif x < 2 * share / 3:
            out.extend([w, "added"])
        elif x >= share:
            out.append(w)
    return " ".join(out)


def test_groups_on_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, prefix_tree_join.similar_groups(docs).collect()))
    assert got == sorted(groups_by_force([tuple(r) for r in docs.collect()]))


@pytest.mark.parametrize("many, tile", [(prefix_tree_join.MANY, prefix_tree_join.TILE), (1, 5)])
def test_groups_at_the_border_of_the_bound(spark, monkeypatch, many, tile):
    """Chains of edits, shared passages and short texts, many pairs close to 0.8; counted
    pair by pair, and all in tiles."""
    monkeypatch.setattr(prefix_tree_join, "MANY", many)
    monkeypatch.setattr(prefix_tree_join, "TILE", tile)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for _ in range(12):
        text = " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 8, 40, 90])))
        if rng.random() < 0.5:
            text += " " + passage
        for _ in range(9):
            rows.append((len(rows), text))
            text = edited(text, rng, rng.choice([0.01, 0.02, 0.04, 0.08]))
    rng.shuffle(rows)
    got = sorted(map(tuple, prefix_tree_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(groups_by_force(rows))


def test_trie_finds_what_pairwise_comparison_finds():
    rng = np.random.default_rng(1)
    sets = [(k, np.unique(rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64))) for k in range(120)]
    trie = prefix_tree_join.Trie.of(sets)
    for _, probe in sets[:60]:
        expect = {(k, s.size, np.intersect1d(s, probe).size) for k, s in sets if 100 * np.intersect1d(s, probe).size >= 80 * np.union1d(s, probe).size}
        assert set(trie.search(probe, 80)) == expect


def test_ids_of_any_type(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([("b", text), ("a", text), (None, text), ("c", None), (None, "alone")], "doc_id string, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in prefix_tree_join.similar_groups(docs).collect())
    assert got == {("a", 6, "a"): 1, ("b", 6, "a"): 1, (None, 6, "a"): 1, ("c", 0, "c"): 1, (None, 1, None): 1}
    bench = spark.createDataFrame([("x", text)], "item_id string, text string")
    found = decontaminate.find_leaks(docs, bench)
    assert found.schema["item_id"].dataType.simpleString() == "string"
    assert collections.Counter((r.doc_id, r.item_id) for r in found.collect()) == {("a", "x"): 1, ("b", "x"): 1, (None, "x"): 1}


def test_joins_are_a_spanning_forest():
    """A dense family leaves one link fewer than it has sets; what is joined already adds none."""
    rng = np.random.default_rng(8)
    core = rng.integers(0, 1 << 62, 100, dtype=np.uint64)
    family = [(k, np.sort(np.concatenate([core[rng.permutation(100)[:95]], rng.integers(0, 1 << 62, 5, dtype=np.uint64)]))) for k in range(60)]
    far = [(100 + k, np.sort(rng.integers(0, 1 << 62, 50, dtype=np.uint64))) for k in range(20)]
    sets = family + far
    links = prefix_tree_join._joins(sets, sets, {k: k for k, _ in sets}, 80)
    assert len(links) == 59 and {x for link in links for x in link} == {k for k, _ in family}
    assert prefix_tree_join._joins(sets, sets, {k: 0 if k < 60 else k for k, _ in sets}, 80) == []


def test_join_edges(edges, nothing):
    rows = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in prefix_tree_join.similar_groups(edges).collect())
    assert sum(rows.values()) == len(EDGES)
    assert rows[2, 0, 2] == rows[3, 0, 3] == rows[4, 0, 4] == 1  # no words, no links
    assert rows[5, 1, 5] == rows[6, 1, 5] == 1  # short texts are one shingle
    assert rows[7, 1, 7] == 2  # repeated rows
    assert rows[None, 4, 1] == 1 and rows[1, 4, 1] == 1  # a NULL id is never the smallest
    assert prefix_tree_join.similar_groups(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (149, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 150)}, 200: 100}


def test_word_hashes_do_not_depend_on_where_a_text_lies():
    texts = ["The quick brown fox jumps over", None, "", "the QUICK brown fox jumps over", EDGES[9][1], "fox"]
    together = list(shingle_sets(pa.array(texts)))
    alone = [next(shingle_sets(pa.array([t], pa.string()))) for t in texts]
    assert all((a == b).all() for a, b in zip(together, alone))
    assert (together[0] == together[3]).all() and together[1].size == 0 and together[4].size == len(shingles(EDGES[9][1]))
    assert rolling(np.arange(3, dtype=np.uint64), 5).size == 0


def force_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (a != b)))
        row = now
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(200):
        p, t = ("".join(rng.choice("ab c") for _ in range(rng.randint(lo, 25))) for lo in (1, 0))
        assert decontaminate.edit_distance_within(p, t)[0] == force_distance(p, t)


def test_recall_and_precision_on_planted_passages(spark, sf):
    """Items with up to 15 % of their words changed are found; other texts are left alone."""
    rng = random.Random(9)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    filler = [" ".join(f"pad{rng.randint(0, 5000)}" for _ in range(80)) for _ in range(60)]
    rows, planted = [], set()
    for k, text in enumerate(filler * 4):
        if k % 2:
            item, passage = rng.choice(items)
            for i in rng.sample(range(len(passage.split())), int(rng.choice([0, 0.05, 0.1]) * len(passage.split()))):
                w = passage.split()
                w[i] = w[i][::-1]
                passage = " ".join(w)
            cut = rng.randint(0, len(text))
            text = text[:cut] + " " + passage.upper() + " " + text[cut:]
            planted.add((k, item))
        rows.append((k, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert len(found & planted) >= 0.97 * len(planted)
    assert {d for d, _ in found} <= {d for d, _ in planted}
    kept = {r.doc_id for r in decontaminate.drop_leaking(docs, bench).collect()}
    assert kept == {k for k, _ in rows} - {d for d, _ in found}


def test_walks_read_what_the_coins_say():
    text = "the walk of 日本 reads é letters, one after another; x"
    chars = decontaminate.codes(text)
    starts = decontaminate.word_starts(chars)
    assert starts.tolist() == [k for k, c in enumerate(text) if c != " " and (k == 0 or text[k - 1] == " " or ord(c) >= 0x0E00)]
    read = decontaminate.symbols(chars)
    for w in range(decontaminate.WALKS):
        keys, ends = decontaminate.walk(read, starts, w)
        seen = []
        for start, end in zip(starts.tolist(), ends.tolist()):
            place, steps = start, []
            for k in range(decontaminate.STEPS):
                steps.append(int(read[min(place, read.size - 1)]))
                place += int(decontaminate._COINS[w, k, steps[-1]])
            assert place == end
            seen.append(steps)
        for key, sampled in zip(keys, decontaminate._SAMPLED[w]):
            parts = [tuple(steps[k] for k in sorted(sampled)) for steps in seen]
            assert len(set(parts)) == len(set(key.tolist())) == len(set(zip(parts, key.tolist())))
    assert decontaminate.word_starts(decontaminate.codes("")).size == 0


def test_an_edit_leaves_most_of_a_walk():
    """From a word on, a walk over a copy with an edit soon reads the same steps again."""
    rng = np.random.default_rng(3)
    same = 0
    for _ in range(300):
        s = rng.choice(list(b"etaoinshrdlu"), 60).astype(np.uint32)
        t = np.delete(s, 1) if rng.random() < 0.5 else np.insert(s, 1, ord("z"))
        at = np.zeros(1, np.int64)
        ends = [decontaminate.walk(decontaminate.symbols(x), at, int(w))[1][0] for w in [rng.integers(decontaminate.WALKS)] for x in (s, t)]
        same += ends[1] - ends[0] == t.size - s.size  # at the same place of the unchanged rest
    assert same > 150


@pytest.mark.parametrize("rate, least", [(0.05, 1.0), (0.1, 0.999), (0.15, 0.99)])
def test_recall_of_walks_by_rate_of_edits(rate, least):
    """Items of STARTS words and more, characters edited at random places; pieces play no part."""
    rng = random.Random(15)
    letters = "etaoinshrdlucmf"
    words_ = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(2000)]
    items = [(k, " ".join(rng.choices(words_, k=rng.randint(decontaminate.STARTS, 60)))) for k in range(100)]
    texts, expect = [], set()
    for k, item in items * 6:
        passage = list(item)
        for at in sorted(rng.sample(range(len(passage)), int(rate * len(item))), reverse=True):
            passage[at:at + 1] = rng.choice([[], [rng.choice(letters)], [passage[at], rng.choice(letters)]])
        around = " ".join(rng.choices(words_, k=30))
        texts.append(f"{around} {''.join(passage)} {around}")
        if decontaminate.edit_distance_within(item, decontaminate.plain(texts[-1]))[0] <= int(decontaminate.RATE * len(item)):
            expect.add((len(texts) - 1, k))
    known = decontaminate.Items.of(items, decontaminate.RATE)
    assert not known.pieces and len(expect) > 500
    found = {(row, k) for row, k, *_ in decontaminate.leaks_in(known, pa.array(texts))}
    assert found <= expect and len(found) >= least * len(expect)
    every = decontaminate.Items.of(items, decontaminate.RATE, every=True)
    assert {(row, k) for row, k, *_ in decontaminate.leaks_in(every, pa.array(texts))} == expect


def test_typing_errors_spread_over_all_words_are_found():
    """Up to RATE of the characters edited at random places: what the distance allows is found, nothing else."""
    rng = random.Random(12)
    letters = "etaoinshrdlucmf"
    items = [(k, " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))) for k, n in enumerate([3, 7, 9, 16, 25, 41] * 5)]
    texts, expect = [], set()
    for row in range(240):
        k, item = rng.choice(items)
        passage = list(item)
        for _ in range(int(rng.choice([0.05, 0.1, 0.15, 0.2]) * len(item))):
            at = rng.randrange(len(passage))
            passage[at:at + 1] = rng.choice([[], [rng.choice(letters)], [passage[at], rng.choice(letters)]])
        before, after = (" ".join("".join(rng.choices(letters, k=5)) for _ in range(20)) for _ in "ab")
        texts.append(f"{before} {''.join(passage)} {after}")
        if force_distance(item, decontaminate.plain(texts[-1])) <= decontaminate.RATE * len(item):
            expect.add((row, k))
    assert len(expect) > 120
    found = decontaminate.leaks_in(decontaminate.Items.of(items, decontaminate.RATE), pa.array(texts))
    assert expect == {(row, k) for row, k, *_ in found}
    for row, k, distance, start in found:
        part = decontaminate.plain(texts[row].encode()[start:].decode())
        assert decontaminate.edit_distance_within(items[k][1], part[:len(items[k][1]) + distance])[0] == distance


@pytest.mark.parametrize("between", ["### ", "\n      * ", " - - - - - - ", "\t" * 40])
def test_signs_between_words_change_nothing(spark, between):
    item = "erble shathe ingtion reed ndorea onenble stesthre adhand lyonre heedth"
    texts = [f"Some words before. É {between.join(item.split())}{between}and after", f"{between}{between.join(item.split())}", between.join(item.split()[:5])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.distance, texts[r.doc_id].encode()[r.start:].decode().split(between)[0]) for r in got} == {(0, 0, "erble"), (1, 0, "erble")}


def test_leak_edges(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (None, "one"), (4, "tie tie tie tie tie tie tie tie tie tie tie tie")],
                                  "item_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.find_leaks(edges, bench).collect())
    assert got == {(1, 1): 1, (None, 1): 1, (7, 4): 2}
    assert decontaminate.drop_leaking(edges, bench).count() == len(EDGES) - 4
    assert decontaminate.find_leaks(nothing, bench).count() == decontaminate.find_leaks(edges, bench.where("false")).count() == 0
    assert decontaminate.drop_leaking(edges, bench.where("false")).count() == len(EDGES)


@pytest.mark.parametrize("n, m", [(5, 5), (10, 8), (100, 81), (516, 500)])
def test_prefixes_of_linking_sets_meet(n, m):
    need = prefix_tree_join.needed_overlap(n, m, 80)
    assert 100 * need >= 80 * (n + m - need) and 100 * (need - 1) < 80 * (n + m - need + 1)
    # at most n - need of the first set are missing from the second, so one of so many is shared
    assert n - need < prefix_tree_join.prefix_length(n, 80)


def test_min_hashes_and_samples_are_gone_before_sets_are_written(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 2 for _ in range(40)) for _ in range(12)]
    docs = spark.createDataFrame([(i, t + " end" * (i % 2)) for i, t in enumerate(t for t in texts for _ in range(2))], "doc_id long, text string")
    there, beside = {}, []
    keep, drop = Scratch.keep, Scratch.drop

    def noted(self, frame, label):
        if label == "sets":
            beside.append(sorted(c for columns in there.values() for c in columns))
        out = keep(self, frame, label)
        there[id(out)] = frame.columns
        return out

    def dropped(self, *frames):
        for frame in frames:
            there.pop(id(frame), None)
        drop(self, *frames)

    monkeypatch.setattr(Scratch, "keep", noted)
    monkeypatch.setattr(Scratch, "drop", dropped)
    got = {r.doc_id: r.component_id for r in prefix_tree_join.similar_groups(docs).collect()}
    assert got == {i: i - i % 2 for i in range(24)}
    assert beside and not any({"hashes", "sample"} & set(columns) for columns in beside)


def test_sets_are_shuffled_for_a_few_pairs_and_tiles_at_a_time(spark, monkeypatch):
    """The groups are those of a search in one piece, whatever is shuffled at the same time."""
    for name, value in (("MANY", 3), ("TILE", 4), ("PAIRS_AT_ONCE", 5), ("TILES_AT_ONCE", 2)):
        monkeypatch.setattr(prefix_tree_join, name, value)
    written, keep = collections.Counter(), Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, frame, label: (written.update([label]), keep(self, frame, label))[1])
    rng, rows = random.Random(7), []
    for family in range(6):
        first = [f"w{family}x{i}" for i in range(60)]
        for _ in range(10):
            text = list(first)
            for _ in range(rng.choice([1, 2, 3])):
                text[rng.randrange(60)] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(text)))
    got = sorted(map(tuple, prefix_tree_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(groups_by_force(rows))
    assert written["verified"] > 3 and written["tile-links"] > 2


def test_lines_of_many_texts_are_compared_last(spark, monkeypatch):
    """No texts meet in tiles for a line that a tenth of their words is."""
    monkeypatch.setattr(prefix_tree_join, "MANY", 8)
    members, keep = [], Scratch.keep

    def noted(self, frame, label):
        out = keep(self, frame, label)
        if label == "members":
            members.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", noted)
    rows = []
    for line in range(40):
        for k in range(70):
            own = [f"o{line}x{k}x{i}" for i in range(12)]
            rows.append((len(rows), " ".join([*own[:6], *(f"l{line}x{i}" for i in range(6)), *own[6:]])))
    got = prefix_tree_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("component_id <> doc_id").isEmpty() and got.count() == len(rows)
    assert members == [0]


def test_prefixes_take_shingles_of_few_texts_first(spark):
    text = pa.array([" ".join(f"w{i}" for i in range(104))])
    (tokens,) = shingle_sets(text)
    often = tokens[::2]
    filters = [bit_filter(spark.createDataFrame([(int(t),) for t in some.view(np.int64)], "token long"), "token") for some in (often, often[::2])]
    run, _ = prefix_tree_join._prefixes(40, 5, np.full(1 << 10, 255, np.uint8), filters)
    (got,) = run([pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), text], names=["key", "text"])])
    prefix = got.column("prefix")[0].as_py()
    level = prefix_tree_join.frequency_level(np.array(prefix, np.int64).view(np.uint64), filters)
    assert len(prefix) == 61 and list(level) == [0] * 50 + [1] * 11
    assert got.column("edge")[0].as_py() >> 60 == 1


def test_a_filter_of_many_values_has_room():
    assert [roomy_bits(n) for n in (0, 1, 1 << 22, (1 << 22) + 1, 1 << 24, 1 << 30)] == [FILTER_BITS, FILTER_BITS, FILTER_BITS, 1 << 26, MOST_FILTER_BITS, MOST_FILTER_BITS]
    assert has_bit(np.full(MOST_FILTER_BITS // 8, 255, np.uint8), np.array([0, 1 << 63, (1 << 64) - 1], np.uint64)).all()


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    def files():
        there = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {there.apply(k).name() for k in range(there.size()) if there.apply(k).isShuffle()}

    before, scratch = files(), Scratch(spark)
    flag = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(flag)
    held = scratch.keep(spark.range(10_000).groupBy("id").count(), "counted")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert held.count() == 10_000 and spark.conf.get(flag) == was
