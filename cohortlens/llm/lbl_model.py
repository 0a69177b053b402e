"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

The model predicts a word's class from the classes of the two words before it; a class is
one frequent word, a band of less frequent words, or all the rest. Within a class a word
has its smoothed share of the corpus, so every text has a normalised probability over all
words of the corpus and one unseen word. The number of words with a class of their own
grows with the corpus.

Words, and then runs of three classes, are counted over all training documents. Every run is
dealt to parts and rounds as often as it was counted, a small corpus more than once, by hashes
of the run; the number of parts grows with the corpus. In each round every part takes
noise-contrastive steps from the same parameters, which are then averaged in the order of the
parts, a piece of them at a time. So neither the layout of the documents nor the number
of tasks changes the model.
"""

from __future__ import annotations

import collections
import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import Scratch
from cohortlens.llm.text import mix, utf8

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
HEAD = 100_000  # words whose counts every task holds; the others are joined
# Words with a class of their own: at least, for each cube root of the tokens, and at most.
LEAST_SINGLES, SINGLES_GROW, MOST_SINGLES = 240, 1.5, 2048
# Parts that train at the same time, rounds of them, runs dealt to a part of a round, and how often a small corpus is seen.
PARTS, ROUNDS, DRAWS, EPOCHS = 16, 4, 1 << 18, 2
# A corpus with more runs than these parts and rounds hold is seen once: first with up to MOST_DRAWS runs a part, then in more parts.
MOST_DRAWS = 1 << 20
# Copies of one run beyond which every slot gets its equal share, and copies dealt in one go.
EVEN, DEALT = 1 << 16, 1 << 20
# Pieces of the parameters that are averaged apart, at most.
PIECES = 256
# Distinct runs that a task holds of a batch before it hands their counts on.
MOST_HELD = 1 << 20
# Tokens whose probabilities are worked out in one go, so that their vectors stay in the processor's cache.
SCORED = 1 << 14
SMOOTH = 0.1
WIDTH = 24
NOISE = 32
BATCH = 1024
RATE = 0.1
END, REST = 0, 1  # classes, and places in the list of words


def tokens_of(column: pa.Array):
    """The words of each whole text, A-Z lower-cased, as bytes; NULL reads as empty.

    Bytes split exactly at the blanks that separate words, 0x20 and 0x09 to 0x0D.
    """
    data, offsets = utf8(column)
    raw = data.data
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(raw[a:b]).translate(_LOWER).split()


def word_counts(train: DataFrame, text: str) -> DataFrame:
    """(word, n) over all training rows, summed in the task before the shuffle."""
    def run(batches):
        for batch in batches:
            totals = collections.Counter(itertools.chain.from_iterable(tokens_of(batch.column(0))))
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"])

    return train.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words whose counts are above some level, as many as fit ``most`` whole levels.

    The level comes from how many words have each count, so tasks send what belongs to the
    head and nothing else. Words of one count are all in or all out.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = {r.level: r.words for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()}
    held, least = 0, 1 << 30
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > most:
            break
        least = at
    return counts.where(level >= least)


@dataclass
class Lexicon:
    """Counts of the head words and the classes that all words fall into."""

    counts: dict[bytes, int]
    total: int  # N: all training tokens, ends included
    types: int  # V: distinct ones
    ends: int
    classes: dict[bytes, int] = field(default_factory=dict)
    masses: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # a head word's place in a list of words that starts with the end and the rest; class and count at each place
    places: dict[bytes, int] = field(default_factory=dict)
    class_at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    count_at: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def singles(self) -> int:
        return max(LEAST_SINGLES, min(MOST_SINGLES, int(SINGLES_GROW * self.total ** (1 / 3))))

    def __post_init__(self):
        ranked = sorted(self.counts.items(), key=lambda x: (-x[1], x[0]))
        sizes = [self.ends + SMOOTH, 0.0]
        kinds = [1, 0]
        for place, (word, n) in enumerate(ranked):
            if place < self.singles:
                self.classes[word] = len(sizes)
                sizes.append(n + SMOOTH)
                kinds.append(1)
                continue
            band = self.singles + 2 + int(math.log2(place / self.singles))  # twice as many words in each
            while len(sizes) <= band:
                sizes.append(0.0)
                kinds.append(0)
            self.classes[word] = band
            sizes[band] += n + SMOOTH
            kinds[band] += 1
        seen = sum(self.counts.values())
        sizes[REST] = self.total - self.ends - seen + SMOOTH * (max(self.types - len(self.counts) - 1, 0) + 1)
        self.masses = np.array(sizes)
        self.places = {word: place for place, word in enumerate(self.classes, 2)}
        self.class_at = np.array([END, REST, *self.classes.values()], np.int64)
        self.count_at = np.array([self.ends, 0, *(self.counts[word] for word in self.classes)], np.float64)

    @property
    def size(self) -> int:
        return len(self.masses)

    def shares(self) -> np.ndarray:
        return self.masses / self.masses.sum()

    def places_of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.get, words, itertools.repeat(REST)), np.int64, len(words))


class LogBilinear:
    """score(w | u, v) = (A v + B u) . R[w] + bias[w], u and v the two classes before w."""

    SHAPES = (("left", 2), ("right", 2), ("turn1", 0), ("turn2", 0), ("bias", 1))

    def __init__(self, size: int, shares: np.ndarray, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.size, self.noise = size, shares
        self.left = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.right = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.turn1, self.turn2 = (np.eye(WIDTH, dtype=np.float32) * s for s in (1.0, 0.5))
        self.bias = np.log(shares).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n, _ in self.SHAPES]).astype(np.float64)

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for name, _ in self.SHAPES:
            shape = getattr(self, name).shape
            n = int(np.prod(shape))
            setattr(self, name, flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return self

    def _scatter(self, cells: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(cells.ravel(), rows.ravel(), self.size * WIDTH).reshape(self.size, WIDTH).astype(np.float32)

    def learner(self, seed: int, rate: float = RATE):
        """A function that takes (u, v, w) arrays and makes Adagrad steps on the NCE loss."""
        rng = np.random.default_rng(seed)
        ahead = np.log(NOISE * self.noise).astype(np.float32)
        cumulative = np.cumsum(self.noise)
        cells = np.arange(self.size * WIDTH).reshape(self.size, WIDTH)
        squares = {n: np.full(getattr(self, n).shape, 1.0, np.float32) for n, _ in self.SHAPES}

        def step(name: str, gradient: np.ndarray) -> None:
            squares[name] += gradient * gradient
            getattr(self, name)[...] += rate * gradient / np.sqrt(squares[name])

        def learn(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
            batch = BATCH * max(1, -(-w.size // DRAWS))  # more runs in a step, not more steps
            for a in range(0, w.size, batch):
                uu, vv, ww = u[a:a + batch], v[a:a + batch], w[a:a + batch]
                x = np.minimum(np.searchsorted(cumulative, rng.random(NOISE) * cumulative[-1]), self.size - 1)
                l1, l2, r, rx = self.left[vv], self.left[uu], self.right[ww], self.right[x]
                q = l1 @ self.turn1 + l2 @ self.turn2
                target = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", q, r) + self.bias[ww] - ahead[ww], -30, 30)))
                false = -1 / (1 + np.exp(np.clip(ahead[x] - self.bias[x] - q @ rx.T, -30, 30)))
                dq = target[:, None] * r + false @ rx
                right = self._scatter(cells[ww], target[:, None] * q)
                np.add.at(right, x, false.T @ q)
                bias = np.bincount(ww, target, self.size).astype(np.float32)
                np.add.at(bias, x, false.sum(0))
                left = self._scatter(cells[vv], dq @ self.turn1.T) + self._scatter(cells[uu], dq @ self.turn2.T)
                for name, gradient in (("right", right), ("bias", bias), ("left", left), ("turn1", l1.T @ dq), ("turn2", l2.T @ dq)):
                    step(name, gradient)

        return learn

    def normalise(self) -> None:
        """Log normalisers of all contexts, by one matrix product for each class before."""
        near, far = self.left @ self.turn1, self.left @ self.turn2
        self.near, self.far = near, far
        self.logz = np.empty((self.size, self.size), np.float32)
        for u in range(self.size):
            s = (near + far[u]) @ self.right.T + self.bias
            top = s.max(1, keepdims=True)
            self.logz[u] = np.log(np.exp(s - top).sum(1)) + top[:, 0]

    def log_probabilities(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.empty(w.size, np.float32)
        for a in range(0, w.size, SCORED):
            uu, vv, ww = u[a:a + SCORED], v[a:a + SCORED], w[a:a + SCORED]
            out[a:a + SCORED] = np.einsum("ij,ij->i", self.near[vv] + self.far[uu], self.right[ww]) + self.bias[ww] - self.logz[uu, vv]
        return out


def placed(lexicon: Lexicon, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, at, text): places of all tokens, with two ends before each text and one behind it;
    where the tokens stand in them, ends behind included; and each token's text.

    A word is looked up once; its class and count are then taken by its place.
    """
    lengths = np.array([len(t) + 3 for t in texts])
    padded = np.full(int(lengths.sum()), END, np.int64)
    starts = np.cumsum(lengths) - lengths
    words = lexicon.places_of(list(itertools.chain.from_iterable(texts)))
    inner = np.repeat(starts + 2, lengths - 3) + np.arange(words.size) - np.repeat(np.cumsum(lengths - 3) - (lengths - 3), lengths - 3)
    padded[inner] = words
    at = np.ones(padded.size, bool)
    at[starts], at[starts + 1] = False, False
    return padded, np.flatnonzero(at), np.repeat(np.arange(len(texts)), lengths - 2)


def contexts(lexicon: Lexicon, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, w, text) for every token, ends included; before a text stand two ends."""
    places, at, owner = placed(lexicon, texts)
    classes = lexicon.class_at[places]
    return classes[at - 2], classes[at - 1], classes[at], owner


def _pieces(column: pa.Array, most: int = 1 << 18):
    """Lists of whole texts of about ``most`` words together, and the place of the first."""
    held, words, first = [], 0, 0
    for k, t in enumerate(tokens_of(column)):
        held.append(t)
        words += len(t) + 1
        if words >= most:
            yield first, held
            held, words, first = [], 0, k + 1
    if held:
        yield first, held


def _added(held: np.ndarray, n: np.ndarray, runs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two counts of distinct sorted runs as one."""
    both, counts = np.concatenate([held, runs]), np.concatenate([n, times])
    order = np.argsort(both, kind="stable")
    both, counts = both[order], counts[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(both.size, 1), bool), both[1:] != both[:-1]]))
    return both[first], np.add.reduceat(counts, first) if first.size else counts


def run_counts(docs: DataFrame, lexicon: Lexicon, text: str) -> DataFrame:
    """(run, n): how often three classes follow each other, over all training rows."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        words = shared.value
        for batch in batches:
            held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for _, texts in _pieces(batch.column(0)):
                u, v, w, _ = contexts(words, texts)
                runs, times = np.unique((u * words.size + v) * words.size + w, return_counts=True)
                held, n = _added(held, n, runs, times)
                if held.size >= MOST_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["run", "n"])
                    held, n = held[:0], n[:0]
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["run", "n"])

    return docs.select(text).mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))


def times_seen(total: int) -> float:
    """How often training sees each run: ``EPOCHS`` times in a small corpus, never less than once."""
    return max(1.0, min(EPOCHS, PARTS * ROUNDS * DRAWS / max(total, 1)))


def parts_for(total: int) -> int:
    """Parts of a round, so that each holds about ``MOST_DRAWS`` runs at most."""
    few = max(1, min(PARTS, -(-total // DRAWS)))
    return max(few, -(-total // (ROUNDS * MOST_DRAWS)))


def _drawn(times: float, slots: int):
    """Every run ``times`` its count, dealt to slots by hashes of the run alone.

    A run with very many copies gives each slot as many; only the remainder is dealt.
    """
    def run(batches):
        for batch in batches:
            runs, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            wanted = n * times
            sure = np.floor(wanted)
            k = (sure + (mix(runs.astype(np.uint64)) / 2.0**64 < wanted - sure)).astype(np.int64)
            even = np.where(k > EVEN, k // slots, 0)
            for at in np.flatnonzero(even):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(slots)), pa.array(np.full(slots, runs[at])), pa.array(np.full(slots, even[at]))], names=["slot", "run", "n"])
            k -= even * slots
            group = np.cumsum(k) // DEALT  # whole runs, about DEALT copies together
            for some in np.split(np.arange(k.size), np.flatnonzero(np.diff(group)) + 1):
                own, copies = runs[some], k[some]
                each, turn = np.repeat(own, copies), np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                slot = (mix(each.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + turn.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)
                cells, times_each = np.unique(slot << 36 | each, return_counts=True)  # a run is below 2**36
                yield pa.RecordBatch.from_arrays([pa.array(cells >> 36), pa.array(cells & ((1 << 36) - 1)), pa.array(times_each)], names=["slot", "run", "n"])

    return run, "slot long, run long, n long"


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """A piece of the parameters, averaged over the parts in their order."""
    rows = rows.sort_values("slot")
    total = sum(rows["weight"])
    mean = sum(np.frombuffer(f, np.float32).astype(np.float64) * (w / total) for f, w in zip(rows["flat"], rows["weight"]))
    return pd.DataFrame({"piece": [int(rows["piece"].iloc[0])], "flat": [mean.tobytes()]})


def train(docs: DataFrame, lexicon: Lexicon, text: str, scratch: Scratch) -> LogBilinear:
    """Rounds of steps in all parts from the same parameters, which are then averaged.

    Every run of every training document is learned from, as often as it occurs. A run's
    copies are dealt over all parts and rounds, so no part learns from a corner of the
    corpus; parts grow in number with the corpus, so a group stays small. The parameters of
    the parts meet piece by piece: the driver gets one mean, whatever the number of parts.
    """
    spark, c = docs.sparkSession, lexicon.size
    counted = scratch.keep(run_counts(docs, lexicon, text), "run-counts")
    parts = parts_for(lexicon.total)
    pieces = min(parts, PIECES)
    run, schema = _drawn(times_seen(lexicon.total), parts * ROUNDS)
    drawn = scratch.keep(counted.mapInArrow(run, schema), "drawn-runs")
    model = LogBilinear(c, lexicon.shares())
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def steps(rows: pd.DataFrame) -> pd.DataFrame:
            slot, rows = int(rows["slot"].iloc[0]), rows.sort_values("run")
            runs = np.random.default_rng([6, slot]).permutation(np.repeat(rows["run"].to_numpy(), rows["n"].to_numpy()))
            own = LogBilinear(c, shared.value.noise).load(shared.value.flat())  # noqa: B023
            own.learner(slot, RATE / (1 + slot // parts))(runs // (c * c), runs // c % c, runs % c)
            cut = np.array_split(own.flat().astype(np.float32), pieces)
            return pd.DataFrame({"piece": range(pieces), "slot": slot, "weight": float(runs.size), "flat": [x.tobytes() for x in cut]})

        own = drawn.where(F.expr(f"slot div {parts}") == k)
        met = own.groupBy("slot").applyInPandas(steps, "piece long, slot long, weight double, flat binary")
        got = sorted(met.groupBy("piece").applyInPandas(_mean, "piece long, flat binary").collect())  # one model's size
        if not got:
            break
        model = LogBilinear(c, lexicon.shares()).load(np.concatenate([np.frombuffer(r.flat) for r in got]))
    scratch.drop(counted, drawn)
    model.normalise()
    return model


def fold(ident: Column, parts: int = 10) -> Column:
    return F.crc32(ident.cast("string")) % parts


def score_texts(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Learns from rows whose id's checksum mod 10 is not 0; rows with a NULL id are scored,
    not held out and not learned from. NULL or empty text is the end token alone. Equal
    rows score alike. Without training rows every word is unseen and the score is that of
    the smoothed counts. Scores are log10.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    base = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"), F.coalesce(fold(F.col(ident)) == 0, F.lit(False)).alias("held_out"))
    learn = base.where(fold(F.col("ident")) != 0)
    counts = scratch.keep(word_counts(learn, "text"), "word-counts")
    ends = learn.count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = most_frequent(counts, HEAD).toArrow()
    lexicon = Lexicon(dict(zip((bytes(w) for w in head["word"].to_pylist()), head["n"].to_pylist())), n + ends, v + bool(ends), ends)
    model = train(learn, lexicon, "text", scratch)
    shared = spark.sparkContext.broadcast((lexicon, model))
    logs = math.log10(lexicon.total + SMOOTH * (lexicon.types + 1))
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches):
        lex, lbl = shared.value
        row = TaskContext.get().partitionId() << 33
        inside, single_at = np.log10(lex.masses), np.log10(lex.count_at + SMOOTH)
        for batch in batches:
            for first, texts in _pieces(batch.column(1)):
                places, at, owner = placed(lex, texts)
                classes, place = lex.class_at[places], places[at]
                u, v, w = classes[at - 2], classes[at - 1], classes[at]
                got = np.bincount(owner, lbl.log_probabilities(u, v, w) / math.log(10), len(texts)) if w.size else np.zeros(len(texts))
                # within bands and the rest: log10 of count and mass; the rest's counts are joined later
                rest = place == REST
                single = np.where(rest, 0.0, single_at[place])
                got += np.bincount(owner, single - inside[w], len(texts))
                known = np.bincount(owner, (lex.count_at[place] > 0) & ~rest, len(texts)).astype(np.int64)
                start = np.bincount(owner, single, len(texts))
                words = [x for t in texts for x in (*t, None)]
                some = np.flatnonzero(rest)
                # a text's rare words, each with its number in the text
                times = collections.Counter(zip(owner[some].tolist(), (words[k] for k in some.tolist())))
                ends = np.cumsum(np.bincount(np.array([o for o, _ in times], np.int64), minlength=len(texts)))
                pairs = pa.StructArray.from_arrays([pa.array([x for _, x in times], pa.binary()), pa.array(list(times.values()), pa.int64())], names=["word", "k"])
                rare = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pairs)
                m = len(texts)
                part = batch.slice(first, m)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + m)), part.column(0), part.column(2), pa.array(np.bincount(owner, minlength=m)), pa.array(known),
                    pa.array(start), pa.array(got), rare],
                    names=["row", "ident", "held_out", "n_tokens", "known", "start", "got", "rare"])
                row += m

    schema = f"row long, ident {kind}, held_out boolean, n_tokens long, known long, start double, got double, rare array<struct<word:binary,k:bigint>>"
    scored = scratch.keep(base.select("ident", "text", "held_out").mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.inline("rare"))
    met = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTH))).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more_known"))
    out = scored.select("row", "ident", "held_out", "n_tokens", "known", "start", "got").join(met, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("ident").alias(ident), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"), (F.col("start") + more - F.col("n_tokens") * F.lit(logs)).alias("base_score"),
        (F.col("got") + more).alias("score"))
