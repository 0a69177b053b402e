"""Benchmark decontamination: near copies of benchmark items inside documents.

A part of a document leaks an item when their edit distance is at most ``rate`` of the
item's length. Items and documents are compared in their plain form, and all places are
places of that form, so signs between words change nothing.

A window begins at each word of a text. A CGK random walk reads it: at every step a coin that
depends on the step and the character read decides whether the walk goes on to the next
character, so two windows an edit apart soon read the same characters at the same steps again,
and edits become a few unlike steps. Samples of some steps of several independent walks are
looked up among the samples of the items, which are embedded from each of their words: one
word from which any sample survives finds the item. Items of fewer than ``STARTS`` words, where
that would miss too many, are looked up by pieces as well, which misses none: ``d`` edits
spoil at most ``d`` pieces of ``q`` characters, so of ``n`` at least ``n - d`` stand unchanged,
each within ``d`` characters of its place.

Where pieces of ``FINE`` characters, of which many must survive, agree in a candidate, it is
verified by the exact edit distance of the item to its best part of the window.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

RATE = 0.15
PIECE, FINE = 5, 4
LINE = 4  # shorter pieces are taken where fewer would have to meet
BLOCK = 1 << 20  # characters of whole texts looked up at once
SHIFTS = 4096  # a window with more possible places is verified at once
WALKS, STEPS = 3, 36  # independent walks, steps of each
SAMPLES, SAMPLED = 2, 17  # samples of a walk, steps in each
STARTS = 28  # items with fewer words are looked up by pieces as well; a test measures the recall of the others
WINDOWS = 1 << 14  # windows walked at once
MOST_ITEMS_BYTES = 16 << 20
BREAK = 0xD800  # stands between texts; no text holds it
_SIGN = np.array([not chr(c).isalnum() for c in range(128)])
_STEP, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_RANDOM = np.random.default_rng(77)
_COINS = _RANDOM.integers(0, 2, (WALKS, STEPS, 256))
_SAMPLED = [[frozenset(_RANDOM.choice(STEPS, SAMPLED, replace=False).tolist()) for _ in range(SAMPLES)] for _ in range(WALKS)]


def plain(text: str | None) -> str:
    """Lower case, every run of ASCII signs and blanks one space."""
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", (text or "").lower()).strip()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """The hash of the q characters from each place on."""
    out = np.zeros(max(chars.size - q + 1, 0), np.uint64)
    for k in range(q):
        out *= _STEP
        out += chars[k:k + out.size]
    out ^= out >> np.uint64(29)
    out *= _STIR
    return out


def word_starts(chars: np.ndarray) -> np.ndarray:
    """Places after a blank; in scripts that may do without blanks every letter is one."""
    first = np.concatenate([[True], chars[:-1] == 32])[:chars.size]
    return np.flatnonzero((first | (chars >= 0x0E00)) & (chars != 32) & (chars != BREAK))


def symbols(chars: np.ndarray) -> np.ndarray:
    return ((chars ^ (chars >> np.uint32(8))) & np.uint32(255)).astype(np.int64)


def walk(read: np.ndarray, starts: np.ndarray, number: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(hash of each sample, place after the last step) of one walk from every start over ``symbols``;
    behind the end the last one is read again."""
    place, seen, step = starts.copy(), np.empty_like(starts), np.empty_like(starts)
    keys = [np.zeros(starts.size, np.uint64) for _ in range(SAMPLES)]
    for k in range(STEPS):
        np.take(read, place, out=seen, mode="clip")
        for key, sampled in zip(keys, _SAMPLED[number]):
            if k in sampled:
                key *= _STEP
                key += seen.view(np.uint64)
        np.take(_COINS[number, k], seen, out=step, mode="clip")
        place += step
    for key in keys:
        key ^= key >> np.uint64(29)
        key *= _STIR
    return keys, place


def edit_distance_within(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the part of ``text`` nearest to ``pattern``, by bit-parallel columns."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, at = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        ph, mh = (down | ~(x | up)) & full, up & x
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        y = eq | down
        up, down = (mh | ~(y | ph)) & full, ph & y
        if score < best:
            best, at = score, j
    return best, at


@dataclass
class Table:
    """Hashes in order, how many are equal from here on, item and place in it of each."""

    hashes: np.ndarray
    runs: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Table:
        hashes, item, place = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        return cls(hashes, np.searchsorted(hashes, hashes, "right") - np.arange(hashes.size), item[order], place[order])

    @cached_property
    def known(self) -> tuple[np.ndarray, np.uint64]:
        """(which leading bits are met, shift that leaves them); sparse, yet small enough for a cache."""
        width = min(22, max(12, self.hashes.size.bit_length() + 5))
        bits, shift = np.zeros(1 << width, bool), np.uint64(64 - width)
        bits[self.hashes >> shift] = True
        return bits, shift

    def meet(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``own``, slot) of all equal hashes."""
        bits, shift = self.known
        at = np.flatnonzero(bits.take((own >> shift).view(np.int64)))
        slot = np.minimum(np.searchsorted(self.hashes, own[at]), self.hashes.size - 1)
        same = self.hashes[slot] == own[at]
        at, slot = at[same], slot[same]
        count = self.runs[slot]
        return np.repeat(at, count), np.repeat(slot, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


@dataclass
class Items:
    ids: list
    texts: list[str]  # an item too short for any edit is asked for as whole words
    edits: np.ndarray
    sizes: np.ndarray
    need: np.ndarray  # pieces that must meet in line
    pieces: dict[int, Table]  # by the characters of a piece; of short items
    walked: list[Table]  # samples of walks from each word
    fine: list[np.ndarray]  # short hashes of pieces of FINE characters

    @classmethod
    def of(cls, named: list[tuple[int, str]], rate: float, every: bool = False) -> Items:
        named = [(i, p) for i, t in sorted(named, key=lambda x: (x[0] is None, x[0])) if i is not None and (p := plain(t))]
        edits = np.array([int(rate * len(p)) for _, p in named], np.int64)
        texts = [p if d else f" {p} " for (_, p), d in zip(named, edits.tolist())]
        found: dict[int, list] = {}
        need, fine, samples = [], [], [[] for _ in range(WALKS * SAMPLES)]
        for k, (text, d) in enumerate(zip(texts, edits.tolist())):
            m, chars = len(text), codes(text)
            most = max(1, min(PIECE, m // (d + 1)))
            q = next((q for q in range(most, max(most - 2, FINE - 1), -1) if m // q - d >= LINE), most)
            h = grams(chars, q)[:m // q * q:q]
            need.append(max(1, h.size - d))
            starts = word_starts(chars)
            if every or starts.size < STARTS:
                found.setdefault(q, []).append((h, np.full(h.size, k), np.arange(h.size) * q))
            read = symbols(chars)
            for w in range(WALKS):
                keys, end = walk(read, starts, w)
                inside = end < m  # a walk beyond the item would read what follows it in a text
                for own, key in zip(samples[w * SAMPLES:], keys):
                    own.append((key[inside], np.full(inside.sum(), k), starts[inside]))
            fine.append(grams(chars, FINE)[:m // FINE * FINE:FINE].astype(np.uint16))
        return cls([i for i, _ in named], texts, edits, np.array([len(t) for t in texts], np.int64), np.array(need, np.int64),
                   {q: Table.of(parts) for q, parts in found.items()}, [Table.of(parts) for parts in samples if parts], fine)

    def _merged(self, low: np.ndarray, high: np.ndarray, breaks: np.ndarray, apart: int) -> np.ndarray:
        """(text, item, first and last place where the item could begin) of overlapping ranges of
        keys, which hold item and place and come in order of ``low``."""
        k = low >> 40
        d = self.edits[k]
        top = np.maximum.accumulate(high)
        first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (low[1:] > top[:-1] + 1)]))
        last = np.append(first[1:], k.size) - 1
        k, d = k[first], d[first]
        low, high = low[first] - (k << 40), top[last] - (k << 40)
        text = np.searchsorted(breaks + (np.arange(breaks.size) + 1) * apart, low + d)
        return np.stack([text, k, low - (text + 1) * apart, high - (text + 1) * apart], 1)

    def windows(self, chars: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """(text, item, first and last place where the item could begin), by item and place."""
        # texts are so far apart that no two of them meet
        apart = int(2 * (self.sizes + self.edits).max(initial=0)) + 1

        def lines(pos, table, slot):
            return (table.item[slot] << 40) + pos + (np.searchsorted(breaks, pos) + 1) * apart - table.place[slot]

        found, read, starts, keys = [np.zeros((0, 4), np.int64)], symbols(chars), word_starts(chars), []
        for at in range(0, starts.size if self.walked else 0, WINDOWS):
            for w in range(WALKS):
                samples, _ = walk(read, starts[at:at + WINDOWS], w)
                for table, own in zip(self.walked[w * SAMPLES:], samples):
                    if table.hashes.size:
                        hit, slot = table.meet(own)
                        keys.append(lines(starts[at + hit], table, slot))
        if keys and (key := np.unique(np.concatenate(keys))).size:
            d = self.edits[key >> 40]
            found.append(self._merged(key - d, key + d, breaks, apart))
        for q, table in self.pieces.items():
            if not table.hashes.size:
                continue
            pos, slot = table.meet(grams(chars, q))
            key = np.sort(lines(pos, table, slot))
            k = key >> 40
            far = np.arange(key.size) + self.need[k] - 1
            meet = np.flatnonzero(far < key.size)
            meet = meet[key[far[meet]] - key[meet] <= 2 * self.edits[k[meet]]]
            if meet.size:
                d = self.edits[k[meet]]
                found.append(self._merged(key[far[meet]] - d, key[meet] + d, breaks, apart))
        return np.concatenate(found)


def _blocks_of(texts: list[str]):
    at = used = 0
    for k, t in enumerate(texts):
        used += len(t)
        if used > BLOCK or k == len(texts) - 1:
            yield at, texts[at:k + 1]
            at, used = k + 1, 0


def leaks_in(items: Items, column: pa.Array) -> list[tuple[int, int, int, int]]:
    """(row, item number, distance, byte of the lower-case text where the part begins) of every leak in the column."""
    out = []
    for row, texts in _blocks_of([(t or "").lower() for t in column.to_pylist()]):
        raw = codes("".join(f" {t} {chr(BREAK)}" for t in texts))
        begins = np.cumsum([0] + [len(t) + 3 for t in texts])
        sign = _SIGN[np.minimum(raw, 127)] & (raw < 128)
        origin = np.flatnonzero(~sign | np.concatenate([[True], ~sign[:-1]]))
        chars = np.where(sign[origin], np.uint32(32), raw[origin])
        breaks = np.flatnonzero(chars == BREAK)
        short = grams(chars, FINE).astype(np.uint16)
        for text, k, low, high in items.windows(chars, breaks).tolist():
            begin, end = (int(breaks[text - 1]) + 1 if text else 0), int(breaks[text])
            d, m, fine = int(items.edits[k]), int(items.sizes[k]), items.fine[k]
            if fine.size > d and high - low + 2 * d < SHIFTS:
                a, b = low - d, high + d + m
                if a >= 0 and b <= short.size:
                    shifted = np.ndarray((fine.size, high - low + 2 * d + 1), short.dtype, short, a * short.itemsize, (FINE * short.itemsize, short.itemsize))
                    if np.count_nonzero((shifted == fine[:, None]).any(1)) < fine.size - d:
                        continue
            a = max(begin, low)
            part = chars[a:min(end, high + m + d)].tobytes().decode("utf-32-le")
            distance, stop = edit_distance_within(items.texts[k], part)
            if distance <= d:
                back, length = edit_distance_within(items.texts[k][::-1], part[:stop][::-1])
                where = int(origin[a + stop - length] - begins[text]) - 1
                out.append((row + text, k, distance, len(texts[text][:max(0, where)].encode())))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str):
    """The benchmark in blocks of at most ``MOST_ITEMS_BYTES`` of text, a block in the driver at a time."""
    block, used = [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        block.append((row[0], row[1]))
        used += len((row[1] or "").encode())
        if used > MOST_ITEMS_BYTES:
            yield block
            block, used = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
               rate: float = RATE, every: bool = False) -> DataFrame:
    """(ident, item_id, distance, start): the best place of each item in each leaking row.

    Texts are compared in lower case with every run of signs and blanks as one space. Of items of
    ``STARTS`` words or more, 99.5 % of the leaks are found where ``rate`` of the characters are
    edited at random places, and more the fewer there are; leaks of shorter items, or with
    ``every`` of all items, are all found. An item of so few characters that ``rate`` allows no
    edit must stand as whole words.
    The benchmark is a stated query set; it is broadcast in blocks of bounded size and
    documents are read where they lie, once a block, without a shuffle. NULL or
    wordless texts and items match nothing; NULL item ids are left out; NULL document ids
    come back as NULL; ids of both tables may have any type. Equal rows each report. Very long
    texts are read whole, in blocks of characters. Either table may be empty.
    """
    spark = docs.sparkSession
    schema = f"`{ident}` {docs.schema[ident].dataType.simpleString()}, item_id {benchmark.schema[item].dataType.simpleString()}, distance int, start long"
    names, item_kind = [ident, "item_id", "distance", "start"], to_arrow_type(benchmark.schema[item].dataType)
    out = None
    for block in _blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(Items.of(block, rate, every))

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                ids = batch.column(0)
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for row, k, distance, start in leaks_in(items, batch.column(1)):
                    best[row, k] = min((distance, start), best.get((row, k), (distance, start)))
                rows = sorted(best)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([r for r, _ in rows], pa.int64())), pa.array([items.ids[k] for _, k in rows], item_kind),
                    pa.array([best[x][0] for x in rows], pa.int32()), pa.array([best[x][1] for x in rows], pa.int64())], names=names)

        found = docs.select(ident, text).mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                 rate: float = RATE, every: bool = False) -> DataFrame:
    """The rows, with all their columns, in which ``find_leaks`` finds no item; read in place, never shuffled."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at, out = docs.columns.index(text), docs
    for block in _blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items.of(block, rate, every))

        def run(batches, shared=shared):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in leaks_in(shared.value, batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, schema)
    return out
