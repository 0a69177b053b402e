"""Alignment of two tokenisations of the same text.

Both tokenisers run over the whole text. Where tokens of both end at the same byte and the
next token of both begins with a space, the text is cut: these anchors split a document
into windows of token ids, mostly a word each. How the tokens of a window lie over each
other depends on the ids alone, so each window is aligned once and remembered by its ids.

How many documents link a pair of ids is counted over the whole corpus. Tasks hold the
counts of the most frequent pairs, in a table of fixed size; pairs beyond it are joined.
"""

from __future__ import annotations

import array
import functools
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.simhash_trie import text_slices
from cohortlens.llm.tables import Scratch
from cohortlens.llm.text import mix

TOKENIZERS = "/opt/tokenizers"
# Pair counts that every task holds, and windows that it remembers.
HEAD, WINDOWS = 1 << 20, 1 << 19
# Second ids below this; a pair is first id * PAIR + second id.
PAIR = 1 << 24
# Text aligned at once.
SLICE_BYTES = 1 << 20
_K = np.uint64(0x9E3779B97F4A7C15)
# Word pattern of the byte-level vocabulary: a fixed value of its public format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for
    themselves, the others follow from 256 on in their order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Side:
    """A tokeniser's bytes by id, their lengths, and which ids begin with a space."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.spaced = np.array([p[:1] == b" " for p in pieces])


class Pair:
    """Both tokenisers of a task. Special tokens inside a text are plain text.

    The byte-level vocabulary file numbers its words in the order of their merges, so its
    ids are ranks and the quicker of the public encoders can use them.
    """

    def __init__(self, folder: str, first: str, second: str):
        path = os.path.join(folder, first)
        with open(path, encoding="utf-8") as f:
            words: dict[str, int] = json.load(f)["model"]["vocab"]
        letters = byte_letters()
        pieces = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            if all(c in letters for c in word):
                pieces[i] = bytes(letters[c] for c in word)
        ranks = {p: i for i, p in enumerate(pieces) if p}
        self.first_model = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second_model = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, second))
        own = [self.second_model.id_to_piece(i) for i in range(self.second_model.get_piece_size())]
        self.first = Side(pieces)
        self.second = Side([bytes([int(p[3:5], 16)]) if self.second_model.is_byte(i) else b"" if self.second_model.is_control(i) else p.replace("▁", " ").encode()
                            for i, p in enumerate(own)])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where the bytes of either differ from space and text."""
        whole = b" " + text.encode()
        a, b = self.first_model.encode_ordinary(" " + text), self.second_model.encode(text)
        for ids, side in ((a, self.first), (b, self.second)):
            if b"".join(map(side.pieces.__getitem__, ids)) != whole:
                return None
        return np.array(a, np.int32), np.array(b, np.int32)


@functools.cache
def tokeniser_pair(folder: str, first: str, second: str) -> Pair:
    return Pair(folder, first, second)


def _ids_as_text(n: int, between: str, last: str) -> np.ndarray:
    return np.array([[f"{i}{end}" for i in range(n)] for end in (between, last)], dtype=object)


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each run of the given size."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(upto[-1]) + np.repeat(first - upto[:-1], sizes)


class Windows:
    """Alignments by window ids: links as pairs, groups as text. Forgets all when full."""

    def __init__(self, pair: Pair, most: int = WINDOWS):
        self.pair, self.most = pair, most
        # an id as text with what follows it: inside a group, and at the end of its side
        self.text = _ids_as_text(pair.first.sizes.size, ",", "|"), _ids_as_text(pair.second.sizes.size, ",", ";")
        self.forget()

    def forget(self) -> None:
        self.known: dict[tuple[bytes, bytes], int] = {}
        self.groups: list[str] = []
        self.counts, self.links, self.ends = array.array("q"), array.array("q"), array.array("q", [0])

    def _align(self, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> None:
        """Aligns new windows, which stand in line with so many tokens each."""
        ends_a, ends_b = np.cumsum(self.pair.first.sizes[a]), np.cumsum(self.pair.second.sizes[b])
        last_a, last_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        cuts, shared = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        # a link ends at each end of either side, a group at each end of both
        links = a[np.searchsorted(ends_a, cuts)].astype(np.int64) * PAIR + b[np.searchsorted(ends_b, cuts)]
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        tokens = np.empty(a.size + b.size, dtype=object)
        through_a = np.searchsorted(group_a, np.arange(shared.size), "right")
        before_b = np.searchsorted(group_b, np.arange(shared.size))
        tokens[np.arange(a.size) + before_b[group_a]] = self.text[0][(ends_a == shared[group_a]).astype(int), a]
        tokens[np.arange(b.size) + through_a[group_b]] = self.text[1][(ends_b == shared[group_b]).astype(int), b]
        tokens, at = tokens.tolist(), np.concatenate([[0], last_a + last_b]).tolist()
        self.groups += ["".join(tokens[i:j])[:-1] for i, j in zip(at, at[1:])]
        done = ends_a[last_a - 1]
        upto = np.searchsorted(cuts, done) + 1
        self.ends.frombytes((self.ends[-1] + upto).astype(np.int64).tobytes())
        self.counts.frombytes(np.diff(np.searchsorted(shared, done) + 1, prepend=0).astype(np.int64).tobytes())
        self.links.frombytes(links.tobytes())

    def number(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """The alignment of each window between the cuts; equal windows are looked up once."""
        if len(self.known) > self.most or len(self.links) > 16 * self.most:
            self.forget()
        place_a, place_b = (np.arange(x.size) - np.repeat(cut[:-1], np.diff(cut)) for x, cut in ((a, cut_a), (b, cut_b)))
        sums = [np.add.reduceat(mix(x.astype(np.uint64) * _K + mix(place.astype(np.uint64))), cut[:-1]) for x, place, cut in ((a, place_a, cut_a), (b, place_b, cut_b))]
        _, first, same = np.unique(mix(sums[0] + mix(sums[1])), return_index=True, return_inverse=True)
        # windows of one hash are compared id by id with the first of them
        odd = np.zeros(same.size, bool)
        for x, place, cut in ((a, place_a, cut_a), (b, place_b, cut_b)):
            sizes, model = np.diff(cut), first[same]
            odd |= sizes != sizes[model]
            at = np.minimum(np.repeat(cut[model], sizes) + place, x.size - 1)
            odd |= np.add.reduceat((x[at] != x).astype(np.int64), cut[:-1]) > 0
        if odd.any():
            same[odd] = first.size + np.arange(int(odd.sum()))
            first = np.concatenate([first, np.flatnonzero(odd)])
        bytes_a, bytes_b, known = a.tobytes(), b.tobytes(), self.known
        places = zip(*((4 * x).tolist() for x in (cut_a[first], cut_a[first + 1], cut_b[first], cut_b[first + 1])))
        ids = [(bytes_a[i:k], bytes_b[j:m]) for i, k, j, m in places]
        used, held = np.array([known.setdefault(x, len(known)) for x in ids]), len(self.groups)
        numbers, place = np.unique(used, return_index=True)
        fresh = first[place[numbers >= held]]
        if fresh.size:
            of_a, of_b = (cut[fresh + 1] - cut[fresh] for cut in (cut_a, cut_b))
            self._align(a[_spread(cut_a[fresh], of_a)], b[_spread(cut_b[fresh], of_b)], of_a, of_b)
        return used[same]

    def align(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, np.ndarray, str]]:
        """(groups, links in order, digest of the groups) of each document's ids.

        Documents stand in line: each begins with a space, so its begin is an anchor as well.
        """
        if not texts:
            return []
        a, b = (np.concatenate(x) for x in zip(*texts))
        ends_a, ends_b = np.cumsum(self.pair.first.sizes[a]), np.cumsum(self.pair.second.sizes[b])
        # anchors: shared ends before tokens of both that begin with a space, and the end
        spaced_a, spaced_b = (np.append(side.spaced[x[1:]], True) for side, x in ((self.pair.first, a), (self.pair.second, b)))
        anchors = np.intersect1d(ends_a[spaced_a], ends_b[spaced_b], assume_unique=True)
        cut_a, cut_b = (np.concatenate([[0], np.searchsorted(ends, anchors) + 1]) for ends in (ends_a, ends_b))
        used = self.number(a, b, cut_a, cut_b)
        ends, counts = np.frombuffer(self.ends, np.int64), np.frombuffer(self.counts, np.int64)
        sizes = ends[used + 1] - ends[used]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        links = np.frombuffer(self.links, np.int64)[_spread(ends[used], sizes)]
        of_text = np.searchsorted(cut_a, np.cumsum([0, *(x.size for x, _ in texts)])).tolist()
        grouped, names = np.concatenate([[0], np.cumsum(counts[used])]), used.tolist()
        return [(int(grouped[j] - grouped[i]), links[upto[i]:upto[j]], hashlib.sha256(";".join([self.groups[u] for u in names[i:j]]).encode()).hexdigest())
                for i, j in zip(of_text, of_text[1:])]


def _aligned(names: list[str], files: tuple[str, str, str]):
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]

    def run(batches):
        pair = tokeniser_pair(*files)
        windows = Windows(pair)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                ids = [pair.encode(t) if t else None for t in part.column("text").to_pylist()]
                done, rows = iter(windows.align([x for x in ids if x is not None])), []
                for x in ids:
                    if x is None:
                        rows.append((0, 0, 0, 0, "", None, None))
                        continue
                    groups, links, digest = next(done)
                    own, times = np.unique(links, return_counts=True)
                    rows.append((x[0].size, x[1].size, groups, links.size, digest, own.tobytes(), times.astype(np.int32).tobytes()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                                                 names=[*names, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return run


def _document_counts(batches):
    """(pair, docs) of each batch: in how many of its documents a pair is linked."""
    for batch in batches:
        column = batch.column("pairs").drop_null()
        for k in range(0, len(column), 1000):
            flat = np.frombuffer(b"".join(column.slice(k, 1000).to_pylist()), np.int64)
            pairs, docs = np.unique(flat, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], names=["pair", "docs"])


def _looked_up(names: list[str], shared):
    """Sums over the links whose pair the task knows; the other pairs as a list."""
    rest = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def run(batches):
        pairs, docs, highest = shared.value
        for batch in batches:
            found = []
            for own, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                if own is None:
                    found.append((0, 0, []))
                    continue
                own, times = np.frombuffer(own, np.int64), np.frombuffer(times, np.int32).astype(np.int64)
                at = np.minimum(np.searchsorted(pairs, own), max(pairs.size - 1, 0))
                here = pairs[at] == own if pairs.size else np.zeros(own.size, bool)
                count = docs[at[here]] if pairs.size else np.zeros(0, np.int64)
                best = count == highest[own[here] // PAIR]
                found.append((int(times[here][best].sum()), int((times[here] * count).sum()),
                              [{"pair": p, "times": t} for p, t in zip(own[~here].tolist(), times[~here].tolist())]))
            kinds = [pa.int64(), pa.int64(), rest]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 3, kinds))],
                                             names=[*names, "n_best", "count_sum", "rest"])

    return run


def align(docs: DataFrame, ident: str = "doc_id", text: str = "text", folder: str = TOKENIZERS,
          first: str = "byte_bpe_50k.json", second: str = "piece_bpe_32k.model", head: int = HEAD) -> DataFrame:
    """(ident, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row for each document.

    The first tokeniser reads a space and the text, the second the text, to which it adds the
    space. A NULL or empty text, or one that the tokens of either do not spell byte for byte,
    has no tokens: zeros and an empty digest. Ties for an id's highest count all count.
    Repeated rows are documents of their own; ids may be NULL, repeated or of any type.
    Very long texts are tokenised whole. Other columns are not read. An empty frame stays
    empty. ``folder`` must hold the tokeniser files on every machine.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(F.col(f"`{ident}`").alias("ident"), F.monotonically_increasing_id().alias("place"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = keyed.schema["ident"].dataType.simpleString()
    measures = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    aligned = scratch.keep(keyed.mapInArrow(_aligned(["ident", "place"], (folder, first, second)), f"ident {kind}, place long, {measures}, pairs binary, times binary"), "aligned")
    counts = aligned.select("pairs").mapInArrow(_document_counts, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = scratch.keep(counts, "pair-counts")
    highest = counts.groupBy(F.expr(f"pair div {PAIR}").cast("int").alias("a")).agg(F.max("docs").alias("top")).toArrow()  # one row an id of the vocabulary
    tops = np.zeros(max(highest["a"].to_numpy(), default=-1) + 2, np.int64)
    tops[highest["a"].to_numpy()] = highest["top"].to_numpy()
    # the least count with which a pair is among the head: its pairs fit however large the corpus
    sizes = sorted(((r.bits, r.n) for r in counts.groupBy(F.floor(F.log2("docs") * 8).cast("int").alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    held, least = 0, None
    for bits, n in sizes:
        held += n
        if held > head:
            break
        least = bits
    level = F.floor(F.log2("docs") * 8).cast("int")
    known = counts.where(level >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    order = np.argsort(known["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast((known["pair"].to_numpy()[order], known["docs"].to_numpy()[order], tops))
    names = ["ident", "place", *(c.split()[0] for c in measures.split(", "))]
    looked = aligned.mapInArrow(_looked_up(names, shared), f"ident {kind}, place long, {measures}, n_best long, count_sum long, rest array<struct<pair:long,times:long>>")
    if least is not None and held <= head:
        return looked.select(F.col("ident").alias(ident), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    looked = scratch.keep(looked, "looked-up")
    rare = counts if least is None else counts.where(level < least)
    best = docs.sparkSession.createDataFrame([(int(a), int(t)) for a, t in enumerate(tops) if t], "a int, top long")  # bounded by the vocabulary
    rare = rare.join(F.broadcast(best), F.expr(f"pair div {PAIR}").cast("int") == best["a"]).select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))
    more = looked.select("place", F.inline("rest")).join(rare, "pair").groupBy("place").agg(
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    out = looked.join(more, "place", "left")
    scratch.drop(aligned)
    return out.select(F.col("ident").alias(ident), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
