"""Quality rules from repetition inside a document, found with a suffix array of its words.

All suffixes of a document's words are sorted by doubling; the longest common prefix of
neighbours gives the maximal repeated runs of words. The union of their spans must not cover
too much of the document, and none may be too long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.text import _SPACE, doc_blocks, rolling, utf8, words

WINDOW = 5
LEAST_WORDS = 10
LEAST_RUN = 8
MOST_COVERED = 0.20
LONGEST_RUN = 50
_LINE = np.zeros(256, bool)
_LINE[10] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def longest_repeats(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each place, the words of its longest run that also begins at another place.

    ``codes`` differ between documents; ``last`` is one past the place's document. Only
    suffixes that are not yet unique are sorted again as the compared length doubles.
    """
    n = codes.size
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, length = [rank.copy()], 1
    sizes = np.bincount(rank, minlength=n)
    active = np.flatnonzero(sizes[rank] > 1)
    while active.size:
        after = active + length
        inside = after < last[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        a, b, who = first[order], second[order], active[order]
        at = np.arange(who.size)
        group = np.concatenate([[True], a[1:] != a[:-1]])
        split = group | np.concatenate([[True], b[1:] != b[:-1]])
        rank[who] = a + np.maximum.accumulate(np.where(split, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        levels.append(rank.copy())
        length *= 2
        sizes = np.bincount(rank[active], minlength=n)
        active = active[sizes[rank[active]] > 1]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    x, y = suffixes[:-1], suffixes[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        p, q = x + common, y + common
        fits = (p < last[x]) & (q < last[y])
        same = np.zeros(common.size, bool)
        same[fits] = levels[level][p[fits]] == levels[level][q[fits]]
        common[same] += 1 << level
    best = np.zeros(n, np.int64)
    np.maximum.at(best, x, common)
    np.maximum.at(best, y, common)
    return best


def _union(n: int, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n places the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(met more than once by this owner, met before by this owner) for each hash."""
    order = np.lexsort((np.arange(hashes.size), hashes, owner))
    o, h = owner[order], hashes[order]
    same = (o[1:] == o[:-1]) & (h[1:] == h[:-1])
    again = np.zeros(hashes.size, bool)
    any_ = np.zeros(hashes.size, bool)
    again[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, again


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts, covered share and longest repeat of every whole text; NULL reads as empty."""
    n = len(column)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")}
    out["covered"] = np.zeros(n)
    data, offsets = utf8(column)
    for i, j in doc_blocks(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        bounds = offsets[i:j + 1] - a
        raw = data[a:b]

        def per_text(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags)])
            return sums[bounds[1:]] - sums[bounds[:-1]]

        hashes, _, _, first = words(data, offsets, i, j, cased=True)
        count = np.diff(first)
        out["n_words"][i:j] = count
        out["word_chars"][i:j] = per_text(~_SPACE[raw] & ((raw & 0xC0) != 0x80))
        out["n_symbols"][i:j] = per_text(_SYMBOL[raw])
        lines, begins, ends, of = words(data, offsets, i, j, _LINE, cased=True)
        ink = np.concatenate([[0], np.cumsum(~_SPACE[raw])])
        owner = np.repeat(np.arange(j - i), np.diff(of))
        inked = ink[ends - a] > ink[begins - a]
        again = _repeated(owner[inked], lines[inked])[1]
        out["n_dup_lines"][i:j] = np.bincount(owner[inked][again], minlength=j - i)
        if not hashes.size:
            continue
        owner = np.repeat(np.arange(j - i), count)
        last = np.repeat(first[1:], count)
        runs = rolling(hashes, WINDOW)
        whole = np.flatnonzero(np.arange(runs.size) + WINDOW <= last[:runs.size])
        twice = whole[_repeated(owner[whole], runs[whole])[0]]
        out["n_repeat_words"][i:j] = np.bincount(owner[_union(hashes.size, twice, np.full(twice.size, WINDOW))], minlength=j - i)
        order = np.lexsort((hashes, owner))
        new = np.concatenate([[True], (owner[order][1:] != owner[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])])
        codes = np.empty(hashes.size, np.int64)
        codes[order] = np.cumsum(new)
        best = longest_repeats(codes, last)
        np.maximum.at(out["longest_repeat"], owner + i, best)
        long_ = np.flatnonzero(best >= LEAST_RUN)
        covered = np.bincount(owner[_union(hashes.size, long_, best[long_])], minlength=j - i)
        out["covered"][i:j] = covered / np.maximum(count, 1)
    return out


def judge(docs: DataFrame, ident: str = "doc_id", text: str = "text", most_covered: float = MOST_COVERED, longest: int = LONGEST_RUN) -> DataFrame:
    """(ident, counts, ``covered``, ``longest_repeat``, ``base_failed``, ``kept``) for each row.

    Repeats of ``LEAST_RUN`` words or more count towards ``covered``; a row is kept when the
    base rules pass, at most ``most_covered`` of its words lie in repeats and none is
    longer than ``longest`` words. Words keep their case. NULL, empty or wordless text has
    no words and fails the base rules; equal rows are judged alike; NULL ids stay NULL.
    Rows are judged where they lie, without a shuffle.
    """
    def run(batches):
        for batch in batches:
            m = measures(batch.column(1))
            failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
            kept = ~failed & (m["covered"] <= most_covered) & (m["longest_repeat"] <= longest)
            counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(m[c]) for c in counts), pa.array(m["covered"]), pa.array(m["longest_repeat"]), pa.array(failed), pa.array(kept)],
                names=[ident, *counts, "covered", "longest_repeat", "base_failed", "kept"])

    kind = docs.schema[ident].dataType.simpleString()
    return docs.select(ident, text).mapInArrow(
        run, f"`{ident}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "covered double, longest_repeat long, base_failed boolean, kept boolean")
