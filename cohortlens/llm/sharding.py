"""Reproducible shuffle into shards: a Feistel permutation over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import Scratch, number_rows, spare_name

ROUNDS = 6


def _scramble(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    """A keyed 64-bit mixer cut to half the width of the domain."""
    x = half + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(mask)


class Permutation:
    """A keyed one-to-one map of 0..n-1 onto itself, computed for any number alone.

    A balanced Feistel network permutes the smallest power of four that holds n; values
    that fall outside walk on along their cycle until they are below n again.
    """

    def __init__(self, n: int, seed: int):
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.keys = [int(k) for k in np.random.default_rng(seed).integers(1, 1 << 62, ROUNDS)]

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        h, mask = np.uint64(self.half), (1 << self.half) - 1
        left, right = x >> h, x & np.uint64(mask)
        if back:
            for k in reversed(self.keys):
                left, right = right ^ _scramble(left, k, mask), left
        else:
            for k in self.keys:
                left, right = right, left ^ _scramble(right, k, mask)
        return (left << h) | right

    def __call__(self, numbers: np.ndarray, back: bool = False) -> np.ndarray:
        out = np.asarray(numbers).astype(np.uint64)
        todo = np.arange(out.size)
        while todo.size:
            out[todo] = self._once(out[todo], back)
            todo = todo[out[todo] >= np.uint64(self.n)]
        return out.astype(np.int64)


def permuted(number: Column, n: int, seed: int) -> Column:
    permutation = Permutation(n, seed)

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation(numbers.to_numpy()))

    return place(number)


def _numbered(base: DataFrame, keys: list[Column], scratch: Scratch) -> tuple[DataFrame, int]:
    """The frame with ``row_number``, and the row count.

    Only keys and two hashes of each row are sorted and written. Whole rows meet their numbers
    in one shuffle, equal ones as one row that is repeated for each of its numbers, which
    follow each other. Both hashes and the order are of all columns, NULLs and signed zeros told apart.
    """
    own = [F.col(f"`{c}`") for c in base.columns]
    told = [x for c in own for x in (c.isNull(), c.cast("string"))]
    one, two, row = (spare_name(base, x) for x in ("_one", "_two", "_row"))
    hashes = [F.xxhash64(*own).alias(one), F.xxhash64(F.lit(1), *told).alias(two)]
    sort = [f"_key_{k}" for k in range(len(keys))]
    narrow = base.select(*[k.alias(name) for k, name in zip(keys, sort)], *hashes)
    numbered, n = number_rows(narrow, [*[F.col(k) for k in sort], F.col(one)], scratch)
    spans = numbered.groupBy(one, two).agg(F.min("row_number").alias("_from"), F.max("row_number").alias("_upto"))
    whole = base.select(*hashes, F.struct(*own).alias(row)).groupBy(one, two).agg(F.first(row).alias(row))
    lost = F.raise_error(F.lit("the frame gave other rows when it was read again")).cast("long")
    places = F.sequence(F.coalesce("_from", lost), F.coalesce("_upto", lost))
    return whole.join(spans, [one, two], "left").select(F.col(f"{row}.*"), F.explode(places).alias("row_number")), n


def shard_rows(frame: DataFrame, keys: list[Column], shards: int, seed: int) -> DataFrame:
    """All rows and columns, plus ``row_number``, ``shard`` and ``slot``.

    Row r in key order goes to place p = permutation(r), shard p mod ``shards``, slot
    p div ``shards``: shard sizes differ by one at most, slots have no gaps, and shard and
    slot of a row number (or the row number of a place, walking back) need no lookup.
    Columns of the frame with these names are replaced. NULL keys sort first; equal rows
    share out their places; an empty frame stays empty. The frame is read twice and must
    give the same rows each time.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    scratch = Scratch(frame.sparkSession)
    base = frame.drop("row_number", "shard", "slot")
    numbered, n = _numbered(base, keys, scratch)
    place = spare_name(numbered, "_place")
    placed = numbered.withColumn(place, permuted(F.col("row_number"), max(n, 1), seed))
    return placed.withColumns({
        "shard": F.pmod(place, F.lit(shards)).cast("int"),
        "slot": F.expr(f"`{place}` div {shards}"),
    }).drop(place)
