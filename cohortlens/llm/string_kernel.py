"""Language identification with string kernels.

Texts are compared by the blended spectrum kernel on presence: for each n-gram length, shared
distinct n-grams over the geometric mean of both counts, averaged over lengths. Nyström
landmarks stand for the whole kernel, ridge regression separates each language from the
rest, and a batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tables import spare_name

# Slots for the distinct n-grams of 1, 2 and 3 characters.
SLOTS = (1024, 4096, 8192)
STARTS = np.cumsum((0, *SLOTS))
UNKNOWN = "und"
ROWS = 128
CHARS = 1 << 20
_MULTIPLY = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def presence(texts: list[str | None]) -> np.ndarray:
    """One row of slots for each text: which n-grams of the whole lower-cased text occur."""
    out = np.zeros((len(texts), STARTS[-1]), np.float32)
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for cut in range(0, len(text), CHARS):
            codes = np.frombuffer(text[cut:cut + CHARS + len(SLOTS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
            mixed = np.zeros(codes.size, np.uint32)
            for n, slots in enumerate(SLOTS):
                if codes.size <= n:
                    break
                mixed = (mixed[:codes.size - n] ^ codes[n:]) * _MULTIPLY[n]
                mixed ^= mixed >> np.uint32(15)
                out[row, STARTS[n] + (mixed & np.uint32(slots - 1))] = 1
    return out


def normalised(bits: np.ndarray) -> np.ndarray:
    """Rows whose products are kernel values."""
    for a, b in zip(STARTS[:-1], STARTS[1:]):
        bits[:, a:b] /= np.sqrt(np.maximum(bits[:, a:b].sum(1, keepdims=True), 1) * len(SLOTS))
    return bits


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # (slots, landmarks)
    weights: np.ndarray  # (landmarks, languages)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.languages:
            return np.zeros((len(texts), 1), np.float32)
        return np.clip((normalised(presence(texts)) @ self.landmarks @ self.weights + 1) / 2, 0, 1)


def solve(bits: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> Model:
    """Landmarks in turn from each language, then ridge regression in their feature space."""
    names = sorted(set(labels))
    if not names:
        return Model([], np.zeros((STARTS[-1], 0), np.float32), np.zeros((0, 0), np.float32))
    seen: dict[str, int] = {}
    turn = []
    for i, label in enumerate(labels):
        turn.append((seen.get(label, 0), i))
        seen[label] = seen.get(label, 0) + 1
    rows = normalised(bits.astype(np.float32))
    marks = rows[[i for _, i in sorted(turn)[:max(landmarks, len(names))]]]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    features = (rows @ marks.T).astype(np.float64) @ root
    targets = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    fitted = np.linalg.solve(features.T @ features + ridge * np.eye(len(marks)), features.T @ targets)
    return Model(names, np.ascontiguousarray(marks.T), (root @ fitted).astype(np.float32))


def fit(train: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 300,
        landmarks: int = 96, ridge: float = 0.1, seed: int = 10) -> Model:
    """Learns from about ``per_language`` labelled rows of each language, drawn by a hash
    of the id; what reaches the driver is one bit row for each, however long its text."""
    known = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.col(ident).cast("string"), F.lit(seed)), F.lit(1 << 40)).alias("draw"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    if not counts:
        return solve(np.zeros((0, STARTS[-1]), np.float32), [], landmarks, ridge)
    limits = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(int((1 << 40) * min(1.0, 2 * per_language / n))))])
    drawn = known.where(F.col("draw") < F.element_at(limits, F.col("lang")))

    def pack(batches):
        for batch in batches:
            bits = [np.packbits(presence([t]).astype(bool)[0]).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(bits, pa.binary())], names=["lang", "draw", "bits"])

    order = Window.partitionBy("lang").orderBy("draw", F.xxhash64("bits"))
    rows = drawn.mapInArrow(pack, "lang string, draw long, bits binary").withColumn("at", F.row_number().over(order))
    rows = sorted(rows.where(F.col("at") <= per_language).collect(), key=lambda r: (r["lang"], r["at"]))
    bits = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8))[:STARTS[-1]] for r in rows])
    return solve(bits, [r["lang"] for r in rows], landmarks, ridge)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row and column of the frame, with ``lang_pred`` and ``score`` (0 to 1).

    NULL text, text without a letter, or a model that learned no language: ``und``, 0.
    Ties go to the first language by name. Columns with the added names are replaced.
    """
    base = docs.drop("lang_pred", "score")
    flag = spare_name(base, "_letters")
    frame = base.withColumn(flag, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = base.columns

    def run(batches):
        known = shared.value
        for batch in batches:
            texts, letters = batch.column(text), batch.column(flag).to_pylist()
            names, scores = [], []
            for i in range(0, len(letters), ROWS):
                got = known.scores(texts.slice(i, ROWS).to_pylist())
                best = got.argmax(1)
                for k, at in enumerate(best):
                    sure = letters[i + k] and known.languages
                    names.append(known.languages[at] if sure else UNKNOWN)
                    scores.append(float(got[k, at]) if sure else 0.0)
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*columns, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return frame.mapInArrow(run, f"{fields}, lang_pred string, score double")


def fold(ident: Column, parts: int) -> Column:
    return F.crc32(ident.cast("string")) % parts


def identify(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """Learns outside fold 1 of 3 by the id's checksum, predicts every row, adds ``held_out``.

    Rows with a NULL id are neither learned from nor held out.
    """
    model = fit(docs.where(fold(F.col(ident), 3) != 1), ident, text, lang, **options)
    out = predict(docs, model, text)
    return out.withColumn("held_out", F.coalesce(fold(F.col(ident), 3) == 1, F.lit(False)))
