"""Secret scans: fixed patterns, and Markov models of random strings against ordinary ones.

Two character models of order 2 are trained from labelled samples: values that the patterns
find, with seeded random strings of the usual alphabets, against the other words of the same
documents. A run of token characters is a secret when the log-likelihood ratio of the
models is clearly on the random side; it adds to what the patterns find.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns and least lengths, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 12, "access": 18}
HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SAMPLE_DOCS = 2000
LEAST_RATIO = 0.75  # nats a character by which the random model must win
_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
# Words of which labelled ordinary identifiers are made.
_PARTS = ("account access action active address admin array async base batch block buffer build button byte cache call change "
          "channel check class client close code column command commit config connection content context control count create "
          "current data database date debug default delete device document domain download dynamic edit element email enable "
          "encode entry error event example export factory feature field file filter first flag folder format from function "
          "generate get global group handle handler hash header height hidden host identifier image import index info init "
          "input insert instance integer internal is item iterator key label last layout length level library limit line link "
          "list load local lock log login manager map max member memory message meta method min mode model module name network "
          "next node notification number object offset open option order output owner package page parameter parent parse "
          "password path pattern payment permission pixel platform point policy position prefix private process product "
          "profile project property protocol provider public query queue random range read record refresh region release "
          "remote remove render report request reset resource response result return role root row rule run sample save schema "
          "scope script search section select sequence server service session set setting shared size sort source stack start "
          "state static status step stop storage store stream string style submit success suffix switch symbol sync system "
          "table tag target task template test text thread time title token total track transaction transform tree type unit "
          "update upload url user util validate value variable version view visible width window worker write year zone").split()
_SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_EDGE = len(_SYMBOLS)
_CODE = {c: i for i, c in enumerate(_SYMBOLS)}
_OTHER = len(_SYMBOLS) + 1  # letters beyond ASCII and signs inside ordinary words
_N = len(_SYMBOLS) + 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the fixed patterns find, in code points."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # a run of 16 or more found at its leftmost place is the whole run
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _codes(word: str) -> list[int]:
    return [_CODE.get(c, _OTHER) for c in word]


@dataclass
class Markov:
    """Order-2 transitions with back-off to order 1 by additive smoothing."""

    logp: np.ndarray  # (before, before, next)

    @classmethod
    def train(cls, words: list[str]) -> Markov:
        pairs = np.zeros((_N, _N))
        triples = np.zeros((_N, _N, _N))
        for word in words:
            c = [_EDGE, _EDGE, *_codes(word), _EDGE]
            np.add.at(triples, (c[:-2], c[1:-1], c[2:]), 1)
            np.add.at(pairs, (c[1:-1], c[2:]), 1)
        first = (pairs + 0.2) / (pairs + 0.2).sum(1, keepdims=True)
        weight = 20.0
        second = (triples + weight * first[None]) / (triples.sum(2, keepdims=True) + weight)
        return cls(np.log(second))

    def score(self, word: str) -> float:
        c = [_EDGE, _EDGE, *_codes(word), _EDGE]
        return float(self.logp[c[:-2], c[1:-1], c[2:]].sum())


@dataclass
class Models:
    random: Markov
    ordinary: Markov

    def ratio(self, word: str) -> float:
        """Nats a character in favour of a random string."""
        return (self.random.score(word) - self.ordinary.score(word)) / (len(word) + 1)

    def is_secret(self, word: str) -> bool:
        kinds = any(c.isdigit() for c in word) + any(c.isupper() for c in word[1:]) + any(c.islower() for c in word)
        return kinds >= 2 and self.ratio(word) >= LEAST_RATIO


def random_strings(n: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(_ALPHABETS[k % len(_ALPHABETS)]), rng.integers(16, 65))) for k in range(n)]


def ordinary_identifiers(n: int, seed: int) -> list[str]:
    """Names as programs have them: several words, joined in the usual ways, some numbered."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        parts = [_PARTS[i] for i in rng.integers(0, len(_PARTS), rng.integers(2, 6))]
        if rng.random() < 0.25:
            parts.append(str(rng.integers(0, 3000)))
        style = k % 5
        out.append((parts[0] + "".join(w.title() for w in parts[1:])) if style == 0 else "".join(w.title() for w in parts) if style == 1
                   else "_".join(parts) if style == 2 else "-".join(parts) if style == 3 else "_".join(parts).upper())
    return out


def labelled(texts: list[str]) -> tuple[list[str], list[str]]:
    """(secret values, ordinary words) of some texts."""
    secret, ordinary = [], []
    for text in texts:
        spans = base_spans(text)
        secret += [text[a:b] for a, b, kind in spans if kind != "assign"]
        at = 0
        for a, b, _ in [*spans, (len(text), len(text), "")]:
            ordinary += re.findall(r"[^\x20\x09-\x0D]+", text[at:a]) if a > at else []
            at = max(at, b)
    return secret, ordinary


def fit(docs: DataFrame, ident: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS, seed: int = 3) -> Models:
    """Trains both models on about ``sample`` documents drawn by a hash of their id.

    Counts are taken in the tasks; strings of one document enter at most 500 times."""
    total = docs.select(ident).count()
    share = min(1.0, sample / max(total, 1))
    drawn = docs.where(F.pmod(F.xxhash64(F.col(ident).cast("string"), F.lit(seed)), F.lit(1 << 40)) < int(share * (1 << 40))).select(text)

    def collect(batches):
        for batch in batches:
            rows = [labelled([t or ""]) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0][:500] for x in rows], pa.list_(pa.string())),
                                              pa.array([x[1][::max(1, len(x[1]) // 500)] for x in rows], pa.list_(pa.string()))], names=["secret", "ordinary"])

    secret, ordinary = [], []
    for row in drawn.mapInArrow(collect, "secret array<string>, ordinary array<string>").toLocalIterator():
        secret += [w[:200] for w in row["secret"]]
        ordinary += [w[:200] for w in row["ordinary"]]
    return Models(Markov.train(sorted(secret) + random_strings(2000, seed)), Markov.train(sorted(ordinary) + ordinary_identifiers(8000, seed)))


def spans_of(text: str, models: Models) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans); a run that touches a base span adds nothing."""
    base = base_spans(text)
    more = []
    for m in CANDIDATE.finditer(text):
        if not any(m.start() < b and a < m.end() for a, b, _ in base) and models.is_secret(m[0]):
            more.append((m.start(), m.end(), "markov"))
    return base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, models: Models, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, n_assign, n_access, n_hex, n_markov, base_sha256, spans) for each row.

    NULL or empty text has no spans; the digest is then that of the empty string. Equal rows
    answer alike, NULL ids stay NULL. Whole texts are read where they lie.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            rows = [spans_of(t or "", shared.value) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(x[2] == kind for x in every) for _, every in rows], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([joined(every) for _, every in rows], pa.string())],
                                             names=[ident, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema[ident].dataType.simpleString()
    return docs.select(ident, text).mapInArrow(run, f"`{ident}` {kind}, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
