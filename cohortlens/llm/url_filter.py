"""URL filters: rules by host and path, then naive Bayes over segmented host and path words.

Host names run words together. A unigram model learned from the pages splits each label
into its most probable words (Viterbi). Rules decide first, the longest that fits; other
urls go to a multinomial naive Bayes classifier over the words of host and path. Its
samples are the urls themselves. At first those are bad whose host holds a word of a short
list that leaves no doubt; a url that the classifier then calls bad with ``CONFIDENT`` odds
is a bad sample in the next of ``ROUNDS`` rounds, so that hosts without any listed word are
known by the words they share with listed ones, and in turn make others known.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.page_diff import host_and_path
from cohortlens.llm.tables import Scratch, spare_name

# Words that label a host as bad. Others are learned.
BAD_WORDS = {"adserver", "ads", "bets", "betting", "casino", "cialis", "clickbait", "escort", "gambling", "jackpot", "lottery", "malware",
             "payday", "phishing", "pills", "poker", "porn", "roulette", "slots", "spam", "torrents", "viagra", "warez", "xxx"}
# Further words that name sites, so that they are known to the splitter.
SITE_WORDS = {"bargain", "best", "bet", "blog", "bonus", "cheap", "click", "crack", "deal", "deals", "discount", "download", "farm", "fast", "forum",
              "free", "game", "games", "health", "home", "loan", "loans", "mail", "market", "mega", "money", "movies", "music", "news", "online",
              "pharmacy", "play", "portal", "prize", "quick", "replica", "rx", "shop", "store", "super", "top", "track", "tracker", "travel",
              "web", "wiki", "win", "winner", "world"}
# Host labels that say nothing about the site.
PLAIN_LABELS = {"www", "m", "com", "net", "org", "co", "info", "edu", "gov"}
VOCABULARY = 50_000  # words that the splitter knows
HEAD = 50_000  # words whose weights every task holds; the others are joined
LONGEST_WORD = 24
ROUNDS = 2  # of counting; the first knows only listed hosts
CONFIDENT = math.log(9)
KNOWN_COUNT = 1_000


@dataclass(frozen=True)
class Rule:
    text: str  # host/path, like ``net/``
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, NULL where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


class Splitter:
    """Most probable split of a run of letters into words, by a unigram model.

    An unknown run of n letters has probability 10 / (words * 10^n), as of one seen once
    and ever less so with its length.
    """

    def __init__(self, counts: dict[str, int]):
        self.counts = dict(counts)
        for word in BAD_WORDS | SITE_WORDS:
            self.counts[word] = max(self.counts.get(word, 0), KNOWN_COUNT)
        self.total = math.log(sum(self.counts.values()) or 1)
        self._seen: dict[str, list[str]] = {}

    def _cost(self, word: str) -> float:
        n = self.counts.get(word)
        return self.total - math.log(n) if n else self.total - math.log(10) + len(word) * math.log(10)

    def __call__(self, run: str) -> list[str]:
        if run in self._seen:
            return self._seen[run]
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            cost, start = min((best[s] + self._cost(run[s:end]), s) for s in range(max(0, end - LONGEST_WORD), end))
            best.append(cost)
            back.append(start)
        out, end = [], len(run)
        while end:
            out.append(run[back[end]:end])
            end = back[end]
        if len(self._seen) < 100_000:
            self._seen[run] = out[::-1]
        return out[::-1]


def features(host: str, path: str, split: Splitter) -> tuple[list[str], bool]:
    """(words, whether the host's words are on the list); digits of a path count as one word."""
    inside = [w for label in host.split(":")[0].split(".")[:-1] if label not in PLAIN_LABELS for run in re.findall(r"[a-z]+", label) for w in split(run)]
    below = [w if w.isalpha() else "0" for w in re.findall(r"[a-z]+|[0-9]+", path.lower())]
    return [f"h:{w}" for w in inside] + [f"p:{w}" for w in below], bool(BAD_WORDS.intersection(inside))


@dataclass
class Bayes:
    """Multinomial naive Bayes with add-one smoothing over all words seen in training."""

    words: dict[str, tuple[int, int]]  # good, bad; of the most frequent words
    urls: tuple[int, int]
    size: int  # distinct words
    seen: tuple[int, int]  # all words

    def __post_init__(self):
        self.totals = [n + self.size + 1 for n in self.seen]
        self.prior = math.log((self.urls[1] + 1) / (self.urls[0] + 1))
        self.weight = {w: math.log((b + 1) / self.totals[1]) - math.log((g + 1) / self.totals[0]) for w, (g, b) in self.words.items()}

    def score(self, words: list[str]) -> tuple[float, list[str]]:
        """Log odds that the url is bad by the words held here, and the other words."""
        return self.prior + sum(self.weight.get(w, 0.0) for w in words), [w for w in words if w not in self.weight]

    def weigh(self, good: Column, bad: Column) -> Column:
        return F.log((bad + 1) / F.lit(float(self.totals[1]))) - F.log((good + 1) / F.lit(float(self.totals[0])))


def most_frequent(counts: DataFrame, order: str, limit: int) -> list:
    """The rows of a written table with the ``limit`` highest numbers; of those that tie for the
    last places, the first words. The cut-off comes from how often each number occurs, so the
    driver receives no more rows than it keeps, and as many numbers as differ."""
    left, cut = limit, None
    for row in counts.groupBy(order).count().orderBy(F.desc(order)).toLocalIterator():
        if row["count"] > left:
            cut = row[order]
            break
        left -= row["count"]
    if cut is None:
        return counts.collect()
    tied = counts.where(F.col(order) == cut).orderBy("word").limit(left).collect() if left else []
    return counts.where(F.col(order) > cut).collect() + tied


def _odds(base: DataFrame, splitter: Splitter, bayes: Bayes, counts: DataFrame) -> DataFrame:
    """``base``, which has ``host`` and ``path``, with ``bad_odds``, NULL where the host is empty."""
    shared = base.sparkSession.sparkContext.broadcast((splitter, bayes))

    @F.pandas_udf("odds double, rare array<string>")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        split, model = shared.value
        return pd.DataFrame([model.score(features(h, p, split)[0]) for h, p in zip(hosts, paths)], columns=["odds", "rare"])

    found = spare_name(base, "_found")
    scored = base.withColumn(found, F.when(F.col("host") != "", judge("host", "path"))).withColumn("bad_odds", F.col(f"{found}.odds"))
    if bayes.size > len(bayes.words):  # urls with rarer words; no such word is met more often than the HEAD
        rare = F.coalesce(F.size(f"{found}.rare"), F.lit(0)) > 0
        h, p, more = (spare_name(scored, c) for c in ("_host", "_path", "_more"))
        urls = scored.where(rare).select(F.col("host").alias(h), F.col("path").alias(p), F.col(f"{found}.rare").alias("_rare")).dropDuplicates([h, p])
        weights = counts.select("word", bayes.weigh(F.col("good"), F.col("bad")).alias("_weight"))
        added = urls.select(h, p, F.explode("_rare").alias("word")).join(weights, "word").groupBy(h, p).agg(F.sum("_weight").alias(more))
        columns = scored.columns
        met = scored.where(rare).join(added, (F.col("host") == F.col(h)) & (F.col("path") == F.col(p)), "left")
        met = met.withColumn("bad_odds", F.col("bad_odds") + F.coalesce(more, F.lit(0.0))).select(*[f"`{c}`" for c in columns])
        scored = scored.where(~rare).unionByName(met)
    return scored.drop(found)


def learn(pages: DataFrame, url: str, html: str, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> tuple[Splitter, Bayes, DataFrame]:
    """Word counts over all pages, of which the ``vocabulary`` most frequent split hosts, then
    word counts by label over all urls, in rounds: a table of all, of which ``HEAD`` reach the driver."""
    scratch = Scratch(pages.sparkSession)
    visible = F.regexp_replace(F.lower(F.col(html)), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&[#a-z0-9]+;", " ")
    seen = pages.select(F.explode(F.regexp_extract_all(visible, F.lit(r"[a-z]{2,24}"), 0)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    repeated = scratch.keep(seen.where("n > 1"), "page-words")
    splitter = Splitter({r["word"]: r["n"] for r in most_frequent(repeated, "n", vocabulary)})
    scratch.drop(repeated)
    host, path = host_and_path(F.col(url))
    urls = pages.select(host.alias("host"), path.alias("path")).where("host <> ''")

    def count(batches):
        for batch in batches:
            totals: dict[str, list[int]] = {}
            for h, p, odds in zip(*(column.to_pylist() for column in batch.columns)):
                words, bad = features(h, p, splitter)
                for w in [*words, ""]:
                    totals.setdefault(w, [0, 0])[bad or odds > CONFIDENT] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([c[0] for c in totals.values()], pa.int64()),
                                              pa.array([c[1] for c in totals.values()], pa.int64())], names=["word", "good", "bad"])

    scored, counts = urls.withColumn("bad_odds", F.lit(0.0)), None
    for left in reversed(range(rounds)):
        summed = scored.select("host", "path", "bad_odds").mapInArrow(count, "word string, good long, bad long")
        summed = summed.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        before, counts = counts, scratch.keep(summed.withColumn("n", F.col("good") + F.col("bad")), "url-words")
        if before is not None:
            scratch.drop(before)
        told = counts.where("word <> ''")
        size, good, bad = told.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
        words = {r["word"]: (r["good"], r["bad"]) for r in most_frequent(told, "n", HEAD)}
        whole = counts.where("word = ''").first()
        bayes = Bayes(words, (whole["good"], whole["bad"]) if whole else (0, 0), size, (good, bad))
        if left:
            scored = _odds(urls, splitter, bayes, told)
    return splitter, bayes, told


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule``, ``verdict`` and the log odds ``bad_odds``.

    NULL urls and urls without :// have an empty host and path, fit no rule and are
    allowed, with NULL odds. Equal rows are judged alike. Columns with the added names are
    replaced. The html is read only for word counts; without any, words split less well.
    """
    splitter, bayes, counts = learn(pages, url, html)
    host, path = host_and_path(F.col(url))
    base = pages.drop("host", "path", "rule", "verdict", "bad_odds")
    known = spare_name(base, "_known")
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    scored = _odds(base.withColumns({"host": host, "path": path}), splitter, bayes, counts)
    return scored.withColumns({"rule": text, known: verdict}).withColumn(
        "verdict", F.coalesce(F.col(known), F.when(F.col("bad_odds") > 0, F.lit("block")).otherwise(F.lit("allow")))).drop(known)
