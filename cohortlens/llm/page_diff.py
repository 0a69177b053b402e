"""Main text of pages by differencing each page with the page of its host nearest by path.

Pages become lines of text, one a block. Lines that a longest common subsequence aligns with
the neighbour's are template and go. So do lines in elements that declare themselves as
menus, notices and the like. Where a page declares an article, nothing outside it is main
text, and a line inside goes only when it aligns with the articles of ``SEVERAL`` neighbours
at least, each with at most half of its lines in common (copied articles are common, and stay).
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import Scratch, number_rows

# HTML elements by role.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
         "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th",
         "thead", "tr", "ul"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "template", "object", "canvas", "audio", "video", "head"}
CHROME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
                "notice", "pager", "pagination", "popup", "promo", "promoted", "recommended", "related", "replies", "reply", "share", "sharing",
                "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

AROUND = 2  # pages looked at on each side in the order of paths
SEVERAL = 2

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[!?/][^>]*>?")
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_BLANK = re.compile(r"\s+")
# An end tag that is optional in HTML: the next of these closes the one before.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}


@dataclass
class Line:
    text: str
    article: bool  # in a declared article
    chrome: bool  # in an element that declares itself to be none


def _declares(name: str, attributes: str, inside: bool) -> bool:
    if name in CHROME or name == "header" and not inside:
        return True
    seen: set[str] = set()
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else []:
        key, value = key.lower(), "".join(values).lower()
        if key in seen:  # the first of a name counts
            continue
        seen.add(key)
        if key == "hidden" or key == "role" and value in CHROME_ROLES:
            return True
        if key in ("class", "id") and CHROME_NAMES.intersection(re.split(r"[^a-z0-9]+", value)) and name not in ("body", "html", "article", "main"):
            return True
    return False


def lines_of(html: str | None) -> list[Line]:
    """The blocks of visible text in page order, references decoded, blanks made one space."""
    html = html or ""
    out: list[Line] = []
    open_: list[tuple[str, bool, bool]] = []  # name, declares article, declares chrome
    parts: list[str] = []
    articles = chromes = at = 0

    def flush() -> None:
        if parts:
            text = _BLANK.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(Line(text, articles > 0, chromes > 0))
            parts.clear()

    def close(k: int) -> None:
        nonlocal articles, chromes
        for _, article, chrome in open_[k:]:
            articles -= article
            chromes -= chrome
        del open_[k:]

    while at < len(html):
        token = _TOKEN.search(html, at)
        if token is None:
            parts.append(html[at:])
            break
        if token.start() > at:
            parts.append(html[at:token.start()])
        at = token.end()
        if token[0] == "<!--":
            end = html.find("-->", at)
            at = len(html) if end < 0 else end + 3
            continue
        if not token[2]:
            continue
        name = token[2].lower()
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append(" ")
        if token[1]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close(k)
                    break
        elif name in RAW:
            end = re.compile(rf"</{name}\b", re.IGNORECASE).search(html, at)
            at = len(html) if end is None else end.start()
        elif name not in VOID and not token[3].endswith("/"):
            if name in _CLOSES:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] in _CLOSES[name]:
                        close(k)
                        break
                    if open_[k][0] in BLOCK:
                        break
            article = name in ("article", "main")
            chrome = _declares(name, token[3], articles > 0)
            open_.append((name, article, chrome))
            articles += article
            chromes += chrome
    flush()
    return out


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by bit-parallel rows."""
    both = set(a) & set(b)
    ours = [i for i, x in enumerate(a) if x in both]
    theirs = [x for x in b if x in both]
    where: dict[int, int] = {}
    for j, x in enumerate(theirs):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(theirs)) - 1
    row, rows = full, []
    for i in ours:
        hit = row & where[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, j = [], len(theirs)
    for k in range(len(ours) - 1, -1, -1):
        below = (1 << j) - 1
        now = j - (rows[k] & below).bit_count()
        before = j - ((rows[k - 1] if k else full) & below).bit_count()
        if now == before:
            continue
        out.append(ours[k])
        # the place in b that this line is matched with: the last that can hold the count
        while j and j - 1 - (rows[k] & ((1 << (j - 1)) - 1)).bit_count() == now:
            j -= 1
        j -= 1
    return out[::-1]


def inner_lines(lines: list[Line]) -> list[int]:
    """Places of the lines that a declared article holds."""
    return [i for i, line in enumerate(lines) if line.article and not line.chrome]


def repeated_inside(lines: list[int], inner: list[int], others: list[tuple[list[int], list[int]]]) -> list[int]:
    """Places of lines of the article that several neighbours, with other articles, repeat."""
    own, counts = [lines[i] for i in inner], [0] * len(inner)
    for theirs, within in others:
        same = common_lines(own, [theirs[j] for j in within])
        if 2 * len(same) <= min(len(inner), len(within)):
            for k in same:
                counts[k] += 1
    return [i for i, n in zip(inner, counts) if n >= SEVERAL]


def main_text(lines: list[Line], shared: set[int]) -> str:
    declared = bool(inner_lines(lines))
    return "\n".join(line.text for i, line in enumerate(lines) if not line.chrome and (line.article or not declared) and i not in shared)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty where it is NULL or has no ://."""
    got = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(got(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), got(2)


def _near(path: Column, other: Column) -> Column:
    """Segments that both paths begin with."""
    a, b = F.split(path, "/"), F.split(other, "/")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same).cast("long"))


def shared_lines(pages: DataFrame, scratch: Scratch, key: Column, url: str, html: str) -> DataFrame:
    """(page, drop): which lines of each page its neighbour repeats; pages without any are left out.

    Only hashes of lines travel. Pages alike in host, path and lines are one; all are numbered
    in order of host and path, and each looks at the rows before and after it that share its
    host and takes the one whose path begins like its own for longer, the earlier in a tie.
    A page that declares an article is held against up to ``AROUND`` rows on each side instead.
    """
    host, path = host_and_path(F.col(url))

    def hashes(batches):
        for batch in batches:
            read = [lines_of(t) for t in batch.column(3).to_pylist()]
            rows = [[line_hash(x.text) for x in lines] for lines in read]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rows, pa.list_(pa.int64())),
                                              pa.array([inner_lines(lines) for lines in read], pa.list_(pa.int32()))], names=["page", "host", "path", "lines", "inner"])

    read = pages.select(key.alias("page"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    listed = read.mapInArrow(hashes, "page long, host string, path string, lines array<long>, inner array<int>")
    listed = scratch.keep(listed.withColumn("variant", F.xxhash64("host", "path", "lines", "inner")), "lines")
    variants = listed.groupBy("variant").agg(*[F.first(c).alias(c) for c in ("host", "path", "lines", "inner")])
    numbered, _ = number_rows(variants, [F.col("host"), F.col("path"), F.col("variant")], scratch, "place")
    numbered = scratch.keep(numbered, "ordered-pages")
    met, sides = numbered, [by for by in range(-AROUND, AROUND + 1) if by]
    for k, by in enumerate(sides):
        side = numbered.select((F.col("place") - by).alias("place"), F.col("host").alias(f"host{k}"), F.col("path").alias(f"path{k}"), F.struct("lines", "inner").alias(f"page{k}"))
        met = met.join(side, "place", "left")
    near = lambda k: F.when(F.col(f"host{k}") == F.col("host"), _near(F.col("path"), F.col(f"path{k}"))).otherwise(-1)
    before, after = sides.index(-1), sides.index(1)
    met = met.withColumns({"_b": near(before), "_a": near(after)}).where("_b >= 0 or _a >= 0")
    around = F.array(*[F.when(F.col(f"host{k}") == F.col("host"), F.col(f"page{k}")) for k in range(len(sides))])
    pairs = met.select("variant", "lines", "inner", F.when(F.size("inner") == 0, F.when(F.col("_b") >= F.col("_a"), F.col(f"page{before}.lines")).otherwise(F.col(f"page{after}.lines"))).alias("other"),
                       F.when(F.size("inner") > 0, F.filter(around, lambda x: x.isNotNull())).alias("others"))

    def align(batches):
        for batch in batches:
            drops = [repeated_inside(a, inner, [(x["lines"], x["inner"]) for x in others]) if inner else common_lines(a, b)
                     for a, inner, b, others in zip(*(batch.column(k).to_pylist() for k in range(1, 5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(drops, pa.list_(pa.int32()))], names=["variant", "drop"])

    aligned = pairs.mapInArrow(align, "variant long, drop array<int>").where(F.size("drop") > 0)
    return scratch.keep(listed.select("page", "variant").distinct().join(aligned, "variant").select("page", "drop").dropDuplicates(["page"]), "shared-lines")


def extract(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(ident, url, text, n_chars): the main text of every page.

    NULL or empty html gives an empty text. Pages alike in url and html are read alike; a
    page with a host of its own has no neighbour and loses nothing to differencing. NULL
    urls and urls without :// share the empty host. NULL ids stay NULL.
    """
    scratch = Scratch(pages.sparkSession)
    key = F.xxhash64(F.col(url), F.col(html))
    shared = shared_lines(pages, scratch, key, url, html)
    base = pages.select(F.col(ident).alias("ident"), F.col(url).alias("url"), F.col(html).alias("html"), key.alias("page"))
    joined = base.join(shared, "page", "left").select("ident", "url", "html", "drop")

    def run(batches):
        for batch in batches:
            texts = [main_text(lines_of(h), set(d or ())) for h, d in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[ident, "url", "text", "n_chars"])

    kind = pages.schema[ident].dataType.simpleString()
    return joined.mapInArrow(run, f"`{ident}` {kind}, url string, text string, n_chars long")
