import collections
import importlib
import itertools
import math
import random
import re

import pytest
from cases import EDGES

import __spark_entry__ as entry_file
from cohortlens.llm import page_diff, queries, url_filter


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_aligned_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in "ab")
        at = page_diff.common_lines(a, b)
        rest = iter(b)
        assert len(at) == longest_common(a, b) and at == sorted(set(at)) and all(a[k] in rest for k in at)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header>Site</header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice"><p>We use cookies</p></div>{body}
<aside>More</aside><form><label>Mail</label><input></form><div id="comments"><p>Nice!</p></div><footer>&copy; 2020</footer></body></html>"""


def page(body):
    return PAGE.replace("{body}", body)


def text_of(html):
    return page_diff.main_text(page_diff.lines_of(html), set())


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &amp; B</h1><p>one <b>two</b>\n  three<p>four<br>five</article>", "A & B\none two three\nfour five"),
    ("<main><p>x</p><div class='ad'>buy</div><p>y</p><section class='comments'><p>first!</p></section></main>", "x\ny"),
    ("<article><p><b>open<br><p>next</article><p>outside</p>", "open\nnext"),
    ("<article><p>a<!-- <p>no</p> -->b</p><p> </p><p>5 < 6 &lt; 7</p></article>", "ab\n5 < 6 < 7"),
    ("<article></article>", ""),
])
def test_main_text(body, text):
    assert text_of(page(body)) == text


@pytest.mark.parametrize("attributes, stays", [
    ('style="overflow:hidden"', True), ('aria-hidden="false"', True), ('title="the hidden valley"', True), ("data-id='share'", True), ("title=\"class='ad'\"", True),
    ("data-hidden", True), ('class="story" class="ad"', True), ("hidden", False), ("title=x hidden", False), ('title="a"hidden', False), ("HIDDEN=''", False),
    ("ID = share", False), ("data-x=1 role='navigation'", False), ("class='box ad-top'", False)])
def test_attributes_count_by_their_exact_names(attributes, stays):
    body = f"<article><p>x</p><div {attributes}><p>y</p></div></article>"
    assert text_of(page(body)) == ("x\ny" if stays else "x")


def test_shared_lines_go_where_no_article_is_declared(spark):
    def plain(k):
        return f"<body><p>Template line</p><p>Story {k} begins</p><p>Story {k} ends</p><p>All rights</p></body>"
    rows = [(k, f"http://h{k % 2}.example/a/{k}", plain(k)) for k in range(6)] + [(9, "http://alone.example/x", plain(9))]
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: f"Story {k} begins\nStory {k} ends" for k in range(6)}, 9: "Template line\nStory 9 begins\nStory 9 ends\nAll rights"}


def test_copied_articles_stay(spark):
    rows = [(k, f"http://h.example/{k}", page("<article><p>Copied story</p></article>" + "<p>x</p>" * k)) for k in range(3)]
    got = page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in got] == [("Copied story", 12)] * 3


def test_template_lines_inside_articles_go(spark):
    """Share lines and notices on several pages with other stories; copies, and a line that one other page has, stay."""
    def story(k, extra=""):
        return page(f"<article><p>By the editors</p><p>Story {k} begins</p><p>Story {k} goes on</p>{extra}<p>Story {k} ends</p><p>Tell your friends</p></article>")
    rows = [(k, f"http://h.example/a/{k}", story(k, "<p>Said twice</p>" if k < 2 else "")) for k in range(6)]
    rows += [(10 + k, f"http://copies.example/{k}", page("<article><p>One</p><p>Two</p><p>Three</p></article>" + "<p>x</p>" * k)) for k in range(4)]
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    said = {0: "Said twice\n", 1: "Said twice\n"}
    assert got == {**{k: f"Story {k} begins\nStory {k} goes on\n{said.get(k, '')}Story {k} ends" for k in range(6)}, **{10 + k: "One\nTwo\nThree" for k in range(4)}}


def page_edges(spark):
    rows = [(1, None, page("<article><p>x</p></article>")), (2, "no scheme", None), (3, "http://", ""), (None, "http://A.Example.COM?q", "<p>plain"),
            (4, "http://a.org/b", "<p>" + "long words " * 60_000), (4, "http://a.org/b", "<p>" + "long words " * 60_000), (5, "http://é.net:80/ü#x", "< p > not a tag <"), (None, None, None)]
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, host string, page string")


def test_page_edges(spark):
    edges = page_edges(spark)
    got = page_diff.extract(edges).collect()
    assert len(got) == 8 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == ["x"] and {r.text for r in got if r.page_id in (2, 3)} == {""}
    assert {r.n_chars for r in got if r.page_id == 4} == {60_000 * 11 - 1}
    assert page_diff.extract(edges.where("false")).count() == 0


def test_pages_of_the_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in page_diff.extract(pages).collect()}
    assert got == {r.page_id: text_of(r.html) for r in pages.collect()} and all(got.values())


# ---- url filter


def split_by_force(run, splitter):
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(run)]
        parts = [run[a:b] for a, b in itertools.pairwise(at)]
        cost = sum(splitter._cost(p) for p in parts)
        best = min(best or (math.inf, parts), (cost, parts))
    return best


def test_viterbi_finds_the_most_probable_split():
    splitter = url_filter.Splitter({"the": 500, "there": 100, "rein": 40, "in": 300, "hat": 60, "at": 200})
    for run in ("therein", "thehat", "cheappills", "zqthe", "x"):
        assert sum(map(splitter._cost, splitter(run))) == pytest.approx(split_by_force(run, splitter)[0])
    assert splitter("cheappills") == ["cheap", "pills"] and splitter("") == []


def expected_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_rules_and_verdicts(spark, sf):
    pages = spark.read.parquet(f"{sf}/../sf0.01/pages.parquet")  # some bad hosts are met more than once
    got = url_filter.judge_urls(pages, queries.URL_RULES).select("page_id", "url", "host", "path", "rule", "verdict", "bad_odds").collect()
    assert len(got) == pages.count()
    for r in got:
        rest = r.url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        rule = expected_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.bad_odds > 0 else "allow")
    open_ = [(any(w in r.host for w in ("casino", "pills", "bets", "spam", "ads-")), r.verdict) for r in got if r.rule is None]
    assert all((v == "block") == bad for bad, v in open_)


def test_rare_words_count_like_frequent_ones(spark, monkeypatch):
    """Path words fill the head; the listed word of a host still blocks it."""
    rows = [(k, f"http://good{'abcdef'[k % 6]}.example/same/words/everywhere", "<p>good example</p>") for k in range(60)]
    rows += [(100 + k, f"http://www.{w}.test/same", "") for k, w in enumerate(["warez", "warez", "poker", "poker", "poker"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = {r.page_id: (r.verdict, r.bad_odds) for r in url_filter.judge_urls(pages, []).collect()}
    monkeypatch.setattr(url_filter, "HEAD", 3)
    got = {r.page_id: (r.verdict, r.bad_odds) for r in url_filter.judge_urls(pages, []).collect()}
    assert {k: v for k, (v, _) in got.items()} == {k: "block" if k >= 100 else "allow" for k in whole}
    assert all(got[k][1] == pytest.approx(whole[k][1]) for k in whole) and len(got) == len(rows)


def planted_urls():
    """Listed hosts, a family that shares words with them, one that shares words with that family, and plain hosts."""
    rng = random.Random(4)
    listed = ["bonus-casino-prize", "megabonuspoker", "prize-slots-win", "winbonusbets", "jackpot-prize-bonus"]
    family = ["bonus-prize-win", "megabonuswin", "prizewinbonus"]  # no listed word
    plain = ["gardenmusic", "travelnews", "health-forum", "wikimusic", "store-travel", "newsgames", "homegarden", "market-news"]
    rows = [(h, f"http://www.{h}{rng.randrange(9)}.example/{rng.choice(['en', 'de'])}/{rng.randrange(999)}.html")
            for h, n in [(h, 12) for h in listed] + [(h, 3) for h in family] + [(h, 60) for h in plain] for _ in range(n)]
    rng.shuffle(rows)
    return [(k, h, u, "<p>bonus prize garden music travel</p>") for k, (h, u) in enumerate(rows)], family, set(plain)


def test_bayes_decides_hosts_without_listed_words(spark):
    rows, family, plain = planted_urls()
    pages = spark.createDataFrame(rows, "page_id long, kind string, url string, html string")
    got = url_filter.judge_urls(pages, []).collect()
    assert {r.kind for r in got if r.verdict == "allow"} == plain
    assert {r.kind for r in got if r.verdict == "block"}.issuperset(family)


def test_odds_by_brute_force(spark):
    """The rounds of counting, redone in plain Python over the whole table."""
    rows, *_ = planted_urls()
    pages = spark.createDataFrame(rows, "page_id long, kind string, url string, html string")
    got = {r.page_id: r.bad_odds for r in url_filter.judge_urls(pages, []).collect()}
    words_of_pages = collections.Counter(w for *_, html in rows for w in re.findall("[a-z]{2,}", re.sub("<[^>]*>", " ", html)))
    splitter = url_filter.Splitter(dict(words_of_pages))
    samples = {k: url_filter.features(*re.match("http://([^/]*)(.*)", u).groups(), splitter) for k, _, u, _ in rows}
    odds = dict.fromkeys(samples, 0.0)
    for _ in range(url_filter.ROUNDS):
        counts, urls = (collections.Counter(), collections.Counter()), [0, 0]
        for k, (found, listed) in samples.items():
            bad = listed or odds[k] > math.log(9)
            counts[bad].update(found)
            urls[bad] += 1
        size = len(counts[0].keys() | counts[1].keys())
        share = [{w: math.log((c[w] + 1) / (c.total() + size + 1)) for w in counts[0].keys() | counts[1].keys()} for c in counts]
        odds = {k: math.log((urls[1] + 1) / (urls[0] + 1)) + sum(share[1][w] - share[0][w] for w in found) for k, (found, _) in samples.items()}
    assert got == pytest.approx(odds)


def test_most_frequent_words_with_ties(spark, tmp_path):
    rows = [("d", 3), ("a", 1), ("c", 3), ("b", 3), ("e", 9), ("f", 1)]
    table = spark.createDataFrame(rows, "word string, n long")
    for k in range(8):
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        assert sorted(tuple(r) for r in url_filter.most_frequent(table, "n", k)) == sorted(want)


def test_url_edges(spark):
    got = url_filter.judge_urls(page_edges(spark), queries.URL_RULES).collect()
    assert len(got) == 8
    by = {(r.page_id, r.url): r for r in got}
    assert all((r.host, r.path, r.rule, r.verdict) == ("", "", None, "allow") for k, r in by.items() if k[1] in (None, "no scheme", "http://"))
    host = by[None, "http://A.Example.COM?q"]
    assert (host.host, host.path, host.rule) == ("a.example.com", "", None)
    assert by[4, "http://a.org/b"].rule == "org/" and by[5, "http://é.net:80/ü#x"].path == "/ü"
    assert url_filter.judge_urls(page_edges(spark).where("false"), queries.URL_RULES).count() == 0


# ---- registration and pipeline


def test_every_operator_has_its_query():
    names = [k for k in entry_file.queries() if k.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_file.queries()


def test_pipeline_against_its_parts(spark, sf):
    from test_join_and_leaks import groups_by_force

    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = pipeline.known_language(spark, docs, sf)
    assert kept.columns == docs.columns and kept.count() == len(rows)  # every document has a language
    once = pipeline.one_of_each_group(spark, docs, sf)
    assert {r.doc_id for r in once.collect()} == {c for _, _, c in groups_by_force([(r.doc_id, r.text) for r in rows.values()])}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = pipeline.no_leaks(spark, once, sf)
    assert not any(i in r.text for r in clean.collect() for i in items)
    final = pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in final} <= {r.doc_id for r in clean.collect()}
    assert all(r.text == rows[r.doc_id].text for r in final)
    places = sorted((r.shard, r.slot) for r in final)
    assert len(set(places)) == len(final) and sorted(s * pipeline.SHARDS + k for k, s in places) == list(range(len(final)))


def test_stages_on_edges(spark, sf, edges, nothing):
    pipeline = importlib.import_module("corpus_pipeline")
    for frame, n in ((edges, len(EDGES)), (nothing, 0)):
        columns = frame.columns
        for k, (_, stage) in enumerate(pipeline.STAGES):
            frame = stage(spark, frame, sf)
            assert frame.count() <= 2 * n and (k == 4 or frame.columns == columns)
