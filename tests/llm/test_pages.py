"""Main text of pages and url verdicts."""

import html as entities
import math
import re

import pytest

from pyspark.sql import functions as F

from hourgrid.llm import html_main, url_filter
from hourgrid.llm.frames import table
from hourgrid.llm.queries import URL_RULES

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies</div><nav><ul><li><a href="/">Home</a></ul></nav><div class="wrap2"><main>
<article class="post-%d"><header><h1>Head &amp; Tail</h1><p class="byline">me</p></header><div class="body">
<p>First <b>bold</b>&nbsp;words that go
on.<p>Second<script>if(a<b){"</p>"}</script> part<br>after break<div class="advert">Buy</div><ul><li>one<li>two</ul>
<form>q<input></form></div><section class="comments"><p>A reader says hello</p></section></article></main>
<aside>aside</aside></div><footer>foot</footer></body></html>"""
TEXT = "Head & Tail\nFirst bold words that go on.\nSecond part after break\none\ntwo"


def main_text(html):
    page = html_main.parse(html)
    node, path, _ = html_main.best_container(page)
    return html_main.text_under(page, path, node)


def test_furniture_is_left_out():
    assert main_text(PAGE % 1) == TEXT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a", "a"), ("<div><p>x</div></p></b>y", "x\ny"),
        ('<a href="x>broken</a><p>z</p>', "broken\nz"), ("<script>never closed", ""), ("<!-- open", ""),
        ("<div>" * 3000 + "deep", "deep"), ("<p>" * 3000 + "deep", "deep"), ("<<<>>", "<<<>>"),
    ],
)
def test_broken_markup_never_fails(html, text):
    assert main_text(html) == text


def test_a_host_agrees_on_its_path(spark):
    odd = "<html><body><div class='box'><p>" + "teaser text " * 30 + "</p></div><article class='post-9'><p>Short.</p></article></body></html>"
    good = "<html><body><div class='box'><p>teaser</p></div><article class='post-%d'><p>" + "body words " * 30 + "</p></article></body></html>"
    rows = [(k, "http://a.org/%d" % k, good % k) for k in range(9)] + [(10, "http://A.org/x", odd), (11, "http://b.org/x", odd)]
    rows += [(12, None, odd), (13, "no host", None), (13, "no host", None), (None, "http://a.org/z", "")]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    found = {}
    for r in html_main.extract_main_text(pages).collect():
        found.setdefault(r["page_id"], []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    assert found[10][0]["text"] == "Short." and found[10][0]["host_path"] == ">html>body>article.post-#"
    assert found[11][0]["text"].startswith("teaser") and found[12][0]["text"].startswith("teaser")
    assert [r["text"] for r in found[13]] == ["", ""] and found[None][0]["n_chars"] == 0
    assert html_main.extract_main_text(pages.where("false")).count() == 0


def test_given_pages_equal_their_article(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_main.extract_main_text(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1|h2|ul|li)>", article)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in blocks if b)


def urls(spark, *texts):
    return spark.createDataFrame([(k, u) for k, u in enumerate(texts)], "page_id long, url string")


def judged(pages, rules=()):
    return {r["page_id"]: r for r in url_filter.judge_urls(pages, rules, html_col=None).collect()}


def test_host_path_and_longest_rule(spark):
    cases = [
        ("https://WWW.Example.com/en/1?x=/a#b", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/2", "m.example.com", "/en/2", "example.com/en/", "block"),
        ("http://example.com/de/", "example.com", "/de/", "com/", "allow"),
        ("http://a.net/es/x", "a.net", "/es/x", "net/es/", "block"),
        ("http://a.net?q=/es/", "a.net", "", None, "allow"),
        ("x://telecom/", "telecom", "/", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://", "", "", None, "allow"),
        ("a://b.com//c://d#e", "b.com", "//c://d", "com/", "allow"),
    ]
    found = judged(urls(spark, *[c[0] for c in cases]), URL_RULES)
    for k, (_, *want) in enumerate(cases):
        assert [found[k][c] for c in ("host", "path", "rule", "verdict")] == want


def test_seed_hosts_and_their_company_are_blocked(spark):
    good = [f"http://{h}.org/en/{k}" for h in ("gardenbook", "cityschool", "riverpress", "oldlibrary") for k in range(40)]
    bad = [f"http://{h}.org/en/{k}" for h in ("cheappills", "casino-zorp", "zorp-casino") for k in range(10)]
    found = judged(urls(spark, *good, *bad, "http://zorp.org/en/1", "http://quiet.org/en/1"))
    assert {found[k]["verdict"] for k in range(len(good))} == {"allow"}
    assert {found[k]["verdict"] for k in range(len(good), len(good) + len(bad))} == {"block"}
    assert found[len(good) + len(bad)]["verdict"] == "block" and found[len(good) + len(bad) + 1]["verdict"] == "allow"


def test_segmentation():
    segmenter = url_filter.Segmenter({"health": 50, "the": 500, "tion": 20})
    assert segmenter.split("freecasinobonus") == ["free", "casino", "bonus"]
    assert segmenter.split("zzqqcasino") == ["zzqq", "casino"]
    assert segmenter.split("") == []
    assert url_filter.host_words("m.ab-12.com", segmenter)[-2:] != [] and url_filter.NUMBER in url_filter.host_words("a12", segmenter)


def test_joined_candidates_split_like_the_whole_table(spark, sf_dir):
    """Each host gets the words that a split with all counts at hand gives it, long words and names too."""
    pages = table(spark, sf_dir, "pages")
    counts = url_filter.word_counts(pages, "url", "html")
    long_word = "donaudampfschifffahrtsgesellschaft"
    counts = counts.unionByName(spark.createDataFrame([(long_word, 40), ("zorp", 7)], "word string, n long"))
    extra = [(f"www.my{long_word}zorp24.net",), ("9.8.7",), ("",), ("é-zorp.casinobonus." + "x" * 300,), (None,)]
    hosts = pages.select(html_main.host_of(F.col("url")).alias("host")).unionByName(spark.createDataFrame(extra, "host string"))
    hosts = hosts.where("host IS NOT NULL").distinct()
    segmenter = url_filter.Segmenter({r["word"]: r["n"] for r in counts.collect()})
    found = {r["host"]: r["words"] for r in url_filter.segment_hosts(hosts, counts).collect()}
    assert set(found) == {r["host"] for r in hosts.collect()}
    for host, words in found.items():
        assert words == url_filter.host_words(host, segmenter)
    assert long_word in found[extra[0][0]]


def test_company_of_hidden_seeds_is_found(spark):
    bad = [f"http://{s}-{w}zorp{k}.org/" for k, s in enumerate(url_filter.SEEDS) for w in ("", "win")]
    good = [f"http://{g}garden{k}.org/" for k in range(60) for g in ("river", "city")]
    words = [f"<title>{w}</title>" for w in ["zorp garden river city win"] * 10]
    rows = [(i, u, words[i % 10]) for i, u in enumerate(bad + good)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["bad"]: (r["hosts"], r["blocked"]) for r in url_filter.hidden_seeds(pages).collect()}
    assert found[True][1] >= 0.9 * found[True][0] > 0 and found[False][1] == 0


def test_naive_bayes_equals_plain_counts(spark):
    """Scores from plain counts of the distinct urls, with the words of the given splits."""
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(["http://casino-a.org/x", "http://b.org/x/y", "http://b.org/x/y", "http://c.org/casino", None])], "page_id long, url string")
    hosts = {"casino-a.org": ["casino", "a", "org"], "b.org": ["b", "org"], "c.org": ["c", "org"], "": []}
    distinct = {("casino-a.org", "/x"): ["x"], ("b.org", "/x/y"): ["x", "y"], ("c.org", "/casino"): ["casino"], ("", ""): []}
    counts, classes = {True: {}, False: {}}, {True: 1, False: 1}
    for (host, _), path in distinct.items():
        bad = "casino" in hosts[host] + path
        classes[bad] += 1
        for w in hosts[host] + path:
            counts[bad][w] = counts[bad].get(w, 0) + 1
    used = len(counts[True].keys() | counts[False].keys())
    share = lambda w, bad: (counts[bad].get(w, 0) + 0.5) / (sum(counts[bad].values()) + 0.5 * used)
    prior = math.log(classes[True] / classes[False])
    for r in url_filter.judge_urls(pages, html_col=None).collect():
        words = hosts[r["host"]] + distinct[r["host"], r["path"]]
        assert r["score"] == pytest.approx(prior + sum(math.log(share(w, True) / share(w, False)) for w in words), abs=1e-5)


def test_empty_table_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "old", 2.0, "<title>x y</title>")], "page_id long, url string, host string, score double, html string")
    row = url_filter.judge_urls(pages).first()
    assert row["host"] == "a.org" and row["verdict"] == "allow"
    assert url_filter.judge_urls(pages.where("false")).count() == 0
