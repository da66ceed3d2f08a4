"""Main text of web pages through consensus paths per host.

1. Every page is parsed alone: text blocks, their containers, and a score per
   container (text credited to the container of a block, halved per level up,
   less what stands in links). Each page votes for its best container's
   generalised path: tags with their classes, numbers taken out.
2. Votes are added up per host and path in Spark; the path with most votes wins.
3. Every page is parsed again and the text under its host's path is taken. A
   page without that path, or without a host, uses its own best container.

Votes are reduced in each task before the shuffle, and only one short row per
host meets the pages again, so a host with a third of all pages is no hot key
but in a join that Spark can split.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.frames import computed, stage

# Element names and the class or id words that mark page furniture.
SKIPPED = frozenset(
    "head script style noscript template iframe svg canvas object nav footer aside form button select menu dialog".split()
)
RAW = frozenset("script style noscript textarea template iframe title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | frozenset("p li dd dt blockquote pre td th tr tbody thead tfoot ul ol dl table figcaption".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
NOT_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
FURNITURE = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments commentlist disqus respond replies cookie cookies consent "
    "gdpr notice newsletter subscribe signup popup modal overlay share sharing social related recommended widget "
    "toolbar pagination pager login".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())

# Levels of elements that a path tells apart; deeper elements carry their ancestor's path.
DEPTH = 60

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NUMBERS = re.compile(r"\d+")


@dataclass
class Node:
    tag: str
    parent: int
    skip: bool
    inside: bool  # inside an article or main element
    path: str
    depth: int


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(text)} if text.strip(" /") else {}


def _step(tag: str, attrs: dict[str, str]) -> str:
    classes = sorted({_NUMBERS.sub("#", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *classes])


def _furniture(tag: str, attrs: dict[str, str], inside: bool, parent_header: bool) -> bool:
    if tag in SKIPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower() or attrs.get("role", "").lower() in ROLES:
        return True
    if parent_header and tag not in HEADINGS and tag in BLOCKS and tag not in ("div", "hgroup"):
        return True  # of an article's own header only the headings are text
    if tag == "header" and not inside:
        return True
    if tag in ("html", "body", "article", "main") or not (attrs.get("class") or attrs.get("id")):
        return False
    words = re.split(r"[^a-z]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return not FURNITURE.isdisjoint(words)


def parse(html: str) -> Page:
    """Text blocks of a page with the element each stands in; never fails on broken markup."""
    page = Page([Node("", -1, False, False, "", 0)])
    nodes, stack = page.nodes, [0]
    text: list[str] = []
    opened: Counter[str] = Counter()
    links, in_link = 0, 0

    def flush() -> None:
        nonlocal links
        if nodes[stack[-1]].skip:
            return  # what waits stands before the skipped element and may go on after it
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                block = next((i for i in reversed(stack) if nodes[i].tag in BLOCKS), 0)
                page.blocks.append((block, joined, links))
            text.clear()
        links = 0

    def close_to(depth: int) -> None:
        for i in stack[depth:]:
            opened[nodes[i].tag] -= 1
        del stack[depth:]

    at, size = 0, len(html)
    for m in _TAG.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at and not nodes[stack[-1]].skip:
            piece = html[at : m.start()]
            text.append(piece)
            links += len(piece) if in_link else 0
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        tag = name.lower()
        if m["end"] or m["end2"]:
            if tag in BLOCKS:
                flush()
            if opened[tag]:
                depth = next(d for d in range(len(stack) - 1, 0, -1) if nodes[stack[d]].tag == tag)
                if any(nodes[i].tag in BLOCKS for i in stack[depth + 1 :]) and tag not in BLOCKS:
                    continue  # a stray inline end tag does not close blocks
                close_to(depth)
                in_link -= tag == "a" and in_link > 0
            continue
        attrs_text = m["attrs"] if m["name"] else m["attrs2"]
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag in BLOCKS:
            flush()
            depth = len(stack) - 1
            while depth and nodes[stack[depth]].tag not in BLOCKS:
                depth -= 1
            if depth and nodes[stack[depth]].tag == "p":
                close_to(depth)
        if tag in CLOSED_BY and any(opened[t] for t in CLOSED_BY[tag]):
            for d in range(len(stack) - 1, 0, -1):
                if nodes[stack[d]].tag in NOT_CLOSING.get(tag, ()):
                    break
                if nodes[stack[d]].tag in CLOSED_BY[tag]:
                    flush()
                    close_to(d)
                    break
        if tag in VOID:
            continue
        above = nodes[stack[-1]]
        attrs = _attributes(attrs_text)
        inside = above.inside or tag in ("article", "main")
        skip = above.skip or _furniture(tag, attrs, above.inside, above.tag == "header")
        path, deep = above.path, above.depth
        if tag in BLOCKS and deep < DEPTH:
            path, deep = f"{path}>{_step(tag, attrs)}", deep + 1
        nodes.append(Node(tag, stack[-1], skip, inside, path, deep))
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if not attrs_text.rstrip().endswith("/") or tag in BLOCKS:
            stack.append(len(nodes) - 1)
            opened[tag] += 1
            in_link += tag == "a"
    if at < size and not nodes[stack[-1]].skip:
        text.append(html[at:])
    flush()
    return page


def best_container(page: Page) -> tuple[int, str, float]:
    """(node, path, share of all credit) of the container with most text; (0, '', 0) if there is no text."""
    credit: dict[int, float] = {}
    for node, text, links in page.blocks:
        i, worth = node, max(0.0, len(text) - 1.5 * links)
        while i > 0 and page.nodes[i].tag in LEAVES:
            i = page.nodes[i].parent
        while i >= 0 and worth >= 1:
            if page.nodes[i].tag in BLOCKS or i == 0:
                credit[i] = credit.get(i, 0.0) + worth
                worth /= 2
            i = page.nodes[i].parent
    if not credit:
        return 0, "", 0.0
    best = max(credit, key=lambda i: (credit[i], -i))
    share = credit[best] / sum(credit.values())
    # The whole article, if the best container is only its inner part.
    i, whole = best, best
    while i > 0:
        whole = i if page.nodes[i].tag in ("article", "main") and whole == best else whole
        i = page.nodes[i].parent
    return whole, page.nodes[whole].path, share


def text_under(page: Page, path: str | None, node: int) -> str:
    """Blocks under the elements with ``path``; under ``node`` if the page has none of them."""
    nodes = page.nodes

    def below(roots: set[int]) -> list[str]:
        under = [False] * len(nodes)
        for i, n in enumerate(nodes):  # a parent comes before its children
            under[i] = i in roots or (n.parent >= 0 and under[n.parent])
        return [t for i, t, _ in page.blocks if under[i]]

    roots = {i for i, n in enumerate(nodes) if path and n.path == path and n.tag in BLOCKS}
    return "\n".join((below(roots) if roots else []) or below({node}))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: ``host``, ``path`` (the winner; ties go to the last by name), ``votes``."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [best_container(parse(h or ""))[1:] for h in batch["html"]]
            out = pd.DataFrame({"host": batch["host"], "path": [f[0] for f in found], "share": [f[1] for f in found]})
            yield out[out["path"] != ""].groupby(["host", "path"], as_index=False).agg(votes=("share", "sum"))

    with_host = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host != ''")
    votes = with_host.mapInPandas(vote, "host string, path string, votes double")
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    best = votes.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best"))
    return best.select("host", "best.path", "best.votes")


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, ``n_chars`` and ``host_path`` in place of the html.

    A NULL or empty html gives an empty text; a NULL url or one without a host
    takes no part in votes; repeated rows give repeated results; columns of these
    names are replaced; an empty table gives an empty result.
    """
    winners = stage(host_paths(pages, url_col, html_col)).select(F.col("host").alias("_winner"), F.col("path").alias("host_path"))
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars", "host_path")]

    def run(htmls: list[str | None], paths: list[str | None]) -> list[list]:
        texts = []
        for h, path in zip(htmls, paths, strict=True):
            page = parse(h or "")
            texts.append(text_under(page, path, best_container(page)[0]))
        return [texts, [len(t) for t in texts]]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    hosted = pages.select(*kept, F.col(html_col).alias("_html"), host_of(F.col(url_col)).alias("_host"))
    found = hosted.join(winners, F.col("_host") == F.col("_winner"), "left").drop("_host", "_winner")
    return computed(found, ["_html", "host_path"], run, fields, ["_html"])
