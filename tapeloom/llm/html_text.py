"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its tag paths and its text blocks under their path.
Over the pages of a host every token has an occurrence vector, the count on each
page; tokens with equal vectors form an equivalence class. Classes of enough
tokens and support are valid: they are the host's template, nested as their
paths nest. What the template's paths hold on a page and the template does not
repeat is in slots; slots of articles, or of whatever is not part of menus,
notices and the like, make up the text.

Vectors are compared by the sum of a hash for each page and count, so a token's
vector is one number, and no task holds a host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import stage

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template xmp svg math".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
_ENDS_P = _BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "title"}
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "p": {"p"},
}
_SCOPE = frozenset("table ul ol dl html body article main section nav aside footer header div form".split())
#: elements that are never part of an article
_OUTSIDE = frozenset(
    "head nav footer aside form button select option input label dialog menu object embed canvas audio video".split()) | _RAW
#: words in class names, ids and roles of what surrounds an article
_SURROUNDINGS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidenav footer header masthead topbar toolbar cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "comment comments commentlist reply replies respond disqus discussion related recommended recommendations pagination "
    "pager widget widgets skip contentinfo complementary dialog form paywall teaser teasers".split())
_INSIDE_ARTICLE = frozenset("comment comments reply replies related teaser teasers ad ads advert sponsored promo".split())


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _surrounds(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in _OUTSIDE or tag == "header" and not in_article:
        return True
    if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body", "main"):
        return False
    names = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    if not names:
        return False
    parts = {p.lower() for p in _PARTS.findall(names)}
    return bool(parts & (_INSIDE_ARTICLE if tag == "article" else _SURROUNDINGS))


class Block:
    """A run of text between block borders: its path, whether it surrounds or is in an article, and its characters."""

    __slots__ = ("path", "outside", "article", "text", "linked")

    def __init__(self, path: str, outside: bool, article: bool):
        self.path, self.outside, self.article, self.text, self.linked = path, outside, article, [], 0


def blocks(page: str) -> tuple[list[Block], dict[str, int]]:
    """The text blocks of a page in their order, and how often each tag path occurs."""
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, outside, in an article
    found: list[Block] = []
    paths: dict[str, int] = {}
    at, current, links = 0, None, 0

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        _, path, outside, article = stack[-1]
        if current is None or current.outside != outside or current.article != article:
            current = Block(path, outside, article)
            found.append(current)
        current.text.append(raw)
        if links:
            current.linked += len(raw)

    def pop(tag: str, scope: bool) -> None:
        nonlocal current, links
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                closed = stack[k:]
                del stack[k:]
                links -= sum(x[0] == "a" for x in closed)
                if any(x[0] in _BLOCK for x in closed):
                    current = None
                return
            if scope and stack[k][0] in _SCOPE:
                return

    position = 0
    while True:
        m = _MARKUP.search(page, position)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = position = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            pop(tag, scope=tag in ("p", "li"))
            if tag in ("p", "br"):
                current = None if tag == "p" else current
            continue
        for other in _SIBLINGS.get(tag, ()):
            pop(other, scope=True)
        if tag in _ENDS_P:
            pop("p", scope=True)
        if tag in _BLOCK:
            current = None
        attributes = _attributes(m[3])
        name = tag + "".join("." + x for x in sorted(attributes.get("class", "").split())[:3])
        _, above, outside, article = stack[-1]
        path = f"{above}/{name}" if tag in _BLOCK else above
        if tag in _BLOCK:
            paths[path] = paths.get(path, 0) + 1
        if tag == "br":
            if current is not None:
                current.text.append(" ")
            continue
        if tag in _VOID or m[3].rstrip().endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = position = end.end() if end else len(page)
            continue
        surrounds = _surrounds(tag, attributes, article)
        article = article or tag in ("article", "main") or attributes.get("role") in ("main", "article")
        stack.append((tag, path, outside or surrounds, article))
        links += tag == "a"
    out = []
    for b in found:
        text = " ".join(html.unescape("".join(b.text)).split())
        if text:
            b.text = text
            out.append(b)
    return out, paths


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - 2**63


def templates(pages: DataFrame, *, least: int = 10, share: float = 0.5, links: float = 0.8) -> DataFrame:
    """(host, fixed, menus): keys of the text blocks that a host's template repeats, and of paths that hold links.

    A token counts as template if its class has two tokens or more and occurs on
    ``least`` different pages and a ``share`` of the host's. Equal pages count
    once. A host's arrays are bounded by the tokens of a page divided by ``share``.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for host, h, page in zip(b["host"], b["h"], b["html"]):
                parts, paths = blocks(page)
                tokens = {_key(p): [0, n, 0, 0] for p, n in paths.items()}
                for x in parts:
                    path = tokens.setdefault(_key(x.path), [0, 0, 0, 0])
                    path[2] += len(x.text)
                    path[3] += min(x.linked, len(x.text))
                    tokens.setdefault(_key(x.path, x.text), [1, 0, len(x.text), 0])[1] += 1
                tokens[0] = [2, 1, 0, 0]
                out += [(host, h, t, *v) for t, v in tokens.items()]
            yield pd.DataFrame(out, columns=["host", "h", "token", "kind", "n", "chars", "linked"])

    seen = pages.select("host", F.xxhash64("html").alias("h"), "html").mapInPandas(
        rows, "host string, h long, token long, kind int, n long, chars long, linked long").groupBy(
        "host", "token", "kind", "h").agg(F.max("n").alias("n"), F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    vectors = stage(seen.groupBy("host", "token", "kind").agg(
        F.count("*").alias("pages"), F.sum(F.shiftright(F.xxhash64("h", "n"), 8).cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked")).where(F.col("pages") >= least), "html-vectors")
    hosts = vectors.where(F.col("kind") == 2).select("host", F.col("pages").alias("all"))
    often = vectors.where(F.col("kind") < 2).join(hosts, "host").where(F.col("pages") >= share * F.col("all"))
    classes = often.groupBy("host", "vector").agg(F.count("*").alias("size")).where(F.col("size") >= 2)
    valid = often.join(classes, ["host", "vector"], "left_semi")
    return valid.groupBy("host").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("token"))).alias("fixed"),
        F.collect_list(F.when((F.col("kind") == 0) & (F.col("linked") >= links * F.greatest("chars", F.lit(1))), F.col("token"))).alias("menus"))


def page_text(page: str, fixed: frozenset[int] = frozenset(), menus: frozenset[int] = frozenset()) -> str:
    """Slots of a page's article joined by an empty line; without an article those of the whole page.

    Slots are the blocks that are neither among the template's ``fixed`` ones nor
    under its ``menus``; the names of what surrounds an article are looked at besides.
    """
    parts = [b for b in blocks(page)[0] if not b.outside]
    inside = [b for b in parts if b.article]
    return "\n\n".join(b.text for b in inside or parts if _key(b.path, b.text) not in fixed and _key(b.path) not in menus)


def main_text(pages: DataFrame, **more) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without an article's text, have an empty
    text. Pages without a url form one host. Repeated rows get a row each and
    count once for the template; an empty table gives none; other columns are
    ignored.
    """
    host = F.coalesce(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    rows = pages.select("page_id", "url", F.lower(host).alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for page, fixed, menus in batches:
            yield pd.Series([
                page_text(p, frozenset(() if f is None else f), frozenset(() if m is None else m))
                for p, f, m in zip(page, fixed, menus)])

    # written first: Spark then knows its size and broadcasts it or splits a frequent host in the join
    return rows.join(stage(templates(rows, **more), "html-templates"), "host", "left").select(
        "page_id", "url", extract("html", "fixed", "menus").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
