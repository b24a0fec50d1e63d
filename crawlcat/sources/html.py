"""HTML pages to rows: anchors with their markers, metadata, paragraphs.

Each page is parsed once in an Arrow stage; everything that follows the parse
(choice of a summary, limits, hints, scores) is columns.
"""

from __future__ import annotations

import re
import unicodedata
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crawlcat.config import HostPolicy, Thresholds
from crawlcat.functions import text as t
from crawlcat.functions import urls

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
CLOSED_BY = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
CLOSED_UPTO = {"li": {"ul", "ol", "menu"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "dt": {"dl"}, "dd": {"dl"}}
# Tags without readable text, and what counts as page chrome.
SKIPPED = {"script", "style", "noscript", "svg", "template", "title"}
CHROME = {"nav", "footer", "header", "aside", "form", "menu"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search"}
CHROME_NAMES = re.compile(r"(?:\bnav\b|footer|header|promo|subscribe|sidebar|cookie|banner|menu|newsletter|site-nav|topbar|yc-promo)", re.I)
SCOPES = {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "li"}
MARKER = "/the-reddits-2.gif"
AMPERSAND = re.compile(r"&(#[0-9]+;|#[xX][0-9A-Fa-f]+;|[A-Za-z][A-Za-z0-9]*;)?")
#: Pages whose rows are put together at once.
PAGES = 64


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Builder(HTMLParser):
    """A tree with void elements, implied ends and stray end tags taken care of."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def _close(self, tags: set[str], upto: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in upto:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close({"p"}, {"table", "td", "th", "button"})
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], CLOSED_UPTO[tag])
        node = Node(tag, {})
        for k, v in attrs:
            node.attributes.setdefault(k, v or "")
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open[-1].tag == tag and tag not in VOID and tag in {"path", "circle", "rect", "use"}:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    b = Builder()
    b.feed(html)
    b.close()
    return b.root


def closed_only(html: str) -> str:
    """The page with every ampersand that begins no reference, or one without its semicolon, as a reference to itself: the parser leaves these as they stand."""
    return AMPERSAND.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", html)


def squeezed(s: str) -> str:
    return " ".join(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", unicodedata.normalize("NFC", s)).split())


def text_of(node: Node) -> str:
    """Text below a node; breaks and rules are spaces, unread tags silent."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag in ("br", "hr"):
            out.append(" ")
        elif n.tag not in SKIPPED or n is node:
            stack.extend(reversed(n.children))
    return squeezed("".join(out))


def is_chrome(node: Node) -> bool:
    a = node.attributes
    return node.tag in CHROME or a.get("role", "").lower() in CHROME_ROLES or bool(CHROME_NAMES.search(" ".join(a.get(k, "") for k in ("id", "class", "aria-label"))))


def content(root: Node) -> tuple[list[str], str]:
    """(paragraphs, loose text) outside chrome, in document order."""
    paragraphs, loose, stack = [], [], [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            loose.append(n)
        elif n.tag in SKIPPED or is_chrome(n):
            continue
        elif n.tag == "p":
            if said := text_of(n):
                paragraphs.append(said)
        elif n.tag in ("br", "hr"):
            loose.append(" ")
        else:
            stack.extend(reversed(n.children))
    return paragraphs, squeezed(" ".join(loose))


def metas(root: Node) -> tuple[dict[str, str], str | None, str]:
    """(first content by name or property, canonical address, title)."""
    found, canonical, title, stack = {}, None, "", [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            continue
        if n.tag == "meta":
            key, said = (n.attributes.get("name") or n.attributes.get("property") or "").strip().lower(), unicodedata.normalize("NFC", n.attributes.get("content", "")).strip()
            if key and said:
                found.setdefault(key, said)
        elif n.tag == "link" and canonical is None and "canonical" in n.attributes.get("rel", "").lower().split():
            canonical = n.attributes.get("href", "").strip() or None
        elif n.tag == "title" and not title:
            title = squeezed("".join(c for c in n.children if isinstance(c, str)))
        stack.extend(reversed(n.children))
    return found, canonical, title


def anchors(root: Node, marker: str = MARKER) -> list[tuple[str, str, bool]]:
    """(href, title, marked) in document order.

    A marker image arms the next anchor that is at least as deep; leaving the
    innermost table part or list item around the marker disarms it, as does an
    anchor above its depth.  Anchors without address count for nothing.
    """
    out, armed = [], None  # armed: (depth, scope) of a marker

    def walk(node: Node, depth: int, scope: int) -> None:
        nonlocal armed
        for n in node.children:
            if isinstance(n, str):
                continue
            if n.tag == "img" and re.sub(r"[?#].*$", "", n.attributes.get("src", "")).endswith(marker):
                armed = (depth, scope)
            elif n.tag == "a":
                href = n.attributes.get("href", "").strip()
                if href:
                    out.append((href, text_of(n), armed is not None and depth >= armed[0]))
                    armed = None
            else:
                inner = depth + 1 if n.tag in SCOPES else depth
                walk(n, inner, inner)
                if armed is not None and n.tag in SCOPES and armed[1] >= inner:
                    armed = None

    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 20_000))
    try:
        walk(root, 0, 0)
    finally:
        sys.setrecursionlimit(limit)
    return out


def page_anchors(pages: DataFrame, page_id: str = "page_id", html: str = "html", *keep: str, marker: str = MARKER) -> DataFrame:
    """(page id, columns in ``keep``, source_index, href, title, marked) of every anchor."""
    names = [page_id, *keep, "source_index", "href", "title", "marked"]

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, PAGES):
                part = batch.slice(lo, PAGES)
                out, source = [], []
                for row, h in enumerate(part.column(part.num_columns - 1)):
                    found = anchors(tree(h.as_py() or ""), marker)
                    out += [(k, *a) for k, a in enumerate(found)]
                    source += [row] * len(found)
                kinds = (pa.int32(), pa.string(), pa.string(), pa.bool_())
                own = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(source, pa.int64())) for c in part.columns[:-1]), *own], names)

    kept = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in (page_id, *keep))
    return pages.select(page_id, *keep, html).mapInArrow(rows, f"{kept}source_index int, href string, title string, marked boolean")


def parsed(pages: DataFrame, page_id: str = "page_id", html: str = "html", *keep: str, unclosed: bool = True) -> DataFrame:
    """(page id, columns in ``keep``, title, metas, canonical, paragraphs, loose) in one parse a page; repeated and null ids are answered each.

    References without their semicolon (``&amp`` before a tag) are read as HTML
    reads them, or left as they stand if not ``unclosed``.
    """
    names = [page_id, *keep, "title", "metas", "canonical", "paragraphs", "loose"]

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, PAGES):
                part = batch.slice(lo, PAGES)
                out = []
                for h in part.column(part.num_columns - 1):
                    page = h.as_py() or ""
                    root = tree(page if unclosed else closed_only(page))
                    found, canonical, title = metas(root)
                    out.append((title, list(found.items()), canonical, *content(root)))
                kinds = (pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.list_(pa.string()), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)

    kept = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in (page_id, *keep))
    return pages.select(page_id, *keep, html).mapInArrow(rows, f"{kept}title string, metas map<string,string>, canonical string, paragraphs array<string>, loose string")


def _lead(s: Column, marks: str) -> Column:
    return F.regexp_replace(s, rf"^[{re.escape(marks)}]+", "")


def first_paragraph(limits: Thresholds = Thresholds()) -> Column:
    """The first paragraph that says something; else sentences of the loose text past the page's title, promotion at its start left out."""
    least = limits.min_paragraph_chars
    good = F.filter("paragraphs", lambda p: (F.length(p) >= least) & ~t.is_promo(p))
    body = F.when((F.col("title") != "") & F.col("loose").startswith(F.col("title")), _lead(F.expr("substring(loose, length(title) + 1)"), " -|:")).otherwise(F.col("loose"))
    sentences = F.filter(F.transform(F.split(body, r"(?<=[.!?])\s+"), t.trimmed), lambda s: s != "")
    kept = F.aggregate(sentences, F.lit(""), lambda acc, s: F.when((F.length(acc) >= least) | ((acc == "") & t.is_promo(s)), acc).when(acc == "", s).otherwise(F.concat(acc, F.lit(" "), s)))
    # Nothing but promotion: what follows it, if it stands near the start.
    early = rf"(?is)^.{{0,39}}?{t.PROMO.removeprefix('(?i)')}(.*)$"
    behind = F.when(body.rlike(early), F.nullif(_lead(F.regexp_extract(body, early, 2), " .-|:"), F.lit("")))
    said = F.when(kept == "", body).otherwise(kept)
    said = F.when((F.length(kept) < least) & t.is_promo(said), F.coalesce(behind, body)).otherwise(said)
    return F.coalesce(F.get(good, 0), F.nullif(F.substring(said, 1, limits.max_scan_chars), F.lit("")))


def metadata(pages: DataFrame, policy: HostPolicy, limits: Thresholds = Thresholds(), page_id: str = "page_id", url: str = "url", html: str = "html", keep: tuple[str, ...] = (), unclosed: bool = True) -> DataFrame:
    """Metadata of each page: summary by precedence (meta, og, twitter, paragraph), hint, quality, image, keywords, canonical; and the columns in ``keep``.  ``unclosed`` is that of ``parsed``."""
    p = parsed(pages, page_id, html, url, *keep, unclosed=unclosed)
    meta = lambda k: F.nullif(t.normalized(F.try_element_at("metas", F.lit(k)), compose=False), F.lit(""))  # noqa: E731  composed by the parser
    named = {"meta_description": meta("description"), "og_description": meta("og:description"), "twitter_description": meta("twitter:description"), "content_paragraph": first_paragraph(limits)}
    cut = lambda c: F.nullif(t.truncated(c, limits.summary_chars), F.lit(""))
    p = p.withColumns({f"w_{k}": v for k, v in named.items()})
    p = p.withColumns({f"s_{k}": cut(F.col(f"w_{k}")) for k in named})
    summary = F.coalesce(*(F.col(f"s_{k}") for k in named))
    source = F.coalesce(*(F.when(F.col(f"s_{k}").isNotNull(), k) for k in named))
    score, flags = t.summary_quality(F.col("summary"))
    # The first of the two images decides, allowed or not.
    p = p.withColumn("i_page", urls.resolve(F.col(url), F.coalesce(meta("og:image"), meta("twitter:image"))))
    early = F.concat_ws(" ", F.slice("paragraphs", 1, 8), F.nullif("loose", F.lit("")))
    hint = t.published_hint(early, *(F.col(f"w_{k}") for k in ("content_paragraph", "meta_description", "og_description")), within=limits.hint_chars)
    out = p.withColumns({"summary": summary, "summary_source": source, "hint": hint})
    return out.select(
        page_id, *keep, cut(F.nullif(F.col("title"), F.lit(""))).alias("page_title"), F.col("s_meta_description").alias("meta_description"), cut(meta("og:title")).alias("og_title"), F.col("s_og_description").alias("og_description"),
        urls.resolve(F.col(url), F.col("canonical")).alias("canonical_url"), F.col("hint").alias("published_hint"), "summary", "summary_source", score.alias("quality_score"), flags.alias("quality_flags"),
        urls.image_or_null(F.col("i_page"), policy).alias("image_url"), F.coalesce(meta("keywords"), meta("news_keywords")).alias("keywords"),
    )
