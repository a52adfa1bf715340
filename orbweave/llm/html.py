"""Main text of web pages: their articles without what each host's suffix array finds repeated.

A page's HTML is read once into blocks. Dropped outright are scripts, styles,
forms, comments of the markup, and elements whose tag, role, class or id (whole
class names, and ids of boxes only) names a menu, page header or footer,
sidebar, notice, advert, form or comment section; words that also name parts of
an article, such as header or related, count outside of it only. An element
around the page's article is never dropped. If the page marks its article (``article``, ``main``, ``role=main``,
``itemprop=articleBody``) and there is text in it, the text is that article's
blocks, all of them; where an article lies inside a main part, all blocks of
both in page order; where an article lies beside it, the article's.

Otherwise the text is the blocks that are left ("loose").

On both, what repeats on the host decides then, by its suffix array: the token streams of all
blocks of the host's pages (dropped ones too) are put one after another, their suffixes
named by prefix doubling and sorted, and neighbours that share ``DEPTH`` tokens (a shorter block
as a whole) counted by the distinct pages they come from. Longer repeats are runs of such
places, so their places cover what longer repeats cover. A repeat counts from ``PAGES`` pages on that are the part
``SHARE`` of the host's; against a block of a marked article, which is
evidence for it, from ``ALWAYS_PAGES`` pages on that are the part ``ALWAYS``, and not by short blocks
(a title may be the name of a menu's item). Where repeats cover half of a block's
tokens or more, they are cut out of it and its own runs stay; other blocks are kept whole.
Pages with the same content (see ``_content``) are one, so copies under several urls
are no evidence against their text.

How it runs: streams (4 bytes a token) are dealt by host, a host with many pages by
parts of them (each a 32nd of all pages, but 500 to 10,000), and sorted in parts of at most about ``PIECE_TOKENS`` tokens. What is on enough
pages of a host in parts is so on those of one part at least; those candidates
are counted again on all its pages. A host's repeats are few (see ``repeats``) and joined to its pages.

Defined results: null or empty html gives an empty text; a page without a host
is judged among the pages without one; repeated rows and copies of a page count as one
page; rows keep a null ``page_id`` or ``url``; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import cut
from orbweave.llm.tokens import blocks, mix

#: Tokens that a repeated substring has at least; a shorter block counts as a whole.
DEPTH = 6
#: Part of a block's tokens that repeated substrings cover at least if it is boilerplate.
COVERED = 0.5
#: A repeated substring is on so many pages of its host at least (or on all, if there are fewer), and on this part of them.
PAGES, SHARE = 3, 0.2
#: The same for a block of a marked article.
ALWAYS_PAGES, ALWAYS = 5, 0.5
#: Pages of a host that are dealt together: a part of all pages, within these bounds; and tokens of a suffix array, about.
PIECE_PART, PIECE_LEAST, PIECE_MOST = 32, 500, 10_000
PIECE_TOKENS = 4 << 20
#: Streams a task remembers at most, to send each once.
REMEMBERED = 1 << 20
#: Entries of 8 bytes, and a host for some of them, that are broadcast at most.
BROADCAST = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Tokens of a paragraph at least, and of a run of its own that a covered block keeps (one token is a year or a number in a line that repeats).
PARAGRAPH, OWN = 12, 2

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S)
ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg", "canvas", "object", "fieldset", "datalist", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Parts of a class, id or role that name something other than the main text.
OTHER = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "sidebar", "aside", "complementary",
         "banner", "contentinfo", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "ad", "ads", "advert", "advertisement", "adsense", "sponsor",
         "sponsored", "promo", "promotion", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login",
         "popup", "modal", "overlay", "search", "form", "comment", "comments", "commentlist", "respond", "replies", "disqus", "pagination", "pager", "toolbar", "widget"}
#: Of these, the words that also name parts of an article (its header, a section on related work): dropped outside of it only.
OUTSIDE = {"header", "masthead", "banner", "notice", "alert", "search", "related", "recommended", "social", "form", "sponsor", "sponsored", "promo", "promotion",
           "consent", "subscription", "signup", "login", "overlay", "complementary"}
#: In an article, inline elements with one of the others keep their text too (a comment in code, a name of a menu).
INLINE_KEPT = {"menu", "comment", "comments", "respond", "replies", "widget", "modal", "popup", "toolbar", "navigation", "sidebar", "aside", "pager"}
#: What a class or id may hold beside them and still name the same thing ("share-box", "site-header"; not "has-sidebar", "ad-free", "entry-header").
BESIDE = {"box", "bar", "container", "wrapper", "wrap", "block", "area", "list", "links", "link", "buttons", "button", "btn", "panel", "inner", "outer", "module", "region", "unit",
          "slot", "items", "item", "site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "mobile", "desktop", "div", "footer", "head"}
#: An id counts on these only: elsewhere it is the target of a link.
BOXES = {"div", "ul", "ol", "dl", "table", "header", "center", "article"}
#: Dropped elements that may stand around a whole page, and comment sections, which are no wrappers of an article.
WRAPS = {"form", "fieldset"}
COMMENTS = {"comment", "comments", "commentlist", "respond", "replies", "disqus"}
#: Boxes of reader comments, and what their class or id may hold beside ("post-comments", "reader_comments").
COMMENT_BOXES = {"div", "section", "ul", "ol", "dl", "aside", "article", "table"}
COMMENTERS = {"post", "posts", "user", "users", "reader", "readers", "visitor", "visitors", "guest", "member", "public", "customer", "article", "entry", "story", "blog", "news",
              "section", "thread", "threads", "stream", "feed", "body", "content", "template", "count", "all", "recent", "latest", "new", "view", "fb", "facebook", "wp"}
#: Inline elements with one of these go from within a sentence too.
ADVERTS = {"ad", "ads", "advert", "advertisement", "adsense", "sponsored", "cookie", "cookies", "gdpr", "breadcrumb", "breadcrumbs"}
PARTS = re.compile(r"[A-Za-z]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
#: Table parts and list items, whose end tags may be left out, with what each ends where it begins.
CELLS = frozenset({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup", "table"})
ITEMS = frozenset({"li", "dt", "dd"})
_ROW = frozenset({"td", "th", "tr", "caption", "colgroup"})
ENDS = {"li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
        "tr": _ROW, **dict.fromkeys(("tbody", "thead", "tfoot"), _ROW | {"tbody", "thead", "tfoot"})}
#: Elements that tags inside them don't reach beyond: table parts, list items, and all others.
TABLE = frozenset({"table"})
SCOPE = frozenset({"table", "td", "th", "caption", "object"})
LISTS = SCOPE | {"ul", "ol", "dl", "menu", "dir", "section", "article", "main", "aside", "nav", "header", "footer", "blockquote", "figure", "form", "fieldset"}
#: Without one of these, nothing in a page marks its article.
MARKED = re.compile(r"""<(?:article|main)[\s>/]|role\s*=\s*["']?main|itemprop\s*=\s*["']?articleBody""", re.I)


def _attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)} if attrs.strip("/ \n\t") else {}


def _other(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is something other than the main text; ``inside`` a marked article less is."""
    if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if tag in ("body", "html", "main", "article") and attrs.get("role", "").lower() in ("", "main", "article"):
        return tag == "article" and bool({"comment", "comments", "ad", "advert", "related", "promo"} & _roles(tag, attrs))
    roles = _roles(tag, attrs)
    if inside:
        roles -= OUTSIDE
        if tag in INLINE:
            roles -= INLINE_KEPT
    return bool(roles)


def _roles(tag: str, attrs: dict[str, str]) -> set[str]:
    """The words of ``OTHER`` that an element's class, role or id names as a whole."""
    out: set[str] = set()
    for key in ("class", "role", "id") if tag in BOXES else ("class", "role"):
        for token in attrs.get(key, "").lower().split():
            parts = set(PARTS.findall(token))
            if parts & OTHER and parts <= OTHER | BESIDE:
                out |= parts & OTHER
            elif tag in COMMENT_BOXES and parts & COMMENTS and parts <= COMMENTS | COMMENTERS | BESIDE:
                out |= parts & COMMENTS
    return out


def _zone(tag: str, attrs: dict[str, str]) -> str:
    """The zone that an element opens, if any."""
    if tag == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        return "article"
    return "main" if tag == "main" or attrs.get("role", "").lower() == "main" else ""


def _around_articles(html: str) -> set[int]:
    """Where the wrappers begin (any element but menus, asides, footers and comment sections) that hold an article or main part."""
    out: set[int] = set()
    stack: list[tuple[str, int, bool]] = []  # tag, begin, whether it may be a wrapper
    opened: Counter[str] = Counter()
    at = 0
    while m := MARKUP.search(html, at):
        at = m.end()
        tag = (m["tag"] or "").lower()
        if tag in RAW and not m["close"]:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        if not tag or tag in RAW or tag in VOID or tag in INLINE:
            continue
        if m["close"]:
            while opened[tag]:
                t, _, _ = stack.pop()
                opened[t] -= 1
                if t == tag:
                    break
            continue
        attrs = _attributes(m["attrs"])
        wraps = (tag not in DROPPED or tag in WRAPS) and "hidden" not in attrs and not COMMENTS & _roles(tag, attrs)
        marks = bool(_zone(tag, attrs)) and wraps and not (tag == "article" and _other(tag, attrs, False))
        stack.append((tag, m.start(), wraps and (not stack or stack[-1][2])))
        opened[tag] += 1
        if marks and stack[-1][2]:
            for _, begin, _ in reversed(stack):
                if begin in out:
                    break  # so are those around it
                out.add(begin)
    return out


class _Page:
    """Blocks of a page: of its articles, of its main parts, loose ones, and dropped ones.

    Elements whose end tag may be left out end where HTML ends them (``li`` at
    the next one of its list, a cell at the next cell or row, ``p`` at a block),
    and an end tag ends what stands open inside its element, so that what is
    dropped never goes beyond its parent.
    """

    def __init__(self, html: str, around: frozenset[int] | set[int] = frozenset()):
        """``around``: where elements begin that are not skipped, since they hold an article."""
        self.zones: dict[str, list[str]] = {"article": [], "main": [], "loose": [], "dropped": []}
        self.parts: list[str] = []
        self.marked: list[tuple[str, str]] = []  # (zone, block) of both marked zones in page order
        self.open_zone = {"article": 0, "main": 0, "dropped": 0}
        self.stack: list[tuple[str, str, list[str] | None]] = []  # tag, zone that it opens, text before a dropped inline element
        self.where: dict[str, list[int]] = {}  # a tag's places in the stack
        nested = False
        at = 0
        while m := MARKUP.search(html, at):
            self.parts.append(html[at:m.start()])
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            closing = bool(m["close"])
            if tag in RAW:
                if not closing:
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                    at = end.end() if end else len(html)
                continue
            if tag == "br":
                self.parts.append(" ")
                continue
            if tag in INLINE:
                if closing:
                    self._end(tag)
                elif tag not in VOID:
                    self._inline(tag, m["attrs"])
                continue
            self._flush()
            if closing:
                self._end(tag)
                continue
            if tag in VOID and tag != "hr":
                continue
            self._implied(tag)
            if tag in VOID:
                continue
            name = ""
            if not self.open_zone["dropped"]:
                attrs = _attributes(m["attrs"])
                inside = bool(self.open_zone["article"] or self.open_zone["main"])
                if (_other(tag, attrs, inside) or tag == "header" and not inside) and m.start() not in around:
                    name = "dropped"
                else:
                    name = _zone(tag, attrs)
                    nested = nested or name == "article" and bool(self.open_zone["main"]) and not self.open_zone["article"]
            self._push(tag, name)
        self.parts.append(html[at:])
        self._pop(0)
        self._flush()
        if nested and self.zones["main"]:  # the main part as a whole, its articles included
            self.zones["article"], self.zones["main"] = [], [block for _, block in self.marked]

    def _inline(self, tag: str, attrs: str) -> None:
        """A dropped inline element is taken out of its block, which goes on after it; others are no elements here."""
        if self.open_zone["dropped"]:
            if self.where.get(tag):
                self._push(tag, "")
            return
        read = _attributes(attrs) if attrs else {}
        inside = bool(self.open_zone["article"] or self.open_zone["main"])
        if read and _other(tag, read, inside):
            # Inside of an article, a link with such a class within a sentence is a part of it.
            if inside and not ADVERTS & _roles(tag, read) and _roles(tag, read) and any(p.strip() for p in self.parts):
                return
            held, self.parts = self.parts, []
            self._push(tag, "dropped", held)

    def _push(self, tag: str, zone: str, held: list[str] | None = None) -> None:
        self.where.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, zone, held))
        if zone:
            self.open_zone[zone] += 1

    def _pop(self, to: int) -> None:
        """Ends the open elements from place ``to`` of the stack on."""
        while len(self.stack) > to:
            tag, zone, held = self.stack.pop()
            self.where[tag].pop()
            if tag not in INLINE or held is not None:
                self._flush()  # under the zones that are still open
            if zone:
                self.open_zone[zone] -= 1
            if held is not None:
                self.parts = held

    def _nearest(self, tags: frozenset[str]) -> int:
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=-1)

    def _end(self, tag: str) -> None:
        """An end tag: nothing if its element isn't open within the same list or table cell."""
        if places := self.where.get(tag):
            at = places[-1]
            if at == len(self.stack) - 1 or at >= self._nearest(TABLE if tag in CELLS else LISTS if tag in ITEMS else SCOPE):
                self._pop(at)

    def _implied(self, tag: str) -> None:
        """Ends what the begin of a block ends: a paragraph, and the list item or table part before."""
        if (places := self.where.get("p")) and (places[-1] == len(self.stack) - 1 or places[-1] > self._nearest(SCOPE)):
            self._pop(places[-1])
        if ends := ENDS.get(tag):
            limit = self._nearest(TABLE if tag in CELLS else LISTS)
            places = [i for t in ends for i in self.where.get(t, ())[-1:] if i > limit]
            if places:
                self._pop(min(places))

    def _flush(self) -> None:
        zones = self.open_zone
        zone = "dropped" if zones["dropped"] else "article" if zones["article"] else "main" if zones["main"] else "loose"
        if text := " ".join(unescape("".join(self.parts)).split()):
            self.zones[zone].append(text)
            if zone in ("article", "main"):
                self.marked.append((zone, text))
        self.parts = []


def page_blocks(html: str | None) -> dict[str, list[str]]:
    """Blocks of a page by zone, each with its white space turned into single spaces."""
    if not html:
        return {"article": [], "main": [], "loose": [], "dropped": []}
    zones = _Page(html).zones
    if not (zones["article"] or zones["main"]) and zones["dropped"] and MARKED.search(html) and (around := _around_articles(html)):
        wrapped = _Page(html, around).zones
        # A teaser in a sidebar is not the page's article.
        if _chars(wrapped["article"]) + _chars(wrapped["main"]) > _chars(zones["loose"]):
            return wrapped
    return zones


def _chars(texts: list[str]) -> int:
    return sum(map(len, texts))


def _content(zones: dict[str, list[str]]) -> int:
    """What tells a page from others: its paragraphs if they are most of its text, so that a print view or a copy under another url is the same page."""
    blocks = [b for zone in ("article", "main", "loose") for b in zones[zone]] or zones["dropped"]
    long = [b for b in blocks if b.count(" ") + 1 >= PARAGRAPH]
    own = long if 2 * _chars(long) >= _chars(blocks) else blocks
    return int.from_bytes(hashlib.blake2b("\n".join(own).encode(errors="replace"), digest_size=8).digest(), "big", signed=True)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(token of each word: 32 bits of its hash, not 0; words of each text)."""
    parts = list(blocks(pa.array(texts, pa.string())))
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.maximum(np.concatenate([b.hash for b in parts]) >> np.uint64(32), 1).astype(np.uint32), np.concatenate([b.count for b in parts])


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, stream) of the pages: all blocks' tokens, a 0 after each block. A task sends a stream of a page once."""
    sent: set[tuple[str, int, bytes]] = set()
    for batch in batches:
        hosts, pages, streams = [], [], []
        for host, html in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
            zones = page_blocks(html)
            if texts := [b for zone in zones.values() for b in zone]:
                tokens, count = _words(texts)
                stream = np.insert(tokens, np.cumsum(count), 0).tobytes()
                key = host, _content(zones), hashlib.blake2b(stream, digest_size=8).digest()
                if key not in sent:
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(key)
                    hosts.append(host)
                    pages.append(key[1])
                    streams.append(stream)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(streams, pa.binary())], names=["host", "page", "stream"])


def prefix_names(tokens: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The 64-bit name of the first ``depth`` tokens of each suffix, by prefix doubling.

    Names of 2k tokens follow from those of k tokens at a place and k places on.
    A suffix ends with its block, ``left`` tokens on.
    """
    def ahead(names: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(names)
        out[:-k] = names[k:]
        out[left <= k] = 0
        return out

    names, width, out, at = mix(tokens), 1, None, 0
    while depth:
        if depth & 1:
            out = names if out is None else mix(out * _STEP + ahead(names, at))
            at += width
        if depth := depth >> 1:
            names = mix(names * _STEP + ahead(names, width))
            width *= 2
    return out


def _suffixes(stream: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, names) of a stream's suffixes that have ``depth`` tokens (even names), or are a whole shorter block (odd ones)."""
    end = np.flatnonzero(stream == 0)
    left = np.repeat(end, np.diff(end, prepend=-1)) - np.arange(stream.size)
    start = np.append(True, stream[:-1] == 0)
    names = prefix_names(stream, left, depth)
    at = np.flatnonzero((left >= depth) | (left > 0) & start)
    return at, (names[at] & ~np.uint64(1) | (left[at] < depth).astype(np.uint64)).view(np.int64)


def _sorted_suffixes(streams: list[bytes], pages: list[int], depth: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(pages, names, pages of each name) of a host's suffix array: suffixes in the order of their names, neighbours that share ``depth`` tokens together."""
    stream = np.frombuffer(b"".join(streams), np.uint32)
    at, names = _suffixes(stream, depth)
    distinct, page = np.unique(np.array(pages, np.int64), return_inverse=True)
    page = np.repeat(page, [len(x) // 4 for x in streams])[at]
    order = np.lexsort((page, names))
    names, page = names[order], page[order]
    new = np.append(True, names[1:] != names[:-1]) if names.size else np.zeros(0, bool)
    own = new.copy()
    own[1:] |= page[1:] != page[:-1]
    begin = np.flatnonzero(new)
    return distinct.size, names[begin], np.add.reduceat(own.astype(np.int64), begin) if begin.size else begin


def _host_repeats(depth: int, least: int, share: float, limit: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What repeats on each host, of streams in the order of hosts and pages.

        Of a host in several parts: what is on the part ``share`` of a part's pages; what is on that part of all its pages is so in one of its parts.
        """
        host, split, size = None, False, 0
        pages: list[int] = []
        streams: list[bytes] = []

        def found() -> pa.RecordBatch:
            n, names, count = _sorted_suffixes(streams, pages, depth)
            ok = count >= max(1, math.ceil(share * n)) if split else count >= max(2, min(least, n), math.ceil(share * n))
            return pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([split]), pa.array([n], pa.int64()), pa.array([names[ok]], pa.list_(pa.int64())), pa.array([count[ok]], pa.list_(pa.int64()))],
                                              names=["host", "split", "pages", "names", "n"])

        for batch in batches:
            for h, page, pieces, stream in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "pieces", "stream")), strict=True):
                full = h == host and size >= limit and page != pages[-1]
                if streams and (full or h != host):
                    split = split or full
                    yield found()
                    pages, streams, size = [], [], 0
                if h != host:
                    host, split = h, pieces > 1
                pages.append(page)
                streams.append(stream)
                size += len(stream) // 4
        if streams:
            yield found()

    return run


def _page_names(depth: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [np.unique(_suffixes(np.frombuffer(x, np.uint32), depth)[1]) for x in batch.column("stream").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(names, pa.list_(pa.int64()))], names=["host", "page", "names"])

    return run


def _rows(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", HOST, 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.withColumn("host", F.coalesce(host, F.lit("")))


def _small(found: DataFrame, size: Column) -> DataFrame:
    """``found``, to be broadcast if it has at most ``BROADCAST`` entries."""
    n = found.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(found) if n <= BROADCAST else found


def repeats(pages: DataFrame, depth: int = DEPTH, least: int = PAGES, share: float = SHARE, piece_pages: int | None = None, limit: int = PIECE_TOKENS) -> DataFrame:
    """(``host``, ``pages``, ``found``: array of (``name``, ``n``)): the prefixes of ``depth`` tokens that ``n`` of a host's distinct pages share.

    So many are ``least`` (all of the host's pages, if there are fewer, but two) and the part ``share`` of them at
    least; so a host has at most (tokens of its mean page) / ``share`` of them.
    """
    rows = _rows(pages)
    sizes = cut(rows.groupBy("host").agg(F.count("*").alias("rows")))
    if piece_pages is None:
        piece_pages = min(PIECE_MOST, max(PIECE_LEAST, sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] // PIECE_PART))
    large = sizes.select("host", F.ceil(F.col("rows") / piece_pages).cast("int").alias("pieces")).where("pieces > 1")
    streams = rows.select("host", "html").mapInArrow(_streams, "host string, page long, stream binary")
    dealt = (streams.join(_small(large, F.lit(1)), "host", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
             .withColumn("piece", F.pmod("page", F.col("pieces"))).repartition("host", "piece").sortWithinPartitions("host", "piece", "page"))
    found = cut(dealt.select("host", "page", "pieces", "stream").mapInArrow(_host_repeats(depth, least, share, limit), "host string, split boolean, pages long, names array<long>, n array<long>"))
    whole = found.where("not split").select("host", "pages", F.arrays_zip(F.col("names").alias("name"), "n").alias("found"))
    parts = found.where("split")
    if not parts.limit(1).count():
        return whole
    # Hosts in parts: what is often in one part is counted on all the host's pages.
    asked = cut(parts.select("host", F.explode("names").alias("name")).distinct())
    hosts = cut(parts.select("host").distinct())
    own = rows.join(_small(hosts, F.lit(1)), "host", "left_semi").select("host", "html").mapInArrow(_streams, "host string, page long, stream binary")
    own = cut(own.mapInArrow(_page_names(depth), "host string, page long, names array<long>")
              .select("host", "page", F.explode("names").alias("name")).join(_small(asked, F.lit(1)), ["host", "name"], "left_semi").distinct())
    total = own.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    wanted = F.greatest(F.lit(2), F.least(F.lit(least), F.col("pages")), F.ceil(F.lit(share) * F.col("pages")))
    counted = (own.groupBy("host", "name").agg(F.count("*").alias("n")).join(total, "host").where(F.col("n") >= wanted)
               .groupBy("host", "pages").agg(F.collect_list(F.struct("name", "n")).alias("found")))
    return whole.unionByName(counted)


def _uncovered(block: str, hit: np.ndarray, depth: int, covered: float) -> str:
    """The block, or if the runs of ``depth`` tokens from the places ``hit`` on cover enough of it, its runs of ``OWN`` tokens or more that they don't."""
    tokens = block.split(" ")
    edge = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, np.minimum(hit + depth, len(tokens)), -1)
    free = np.cumsum(edge[:-1]) == 0
    if len(tokens) - free.sum() < covered * len(tokens):
        return block
    bounds = np.flatnonzero(np.diff(np.concatenate([[0], free, [0]]).astype(np.int8)))
    return " ".join(t for a, b in zip(bounds[::2], bounds[1::2], strict=True) if b - a >= OWN for t in tokens[a:b])


def kept_blocks(texts: list[str], names: np.ndarray, depth: int = DEPTH, covered: float = COVERED) -> list[str]:
    """What is left of a page's blocks without what repeats (``names``, sorted) on its host."""
    if not names.size or not texts:
        return texts
    tokens, count = _words(texts)
    at, own = _suffixes(np.insert(tokens, np.cumsum(count), 0), depth)
    at = at[names[np.searchsorted(names, own).clip(0, names.size - 1)] == own]
    if not at.size:
        return texts
    first = np.cumsum(count + 1) - count - 1
    block = np.searchsorted(first, at, side="right") - 1
    out = list(texts)
    for b in np.unique(block):
        out[b] = _uncovered(texts[b], at[block == b] - first[b], depth, covered)
    return [t for t in out if t]


def _texts(depth: int, covered: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, often, always in zip(*(batch.column(c) for c in ("html", "often", "always")), strict=True):
                zones = page_blocks(html.as_py())
                marked = zones["article"] or zones["main"]
                names = np.sort(np.array((always if marked else often).as_py() or [], np.int64))
                texts.append("\n\n".join(kept_blocks(marked or zones["loose"], names, depth, covered)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def extract(pages: DataFrame, depth: int = DEPTH, covered: float = COVERED, **more) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text`` (blocks joined by an empty line), ``n_chars``; ``more`` goes to ``repeats``."""
    always = F.greatest(F.lit(ALWAYS_PAGES), F.ceil(F.lit(ALWAYS) * F.col("pages")))
    listed = cut(repeats(pages, depth, **more).select("host", F.col("found")["name"].alias("often"), F.filter("found", lambda f: (f["n"] >= always) & (f["name"] % 2 == 0))["name"].alias("always")))
    rows = _rows(pages).join(_small(listed, F.size("often")), "host", "left").select("page_id", "url", "html", "often", "always")
    return (rows.mapInArrow(_texts(depth, covered), "page_id long, url string, text string")
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
