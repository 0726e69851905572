"""Main text of web pages, without the subtrees that a site repeats across its pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import settle, ship_package

#: A subtree outside article and main is a template of its host if it stands on at least LEAST_PAGES
#: pages with different main texts, and on LEAST_SHARE of the host's pages.
LEAST_PAGES, LEAST_SHARE = 4, 0.05
#: Template tables are broadcast up to so many bytes, counted before; beyond that pages are shuffled.
BROADCAST_BYTES = 16 << 20

_LOOSE = r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
_TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|" + _LOOSE, re.S)
#: The same without quoted attributes.
_PLAIN = re.compile("()()()" + _LOOSE, re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Subtree hashes grow by one item at a time, modulo 2^64, with this odd factor.
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split())
#: Closed by a block that begins inside them.
_LINES = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Closed by the next of their kind.
_ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that do not belong to an article.
_OUTSIDE = frozenset(
    "nav header footer aside form noscript template button select datalist fieldset svg canvas object audio video dialog menu head script style "
    "textarea title iframe noembed noframes xmp".split())
#: Classes, ids and roles of such elements, alone or put together of several (cookie-notice).
_OUTSIDE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer contentinfo sidebar aside complementary widget ad ads adbox advert adverts "
    "advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription signup login search social share sharing related recommended recommendations comment comments disqus respond reply "
    "replies pagination pager toolbar".split())
#: Elements of this kind that may wrap a whole page by mistake; an article in them counts, as it does
#: in elements that are outside only by their names.
_WRAPPERS = frozenset("nav header form fieldset".split())
#: Elements whose subtrees are looked for across pages.
_SUBTREES = frozenset("div section nav header footer aside form ul ol dl table menu figure details".split())


#: How an element is outside: not by itself; as a wrapper or by name, but an article in it counts; whatever it holds.
_IN, _WRAPS, _SHUT = 0, 1, 2
#: Where a block stands: in the body, a main element, an article that is a guest there, an article.
_BODY, _MAIN, _GUEST, _ARTICLE = 0, 1, 2, 3


def _outside(tag: str, attributes: str, in_main: bool) -> int:
    if tag == "header" and in_main:
        return _IN
    if tag in _OUTSIDE:
        return _WRAPS if tag in _WRAPPERS else _SHUT
    if not attributes or tag in ("html", "body", "main"):
        return _IN
    if _HIDDEN.search(attributes):
        return _SHUT
    names = [name for found in _NAMES.findall(attributes) for name in unescape("".join(found)).split()]
    return _WRAPS if any(_named_outside(name) for name in names) else _IN


def _named_outside(name: str) -> bool:
    words = [w.lower() for w in _WORDS.findall(name)]
    return bool(words) and _OUTSIDE_NAMES.issuperset(words)


class _Open:
    """An open element. `shut` and `wrapped` sum up its ancestors and itself: whether one is outside whatever
    it holds, and whether all outermost ones that are outside are wrappers. `mark` hashes what it has held so far."""

    __slots__ = ("tag", "outside", "main", "first", "holds_main", "shut", "wrapped", "mark")

    def __init__(self, tag: str, own: int, outside: bool, main: int, first: int, above: _Open | None):
        self.tag, self.outside, self.main, self.first, self.holds_main, self.mark = tag, outside, main, first, False, 0
        self.shut = own == _SHUT or bool(above and above.shut)
        begins = outside and not (above and above.outside)
        self.wrapped = (not begins or tag in _WRAPPERS) and (above is None or above.wrapped)

    def take(self, item: int) -> None:
        self.mark = (self.mark * _FACTOR + item) & _MASK


class _Stack:
    """Open elements, with the places of each tag and of those that hold back an end tag or a new block."""

    def __init__(self):
        self.nodes: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.walls: list[int] = []

    @property
    def top(self) -> _Open | None:
        return self.nodes[-1] if self.nodes else None

    def push(self, node: _Open) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag not in _INLINE:
            self.blocks.append(at)
            if node.tag not in _LINES:
                self.walls.append(at)

    def pop(self) -> _Open:
        node = self.nodes.pop()
        self.places[node.tag].pop()
        for places in (self.blocks, self.walls):
            if places and places[-1] == len(self.nodes):
                places.pop()
        return node

    def ended_by(self, tag: str) -> int | None:
        """Place of the element that an end tag ends: inline ones only within their block, lines within what holds them."""
        at = self.places.get(tag)
        if not at:
            return None
        held_by = self.blocks if tag in _INLINE else self.walls if tag in _LINES else []
        return at[-1] if not held_by or at[-1] >= held_by[-1] else None


def read_page(html: str, templates: frozenset[int] = frozenset()) -> tuple[str, list[int]]:
    """Main text of a page, without the subtrees in `templates`, and the hashes of its subtrees.

    Subtrees that hold an article or main, or stand in one, are not templates and have no hash. Text is that
    of the article or main element if the page has one, else of the body. An article in a part of
    another that is outside it, such as its comments, counts only if the page has no other; blocks are
    parted by \n. Unclosed and misnested elements are closed as their next block or parent ends. The time
    is in proportion to the length of a page, whatever it holds: each token is read once, an
    element's hash is made of those of its children, and once a page is found to have an unclosed
    quote, the rest of it is read without looking for the ends of quotes.
    """
    blocks: list[tuple[int, str]] = []
    piece: list[str] = []
    stack = _Stack()
    hashes: list[int] = []

    def flush(outside: bool, main: int) -> None:
        if piece:
            if not outside:
                text = " ".join(unescape("".join(piece)).split())
                if text:
                    blocks.append((main, text))
            piece.clear()

    def close(depth: int) -> None:
        while len(stack.nodes) > depth:
            node = stack.pop()
            if node.tag not in _INLINE:
                flush(node.outside, node.main)
            mark = xxhash.xxh3_64_intdigest(f"{node.tag} {node.mark}")
            above = stack.top
            if above:
                above.take(mark)
                above.holds_main |= node.holds_main
            if node.tag in _SUBTREES and not node.holds_main and not node.main:
                hashes.append(mark - (1 << 63))
                if hashes[-1] in templates:
                    del blocks[node.first:]

    pos, size, last, token = 0, len(html), html.rfind(">"), _TOKEN
    while pos < size:
        found = token.search(html, pos) if pos <= last or html.find("<!--", pos) >= 0 else None
        start = found.start() if found else size
        top = stack.top
        if start > pos and not (top and top.outside):
            text = html[pos:start]
            piece.append(text)
            if top and not text.isspace():
                top.take(xxhash.xxh3_64_intdigest(" ".join(text.split())))
        if not found:
            break
        pos = found.end()
        if found[5] and ('"' in found[6] or "'" in found[6]):
            token = _PLAIN
        ends, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        outside, main = (top.outside, top.main) if top else (False, _BODY)
        if ends:
            if tag not in _INLINE:
                flush(outside, main)
            depth = stack.ended_by(tag)
            if depth is not None:
                close(depth)
            continue
        if tag == "br" or tag in _VOID and tag not in _INLINE:
            if tag == "br":
                piece.append(" ")
            continue
        if tag in _VOID:
            continue
        if tag not in _INLINE:
            flush(outside, main)
            for depth in reversed(stack.blocks):
                kind = stack.nodes[depth].tag
                if kind in _LINES or kind in _ITEMS.get(tag, ()):
                    close(depth)
                    if kind not in _LINES:
                        break
                elif not (tag in _ITEMS and kind in ("tr", "td", "th", "li", "dt", "dd")):
                    break
            top = stack.top
            outside, main = (top.outside, top.main) if top else (False, _BODY)
        own = _outside(tag, attributes, bool(main))
        is_main = tag in ("article", "main") and not own
        if is_main:
            guest = False
            if outside and top.wrapped:
                outside = False
            elif outside and not top.shut:
                outside, guest = False, bool(main)
            if not outside:
                if guest or main == _GUEST:
                    main = _GUEST
                else:
                    main = _ARTICLE if tag == "article" or main == _ARTICLE else _MAIN
                if top:
                    top.holds_main = True
        outside = outside or own != _IN
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, pos)
            pos = end.end() if end else size
            continue
        if not attributes.endswith("/") or tag not in ("svg", "path", "use", "circle", "rect"):
            stack.push(_Open(tag, own, outside, main, len(blocks), top))
    close(0)
    flush(False, _BODY)
    places = {m for m, _ in blocks}
    counted = {_MAIN, _ARTICLE} if _ARTICLE in places else places - {_BODY} or places
    return "\n".join(t for m, t in blocks if m in counted), hashes


def host_of(url: Column) -> Column:
    """Host of a url, ASCII letters lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> (host, subtree, page): the different subtrees of a page and a hash of its text."""
    for batch in batches:
        hosts, subtrees, pages = [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            text, found = read_page(html.as_py())
            page = xxhash.xxh3_64_intdigest(text) - (1 << 63)
            unique = set(found) | {0}
            hosts += [host] * len(unique)
            subtrees += unique
            pages += [page] * len(unique)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(subtrees, pa.int64()), pa.array(pages, pa.int64())], names=["host", "subtree", "page"])


def templates(pages: DataFrame) -> DataFrame:
    """host, marks: the subtrees that recur across many pages of each host, from all pages.

    pages: host, html. Pages with the same main text count once, so copies make no templates. The
    mark 0 stands for the host itself and gives its number of pages.
    """
    seen = pages.mapInArrow(_subtrees, "host string, subtree long, page long").distinct()
    counts = settle(seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(f"n >= {LEAST_PAGES}"), "subtrees")
    sizes = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    many = counts.where("subtree <> 0").join(sizes, "host").where(F.col("n") >= LEAST_SHARE * F.col("pages"))
    return many.groupBy("host").agg(F.sort_array(F.collect_set("subtree")).alias("marks"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    A null html is empty; a page without main text has an empty text. Character references are
    decoded, white space inside a block becomes one space. Pages without a host share the empty
    one. Other columns are ignored; repeated rows are extracted each.
    """
    ship_package(spark)
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    marks = settle(templates(rows.select("host", "html")), "templates")
    size = marks.agg(F.sum(F.octet_length("host") + 8 * F.size("marks") + 32)).first()[0] or 0
    marks = F.broadcast(marks) if size <= BROADCAST_BYTES else marks

    @F.arrow_udf("string")
    def main_text(html: pa.Array, known: pa.Array) -> pa.Array:
        last, held, out = None, frozenset(), []
        for page, own in zip(html, known):
            own = own.as_py()
            if own != last:
                last, held = own, frozenset(own or ())
            out.append(read_page(page.as_py(), held)[0])
        return pa.array(out, pa.string())

    text = main_text("html", "marks").alias("text")
    return rows.join(marks, "host", "left").select("page_id", "url", text).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
