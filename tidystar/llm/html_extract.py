"""Main text of web pages by consensus of the pages of a host.

1. Every page is parsed (narrow pass) and its containers are scored by the text
   of their blocks outside boilerplate and links; the best container, widened to
   the containers around it that add text outside links (``Page.whole``), votes,
   with its text length, for its generalised path (tags and classes from ``body``
   down, runs of digits as ``0``). A page that is nearly all links does not vote.
2. Spark sums the votes per host and path; the path with most votes wins its host.
3. Pages are parsed again and give the text of the elements on the winning path,
   widened in the same way; a page without such an element gives its own best
   container, and one without that all its blocks.

Votes are partial sums before the shuffle, so a hot host costs one row per path
and task. Winning paths meet the pages in a broadcast join only if their
measured size is at most ``BROADCAST_BYTES``, else in Spark's adaptive join.

A block is the text between two block-level boundaries: character references
decoded, white space runs one space, trimmed; blocks join by a blank line.

Left out: menus, headers, footers, sidebars, notices, adverts, forms and comments,
by tag, role or a class or id that says nothing else (all its words name furniture or
where it stands), and what is not shown (scripts, styles, drawings, hidden elements).
``article``, ``main`` and headings never go by their own names, the heading in the header of an
article stays, and no name empties a page that has text (see ``Page``). Work is
linear in the page, however deep or ill-formed its markup.

Defined results: NULL or empty html gives the empty text; a NULL url has the
empty host, whose pages vote together; unclosed or stray tags are closed as a
browser would; an unclosed comment, script or style reaches to the end of the
page. Repeated rows are each extracted; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidystar.llm.common import annotate, cut_lineage, slices

BROADCAST_BYTES = 16 << 20

# Element names of HTML and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes template svg".split())
BLOCK = frozenset((
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr caption ul button").split())
DROPPED = frozenset("nav header footer aside form menu button select dialog head search".split())
CONTAINER = frozenset("body article main section div td blockquote center table".split())
#: Menus, headers, footers, sidebars and forms: layout, so such a name on most of a page's text is not one of them.
LAYOUT = frozenset((
    "breadcrumb breadcrumbs footer form header masthead menu menubar menus nav navbar navigation pager pagination "
    "sidebar sidebars topbar").split())
#: Notices, adverts and comments: may be longer than what they stand beside.
ASIDE = frozenset((
    "ad ads advert adverts advertisement advertising adsense comment comments consent cookie cookies disqus gdpr notice "
    "notices notification sponsored").split())
#: Words that place or shape a box; a name of furniture has only these beside its furniture words.
PLACE = frozenset((
    "area banner bar block bottom box col column container fixed floating global group holder inner item items left "
    "link links list main mobile outer page panel placeholder primary reader readers region right row secondary "
    "section side site slot sticky sub thread top unit user users widget wrap wrapper").split())
#: Whole names of content: a name beside them only counts if it is furniture as a whole.
CONTENT = frozenset("article content entry hentry post story".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert toolbar".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"),
           "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead")}
#: A new item of a list or table closes an older one only inside these.
_SCOPE = frozenset("ul ol dl table menu select body article section div main html".split())

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?(?=[\s/]|$)",
                   re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for name in RAW}
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Za-z0-9]+")


class Element:
    __slots__ = ("tag", "step", "parent", "dropped", "gone", "named", "size", "headed", "score", "order",
                 "key", "home", "block", "within", "titled", "closed")

    def __init__(self, tag, step, parent, dropped, gone, named, order):
        self.tag, self.step, self.parent, self.dropped, self.order = tag, step, parent, dropped, order
        self.closed = False  # ended while elements inside it were still open
        # the nearest block; the nearest article or main; whether only the header of an article is what drops it
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.within = self if tag in ("article", "main") else parent.within if parent is not None else None
        self.titled = parent is not None and gone and (
            parent.titled or (tag == "header" and not parent.gone and parent.within is not None))
        self.gone, self.named = gone, named  # dropped by tag, role or hidden; furniture by class or id
        self.size, self.headed, self.score = 0, tag in ("h1", "main"), 0.0
        self.key = 0  # number of the path
        self.home = self if tag in CONTAINER else parent.home if parent is not None else None

    def path(self) -> str:
        steps, node = [], self
        while node is not None and node.tag != "html":
            steps.append(node.step)
            node = node.parent
        return " ".join(reversed(steps))  # no step has a blank


def _furniture(names: list[str]) -> frozenset | None:
    """LAYOUT or ASIDE if a class or id names page furniture: all its words do, or place it."""
    content = not CONTENT.isdisjoint(n.lower() for n in names)
    for name in names:
        words = {w.lower() for w in _WORDS.findall(name)}
        if not words or (content and len(words) > 1):
            continue
        for kind in (ASIDE, LAYOUT):
            if not words.isdisjoint(kind) and words <= ASIDE | LAYOUT | PLACE:
                return kind
    return None


class Page:
    """Blocks of a page, each with its element; furniture is left out.

    Furniture by class or id stays if nothing would be left, or if it has most of
    the page's text outside links and is layout or holds the page's heading.
    """

    def __init__(self, html: str):
        self._read(html, frozenset())
        named = [e for e in self.elements if e.named]
        if named:
            for e in reversed(self.elements):
                if e.parent is not None:
                    e.parent.size += e.size
                    e.parent.headed = e.parent.headed or (e.headed and not e.gone)
            most = self.elements[0].size / 2
            kept = named if not self.blocks else \
                [e for e in named if e.size > most and (e.named is LAYOUT or e.headed)]
            if kept:
                self._read(html, frozenset(e.order for e in kept))

    def _read(self, html: str, kept: frozenset):
        self.kept = kept  # order of the elements that stay whatever their names
        self.elements: list[Element] = []
        self.blocks: list[tuple[Element, str, int]] = []  # element, text, characters in links
        self._keys: dict[tuple[int, str], int] = {}
        self._parse(html)

    def _open(self, tag: str, attrs: str, parent: Element | None) -> Element:
        step, gone, named = tag, (parent is not None and parent.gone) or tag in DROPPED, None
        # the heading in the header of an article is its title
        title = tag in _HEADINGS and parent is not None and parent.titled
        gone = gone and not title
        if attrs and not attrs.isspace():
            classes, ids, role, hidden = "", "", "", False
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "class":
                    classes = value
                elif name == "id":
                    ids = value
                elif name == "role":
                    role = value.lower()
                else:
                    hidden = hidden or name == "hidden" or value.lower() == "true"
            names = classes.split()
            if tag not in ("html", "body", "main"):
                gone = gone or hidden or role in _FURNITURE_ROLES
                if tag != "article" and tag not in _HEADINGS and not gone and len(self.elements) not in self.kept:
                    named = _furniture([*names, *ids.split()])
            if names:
                step = tag + "." + ".".join(sorted({_DIGITS.sub("0", c.lower()) for c in names}))
        dropped = gone or named is not None or (parent is not None and parent.dropped and not title)
        element = Element(tag, step, parent, dropped, gone, named, len(self.elements))
        if parent is not None:
            element.key = self._keys.setdefault((parent.key, step), len(self._keys) + 1)
        self.elements.append(element)
        return element

    def _parse(self, html: str) -> None:
        root = self._open("body", "", None)
        # places in the stack of the open elements of a tag, and of open blocks
        stack, places, blocks = [root], {}, [0]
        buffer: list[str] = []
        linked, links = 0, 0

        def nearest(tags) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=0)

        def flush():
            nonlocal linked
            if buffer:
                text = " ".join("".join(buffer).split())
                stack[-1].size += max(len(text) - linked, 0)
                if text and not stack[-1].dropped:
                    self.blocks.append((stack[-1].block, text, linked))
                buffer.clear()
            linked = 0

        def cut(i: int):
            """Take the elements from place ``i`` on from the stack."""
            nonlocal links
            for e in stack[i:]:
                if not e.closed:
                    places[e.tag].pop()
                    links -= e.tag == "a"
            del stack[i:]
            while stack[-1].closed:
                stack.pop()
            while blocks[-1] >= len(stack):
                blocks.pop()

        def close(i: int):
            flush()
            cut(i)

        at, size = 0, len(html)
        while at < size:
            m = _MARKUP.search(html, at)
            stop = m.start() if m else size
            if stop > at and not stack[-1].gone:
                text = unescape(html[at:stop]) if "&" in html[at:stop] else html[at:stop]
                buffer.append(text)
                if links:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            tag = name.lower()
            if m["end"]:
                i = nearest((tag,))
                if i <= 0:
                    if tag in BLOCK:
                        flush()
                elif tag in BLOCK:
                    close(i)
                elif blocks[-1] > i:  # an inline element ends inside a block that it holds
                    links -= tag == "a"
                    places[tag].pop()
                    stack[i].closed = True
                else:
                    if (stack[-1].dropped or stack[i].dropped) and not stack[i].parent.dropped:
                        flush()
                    cut(i)
                continue
            if tag in ("html", "body"):
                if tag == "body" and m["attrs"]:
                    root.step = self._open("body", m["attrs"], None).step
                    self.elements.pop()
                continue
            if tag in RAW:
                if not m["attrs"].rstrip().endswith("/"):
                    end = _RAW_END[tag].search(html, at)
                    at = end.end() if end else size
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    buffer.append(" ")
                continue
            if tag in BLOCK:
                flush()
                closes = _CLOSES.get(tag, ())
                scope = _SCOPE.difference(closes) if closes else ()
                while closes and (i := nearest(closes)) > nearest(scope):
                    close(i)
                    if tag not in ("tr", "tbody", "tfoot", "dt", "dd"):
                        break
                if stack[blocks[-1]].tag == "p":
                    close(blocks[-1])
            element = self._open(tag, m["attrs"], stack[-1])
            if element.dropped != stack[-1].dropped and tag not in BLOCK:
                flush()
            if m["attrs"].endswith("/") and tag not in BLOCK:
                continue
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                blocks.append(len(stack))
            stack.append(element)
            links += tag == "a"
        flush()

    def best(self) -> Element | None:
        """The container with most text of its own: full weight one level up, less above."""
        weight = [0.0] * len(self.elements)
        for owner, text, linked in self.blocks:
            weight[owner.order] += len(text) - 1.5 * linked
        for e in reversed(self.elements):  # passed up once
            passed = weight[e.order]
            if e.tag in CONTAINER:
                e.score = passed * (1.5 if e.tag in ("article", "main") else 1.0)
                passed *= 0.75
            if e.parent is not None:
                weight[e.parent.order] += passed
        scored = [e for e in self.elements if e.score > 0]
        return max(scored, key=lambda e: (e.score, -e.order)) if scored else None

    def first_on(self, path: str) -> Element | None:
        """The first container on a generalised path, found step by step."""
        steps, key = path.split(" "), 0
        if steps[0] != self.elements[0].step:
            return None
        for step in steps[1:]:
            key = self._keys.get((key, step))
            if key is None:
                return None
        return next((e for e in self.elements if e.key == key and e.tag in CONTAINER), None)

    def whole(self, node: Element) -> Element:
        """The furthest container around the elements on the path of ``node`` that adds text outside links.

        ``article`` and ``main`` are whole; ``body`` only counts with text of its own,
        outside other containers.
        """
        root = self.elements[0]
        prose = [0] * len(self.elements)
        own = 0
        for owner, text, linked in self.blocks:
            if 2 * linked < len(text):
                prose[owner.order] += len(text)
                own += len(text) * (owner.home is root)
        total: dict[int, int] = {}  # per path: elements on one path are never inside one another
        for e in reversed(self.elements):
            total[e.key] = total.get(e.key, 0) + prose[e.order]
            if e.parent is not None:
                prose[e.parent.order] += prose[e.order]
        parent = node.parent
        while parent is not None and node.tag not in ("article", "main"):
            if parent.tag in CONTAINER and (own if parent is root else total[parent.key] > total[node.key]):
                node = parent
            parent = parent.parent
        return node

    def within(self, node: Element) -> str:
        """The blocks inside the elements on the path of ``node``, in page order."""
        inside = [False] * len(self.elements)
        for e in self.elements:
            inside[e.order] = e.key == node.key or (e.parent is not None and inside[e.parent.order])
        return "\n\n".join(text for owner, text, _ in self.blocks if inside[owner.order])


def best_path(html: str | None) -> tuple[str, int]:
    """Generalised path and text length of a page's best container, made whole."""
    page = Page(html or "")
    best = page.best()
    if best is None:
        return "", 0
    best = page.whole(best)
    return best.path(), len(page.within(best))


def main_text(html: str | None, path: str | None) -> str:
    """Text of the elements on ``path``, or of the page's own best container, made whole.

    A page that is nearly all links has no best container and gives all its blocks.
    """
    if not html:
        return ""
    page = Page(html)
    node = page.first_on(path) if path else None
    text = page.within(page.whole(node)) if node is not None else ""
    if text:
        return text
    return page.within(page.whole(page.best() or page.elements[0]))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    start = F.locate("://", url)
    rest = F.when(start > 0, url.substr(start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def winning_paths(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(host, path) of most votes for each host of ``pages`` (with a column ``host``)."""
    def make():
        def run(column):
            found = [best_path(h) for h in column.to_pylist()]
            return [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())]

        return run

    votes = annotate(pages, html_col, ["host"], "path string, votes bigint", make).where("path <> ''") \
        .groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    first = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    return votes.withColumn("place", first).where("place = 1").select("host", "path")


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url and text for every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")) \
        .withColumn("host", url_host(F.col("url")))
    winners = cut_lineage(spark, winning_paths(rows), "winning-paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    joined = rows.join(F.broadcast(winners) if size <= BROADCAST_BYTES else winners, "host", "left") \
        .select("page_id", "url", "html", "path")

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [main_text(h, p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    return joined.mapInArrow(run, f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, text string")
