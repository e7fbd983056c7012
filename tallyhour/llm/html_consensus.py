"""Main text of web pages by the container paths that the pages of a host agree on.

A page's containers are scored: a container's mass is the text of its blocks outside links,
headings counted twice; its score is the square of its share of the page's mass, times the
share of its characters that are mass, less where its blocks lie in further containers, with a
bonus for article elements. Containers are told
apart by generalised paths of tags and classes (digits replaced but in names of grid columns, places
among siblings left out), so that equal containers of one page count as one. Every page votes for all paths that
hold at least half of its mass; Spark adds the votes up by host and path (folded in each task
first) and takes each host's strongest path. Pages are then parsed again and cut at their
host's path. A page on which that path holds less than half of the mass, or that has no host,
is cut at its own best container.

Left out wherever they lie: scripts, styles, menus, sidebars, forms and other elements named
in ``GONE``, page headers, and elements whose role, class or id says so (``BOILERPLATE``,
reader comments among them). A page of which nothing would be left is taken without the
class rules.

Defined results: a null or empty html, or one without text, gives ''; unclosed and crossed
elements end with their parent; text after an unclosed comment, script or tag is not shown by
browsers and is left out; a br is white space; each block of text (paragraph, heading, list
item, table row) is one line; repeated rows are rows of their own; hosts are compared in
lower case without port.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, stage, strings

SLICE_BYTES = 4 << 20
#: Least share of a page's mass that a path must hold.
SHARE = 0.5
#: Votes are whole numbers, so that their sums do not depend on order.
VOTE = 1000
#: Host paths of up to this many bytes in all are broadcast.
BROADCAST_BYTES = 16 << 20
#: Otherwise hosts with more than one in so many pages are (there are at most so many of them).
HOT_ONE_IN = 1000

# Elements by their part in a page, and words of classes, ids and roles that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
GONE = frozenset("head script style title textarea iframe noembed noframes nav aside footer form button select option "
                 "datalist dialog menu noscript template svg canvas object audio video map".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
                   "section select summary table tbody td tfoot th thead tr ul".split())
#: Text blocks and lists are no containers; nor are inline elements.
CONTAINERS = frozenset("article body center details div fieldset main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends an open element of these, unless one of the others lies between.
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead"), ("table",)),
        "option": (("option",), ("select", "datalist"))}
BARRIERS = frozenset("table td th caption button object html body".split())
COMMENTS = frozenset("comment comments commentlist commentary disqus discussion replies reply respond responses".split())
BOILERPLATE = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle banner breadcrumb breadcrumbs complementary "
    "contentinfo consent cookie cookies copyright footer gdpr hidden login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promotion recommended related search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert header".split())
#: Words before a mark that turn it into a remark on the layout ("has-sidebar").
LAYOUT = frozenset("has no with without is enable show main content article post entry".split())
#: Elements that class rules never take out.
KEPT = frozenset("html body main".split()) | HEADINGS

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"""
                   r"""|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"\d+")
#: Classes whose number tells columns of a page apart, not pages.
GRID = re.compile(r"(?:cols?|column|grid|span|row|offset|cell|pure|large|medium|small|[smlwhp])(?:-[a-z]+)*[-_]?\d+(?:[-_/]\d+)?", re.I)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
HOST = r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without port; null where there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), HOST, 1)
    return F.when(host != "", host)


def attributes(text: str) -> dict[str, str]:
    out = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


def marked(attrs: dict[str, str]) -> tuple[bool, bool]:
    """(boilerplate by its class, id or role, reader comments)."""
    found = comments = False
    for name in ("class", "id", "role"):
        for token in _html.unescape(attrs.get(name, "")).split():
            words = [w.lower() for w in WORDS.findall(token)]
            for i, w in enumerate(words):
                if w in BOILERPLATE and not (i and words[i - 1] in LAYOUT):
                    found = True
                    comments = comments or w in COMMENTS
    style = attrs.get("style", "").replace(" ", "").lower()
    hidden = attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    return found or hidden, comments


def step(tag: str, attrs: dict[str, str]) -> str:
    """A step of a generalised path: the tag and its sorted classes, digits replaced."""
    classes = sorted({c if GRID.fullmatch(c) else DIGITS.sub("#", c) for c in attrs.get("class", "").split()})
    out = ".".join([tag, *classes])
    return out if len(out) <= 120 else f"{tag}.~{blake2b(out.encode('utf-8', 'surrogatepass'), digest_size=8).hexdigest()}"


class Page:
    """Elements and text blocks of a page; an element's number is greater than its parent's."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hard, self.soft, self.wrap = [-1], ["#"], [False], [False], [False]
        self.path, self.paths, self.steps = [0], {}, [(-1, "")]
        self.blocks: list[tuple[int, str, int]] = []  # owner, text, characters in links
        self._stack, self._open = [0], Counter()
        self._text, self._linked, self._muted = [], 0, 0
        self._parse(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                owner = next(n for n in reversed(self._stack) if self.tag[n] in BLOCKS or n == 0)
                self.blocks.append((owner, text, min(len(text), self._linked)))
            self._text, self._linked = [], 0

    def _mutes(self, n: int) -> bool:
        """Boilerplate inside a line: its text belongs to no block."""
        return self.tag[n] not in BLOCKS and (self.hard[n] or self.soft[n])

    def _pop(self, depth: int) -> None:
        """Close elements until ``depth`` are open."""
        for n in self._stack[depth:]:
            self._open[self.tag[n]] -= 1
            self._muted -= self._mutes(n)
        if any(self.tag[n] in BLOCKS for n in self._stack[depth:]):
            self._flush()
        del self._stack[depth:]

    def _end(self, tags: tuple, barriers) -> None:
        if not any(self._open[t] for t in tags):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            t = self.tag[self._stack[depth]]
            if t in tags:
                return self._pop(depth)
            if t in barriers:
                return

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in BLOCKS:
            self._end(("p",), BARRIERS)
            if tag in HEADINGS and self.tag[self._stack[-1]] in HEADINGS:
                self._pop(len(self._stack) - 1)
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        n, up = len(self.parent), self._stack[-1]
        soft, comments = marked(attrs) if attrs else (False, False)
        inside = self._open["article"] or self._open["main"]
        hard = tag in GONE or "hidden" in attrs or comments or tag == "header" and not inside
        self.parent.append(up)
        self.tag.append(tag)
        self.hard.append(hard and tag not in KEPT)
        self.soft.append(soft and tag not in KEPT)
        self.wrap.append(False)
        key = (self.path[up], step(tag, attrs))
        if key not in self.paths:
            self.paths[key] = len(self.steps)
            self.steps.append(key)
        self.path.append(self.paths[key])
        if tag == "main":  # what holds the page's main element is no boilerplate
            for a in self._stack:
                self.wrap[a] = True
        self._stack.append(n)
        self._open[tag] += 1
        self._muted += self._mutes(n)

    def _say(self, text: str) -> None:
        if text and not self._muted:
            text = _html.unescape(text) if "&" in text else text
            self._text.append(text)
            if self._open["a"]:
                self._linked += len(" ".join(text.split()))

    def _parse(self, source: str) -> None:
        at, search = 0, TOKEN.search
        while True:
            m = search(source, at)
            if m is None:
                self._say(source[at:])
                break
            self._say(source[at:m.start()])
            at = m.end()
            k = 1 if m.group(2) else 4 if m.group(5) else 0
            if not k:
                if m.group().startswith("<![CDATA["):
                    self._text += [] if self._muted else [m.group()[9:].removesuffix("]]>")]
                continue
            tag, rest = m.group(k + 1).lower(), m.group(k + 2)
            if not m.group(k):
                self._start(tag, attributes(rest) if rest.strip(" /") else {})
                if tag in RAW:
                    e = RAW_END[tag].search(source, at)
                    at = e.end() if e else len(source)
                    self._pop(len(self._stack) - 1)
                elif tag in ("svg", "math") and rest.endswith("/"):
                    self._pop(len(self._stack) - 1)
            elif tag in ("p", "br") and not self._open[tag]:
                self._start("br", {})
                if tag == "p":
                    self._flush()
            elif self._open[tag]:
                self._end((tag,), ("td", "th") if tag in BLOCKS and tag not in ("table", "tr", "tbody") and (
                    self._open["td"] or self._open["th"]) else ())
        self._flush()

    def path_text(self, path: int) -> str:
        """The path as text; the middle of a very long one as a digest."""
        steps = []
        while path > 0:
            path, s = self.steps[path]
            steps.append(s)
        steps.reverse()
        if len(steps) > 40:
            middle = "/".join(steps[8:-24]).encode("utf-8", "surrogatepass")
            steps[8:-24] = [f"~{blake2b(middle, digest_size=8).hexdigest()}"]
        return "/".join(steps)

    def gone(self, by_class: bool) -> list[bool]:
        out = [False] * len(self.parent)
        for n in range(1, len(out)):
            out[n] = (out[self.parent[n]] or self.hard[n] and not self.wrap[n]
                      or by_class and self.soft[n] and not self.wrap[n])
        return out

    def shown(self) -> list[tuple[int, str, int]]:
        """Blocks outside boilerplate."""
        for by_class in (True, False):
            gone = self.gone(by_class)
            out = [b for b in self.blocks if not gone[b[0]]]
            if out:
                break
        return out

    def scores(self) -> dict[int, tuple[float, float]]:
        """(share of the page's mass, score) of every container path that holds at least ``SHARE`` of it."""
        mass, chars, direct = ([0] * len(self.parent) for _ in range(3))
        for owner, text, linked in self.shown():
            mass[owner] += (len(text) - linked) * (2 if self.tag[owner] in HEADINGS else 1)
            chars[owner] += len(text) * (2 if self.tag[owner] in HEADINGS else 1)
        for n, m in enumerate(mass):  # to the innermost container
            while m and n and self.tag[n] not in CONTAINERS:
                n = self.parent[n]
            direct[n] += m
        for n in range(len(mass) - 1, 0, -1):
            mass[self.parent[n]] += mass[n]
            chars[self.parent[n]] += chars[n]
        held, size, own, bonus = Counter(), Counter(), Counter(), {0: 1.0}
        for n in range(1, len(mass)):
            if mass[n] and self.tag[n] in CONTAINERS:
                p = self.path[n]
                held[p] += mass[n]
                size[p] += chars[n]
                own[p] += direct[n]
                bonus[p] = {"article": 1.5, "main": 1.25}.get(self.tag[n], 1.0)
        if not mass[0]:
            return {}
        if not held:
            held[0], size[0] = mass[0], chars[0]
        out = {}
        for p, m in held.items():
            share = m / mass[0]
            if share >= SHARE:
                out[p] = (share, share * share * m / size[p] * (0.6 + 0.4 * own[p] / m) * bonus[p])
        return out or {0: (1.0, 1.0)}

    def best(self, scores: dict) -> int:
        """The path of the highest score, of equals the innermost."""
        return max(scores, key=lambda p: (round(scores[p][1], 9), p))

    def text(self, path: int | None) -> str:
        """Text of the containers of this path; of the whole page for None."""
        if path is None:
            return "\n".join(t for _, t, _ in self.shown())
        inside = [path == 0] * len(self.parent)
        for n in range(1, len(inside)):
            inside[n] = inside[self.parent[n]] or self.path[n] == path
        return "\n".join(t for owner, t, _ in self.shown() if inside[owner])


def votes_of(source: str) -> dict[str, int]:
    """Path to votes of one page."""
    page = Page(source)
    scores = page.scores()
    if not scores:
        return {}
    top = max(s for _, s in scores.values())
    return {page.path_text(p): round(VOTE * s / top) for p, (_, s) in scores.items()}


def main_text(source: str, agreed: str | None) -> tuple[str, str | None, bool]:
    """(text, path it was cut at, whether that is the agreed path) of one page."""
    if not source:
        return "", None, False
    page = Page(source)
    scores = page.scores()
    if not scores:
        return page.text(None), None, False
    if agreed is not None:
        for p in scores:
            if page.path_text(p) == agreed:
                return page.text(p), agreed, True
    p = page.best(scores)
    return page.text(p), page.path_text(p), False


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, votes, pages: the strongest path of every host of ``pages`` (url, html)."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                votes, seen = Counter(), Counter()
                for host, source in zip(part.column(0).to_pylist(), strings(part.column(1))):
                    for path, v in votes_of(source).items():
                        votes[host, path] += v
                        seen[host, path] += 1
                keys = list(votes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string()),
                     pa.array([votes[k] for k in keys], pa.int64()), pa.array([seen[k] for k in keys], pa.int64())],
                    names=["host", "path", "votes", "pages"])

    cast = (pages.select(host_of(F.col("url")).alias("host"), "html").where("host is not null")
            .mapInArrow(run, "host string, path string, votes long, pages long")
            .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages")))
    won = F.max(F.struct("votes", "path", "pages"))
    return cast.groupBy("host").agg(won.alias("w")).select("host", "w.path", "w.votes", "w.pages")


def with_paths(pages: DataFrame, paths: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` (host, ...) with their host's path as ``agreed``.

    Paths are broadcast where their measured size is small. Of more hosts, those with over one in
    HOT_ONE_IN pages are broadcast, at most that many rows, and the others' pages are shuffled.
    """
    paths = paths.select(F.col("host").alias("_host"), F.col("path").alias("agreed"), "pages")
    joined = lambda rows, side: rows.join(side.drop("pages"), rows["host"] == side["_host"], "left").drop("_host")
    row = paths.agg(F.sum(F.octet_length("_host") + F.octet_length("agreed") + 64).alias("size"),
                    F.sum("pages").alias("pages")).first()
    if (row["size"] or 0) <= broadcast_bytes:
        return joined(pages, F.broadcast(paths))
    least = row["pages"] // HOT_ONE_IN
    hot = F.broadcast(paths.where(F.col("pages") > least))
    rows = pages.join(hot.select("_host").withColumnRenamed("_host", "_hot"), F.col("host") == F.col("_hot"), "left")
    few = rows.where("_hot is not null").drop("_hot")
    many = rows.where("_hot is null").drop("_hot")
    return joined(few, hot).unionByName(joined(many, paths.where(F.col("pages") <= least)))


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars, path, by_host of every page: its main text, and where it was cut."""
    ship(pages.sparkSession)
    paths = stage(host_paths(pages), "host-paths")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                found = [main_text(s, a) for s, a in zip(strings(part.column(2)), part.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([t for t, _, _ in found], pa.string()),
                     pa.array([len(t) for t, _, _ in found], pa.int64()), pa.array([p for _, p, _ in found], pa.string()),
                     pa.array([b for _, _, b in found], pa.bool_())],
                    names=["page_id", "url", "text", "n_chars", "path", "by_host"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html", host_of(F.col("url")).alias("host"))
    return with_paths(rows, paths, broadcast_bytes).select("page_id", "url", "html", "host", "agreed").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, path string, by_host boolean")
