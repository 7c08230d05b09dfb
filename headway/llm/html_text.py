"""Main text of web pages: text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's parser streams its events into lines, a new one at every block
element. Each line has the ratio of its characters to its tags. The ratios are smoothed by
a Gaussian over neighbouring lines, and lines above a share of their standard deviation form
the content clusters. The clusters choose: a part of the page (an article, a main element, or
what lies in neither) is content if it holds a fair share of the clustered text, and within
it a line is content if it is clustered or stands beside clustered lines in one element, so
that headings and short paragraphs are not lost.

Elements that HTML has for other things (menus, forms, asides, hidden ones, articles within
articles, which are comments) never hold content, unless they were never closed and an
article opens in them. Class names are hints: what they mark is content only where there is
nothing else.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0
THRESHOLD = 1.0  # of the standard deviation of the smoothed ratios
LINK_SHARE = 0.5  # a line with more of its characters in links forms no cluster
PART_SHARE = 0.25  # of the largest part's clustered text, from which a part is content
REST_SHARE = 0.5  # the same for what lies in no article or main element

# Element names of the HTML standard, fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = set(
    "applet aside audio button canvas datalist dialog embed footer form head header iframe input "
    "label math menu nav noframes noscript object option script select style svg template "
    "textarea title video".split()
)
CONTAINERS = {"article", "main"}
GROUPS = CONTAINERS | {"body", "div", "section"}  # whose lines stand beside each other
ITEMS = {"dd", "dt", "li", "td", "th"}  # a link alone in one is an entry of a list of links
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

# Words in class names and ids that hint at other things than content.
HINTS = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar widget notice notices cookie cookies "
    "consent alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer "
    "header masthead topbar related recommended share sharing social subscribe newsletter signup login search skip "
    "toolbar copyright legal disclaimer tags".split()
)
COMMENTS = set("comment comments commentlist disqus replies respond".split())
NEGATED = {"no", "has", "with", "without"}  # "no-sidebar" marks the page, not a sidebar
WRAPPERS = set("area bar block box button container inner item list outer section slot unit wrap wrapper".split())


class Element(NamedTuple):
    name: str
    number: int
    drops: bool  # it holds no content, by what HTML says of it
    hinted: bool
    comments: bool


class Line:
    """A line of a page: its text, tags, characters in links, and the elements it is in."""

    def __init__(self, within: tuple[Element, ...]):
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.within = within

    def dropped_now(self) -> bool:
        return any(e.drops or e.comments or e.hinted for e in self.within)


def hints(said: dict[str, str]) -> tuple[bool, bool]:
    """Whether class or id hint at other things, and whether at comments.

    The last word of a name says what it is, so a `share-intro` is an intro.
    """
    hinted = comments = False
    for name in f"{said.get('class', '')} {said.get('id', '')}".lower().split():
        words = [w for w in re.split(r"[-_]+", name) if w]
        if not words or words[0] in NEGATED:
            continue
        while len(words) > 1 and words[-1] in WRAPPERS:
            words.pop()
        hinted |= words[-1] in HINTS
        comments |= any(w in COMMENTS for w in words)
    return hinted, comments


class Lines(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: tuple[Element, ...] = ()
        self.elements = self.links = 0
        self.closed: set[int] = set()
        self.lines: list[Line] = []
        self._line()

    def _line(self) -> None:
        self.now = Line(self.open)
        self.lines.append(self.now)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.now.tags += 1
        if tag in VOID:
            if tag in BLOCK:
                self._line()
            return
        if tag == "p":
            # a paragraph ends at the next one
            self._close("p", within={"article", "main", "section", "div", "td", "li", "body", "blockquote"})
        said = {k: v or "" for k, v in attrs}
        hinted, comments = hints(said)
        in_article = any(e.name == "article" for e in self.open)
        drops = (
            (tag in DROPPED and not (tag == "header" and any(e.name in CONTAINERS for e in self.open)))
            or said.get("role", "").lower() in ROLES
            or "hidden" in said
            or said.get("aria-hidden") == "true"
            or "display:none" in said.get("style", "").replace(" ", "")
            or (tag == "article" and in_article)
        )
        if tag in ("body", "html", "h1"):
            drops = hinted = comments = False
        self.elements += 1
        self.open += (Element(tag, self.elements, drops, hinted, comments),)
        if tag in BLOCK:
            self._line()
        elif (drops or hinted or comments) and not self.now.dropped_now():
            # what is dropped inside a line stands in a line of its own
            self._line()
        self.links += tag == "a"

    def _close(self, tag: str, within: set[str] = frozenset()) -> bool:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name == tag:
                self.closed.add(self.open[i].number)
                self.links -= sum(e.name == "a" for e in self.open[i:])
                self.open = self.open[:i]
                return True
            if self.open[i].name in within:
                return False
        return False

    def handle_endtag(self, tag: str) -> None:
        self.now.tags += 1
        was = self.now.dropped_now()
        closed = self._close(tag)
        if tag in BLOCK:
            self._line()
        elif closed and was and not Line(self.open).dropped_now():
            before = self.lines[-2] if len(self.lines) > 1 else None
            if before is not None and not before.dropped_now():
                self.now = before  # the line goes on behind what was dropped in it
                self.now.parts.append(" ")

    def handle_data(self, data: str) -> None:
        self.now.parts.append(data)
        if self.links:
            self.now.linked += len(data.strip())


class Block(NamedTuple):
    """A line as it is judged."""

    text: str
    ratio: float
    usable: bool  # holds text that is not dropped
    hinted: bool
    linked: bool  # most of it is links
    listed: bool  # an item of a list or table
    part: int  # its outermost article or main element
    group: int  # the element whose other lines it stands beside


def judged(line: Line, closed: set[int]) -> Block:
    text = " ".join("".join(line.parts).split())
    inner = max((e.number for e in line.within if e.name in CONTAINERS), default=0)

    def counts(e: Element) -> bool:
        if e.name == "article" and e.drops:
            # within another one, unless that was only never closed
            outer = [x for x in line.within if x.name == "article" and x.number < e.number]
            return any(x.number in closed for x in outer)
        # a menu that was never closed does not swallow the article after it
        return e.drops and (e.number in closed or inner < e.number)

    dropped = any(counts(e) for e in line.within)
    parts = [e for e in line.within if e.name in CONTAINERS and (e.name == "main" or not e.drops or not counts(e))]
    # of articles in a row that were never closed each is a part
    open_articles = [e for e in parts if e.name == "article" and e.number not in closed]
    part = (open_articles[-1:] or parts[:1] or [None])[0]
    names = [e.name for e in line.within]
    return Block(
        text,
        0.0 if dropped else len(text) / max(1, line.tags),
        bool(text) and not dropped,
        any(e.hinted or e.comments for e in line.within),
        line.linked > LINK_SHARE * len(text),
        bool(ITEMS & set(names)),
        part.number if part else 0,
        max((e.number for e in line.within if e.name in GROUPS), default=0),
    )


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian average over neighbouring lines; at the ends over those that exist."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j, k in enumerate(kernel, i - reach):
            if 0 <= j < len(values):
                total += k * values[j]
                weight += k
        out.append(total / weight)
    return out


def clustered(blocks: list[Block]) -> list[bool]:
    """Usable lines whose smoothed ratio is above the threshold."""
    smooth = smoothed([b.ratio for b in blocks])
    mean = sum(smooth) / max(1, len(smooth))
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / max(1, len(smooth)))
    return [b.usable and not b.linked and s >= THRESHOLD * spread for b, s in zip(blocks, smooth)]


def chosen(blocks: list[Block]) -> list[bool]:
    """Lines of the content parts that are clustered, or stand beside clustered ones."""
    core = clustered(blocks)
    for hinted in (False, True):
        # what is hinted at counts only where nothing else is found
        inside = [c and (hinted or not b.hinted) for b, c in zip(blocks, core)]
        if any(inside):
            break
    else:
        hinted, inside = True, [b.usable and not b.linked for b in blocks]
        if not any(inside):
            inside = [b.usable for b in blocks]
    weight: Counter = Counter()
    for block, is_in in zip(blocks, inside):
        if is_in:
            weight[block.part] += len(block.text)
    most = max((w for part, w in weight.items() if part), default=0)
    parts = {p for p, w in weight.items() if w >= (PART_SHARE if p else REST_SHARE) * most}
    groups = {b.group for b, is_in in zip(blocks, inside) if is_in and b.part in parts}
    return [
        b.usable and b.part in parts and (hinted or not b.hinted)
        and (is_in or (b.group in groups and not (b.linked and (b.listed or not b.part))))
        for b, is_in in zip(blocks, inside)
    ]


def main_text(html: str | None) -> str:
    """The content blocks in page order, joined by one space; empty if there are none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    # lines of tags alone would part the neighbours that are smoothed over
    blocks = [b for b in (judged(line, parser.closed) for line in parser.lines) if b.text]
    return " ".join(block.text for block, ok in zip(blocks, chosen(blocks)) if ok)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty html, or one without content, gives an empty text. Repeated rows give
    equal results, an empty table none; other columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
