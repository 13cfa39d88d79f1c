"""Main text of web pages by text-to-tag ratios of their lines.

The standard library's parser streams events; lines are the runs of text between block tags.
Each line has a ratio of its characters to the tags inside and before it.  The ratios are
smoothed along the page with a Gaussian and divided into two clusters by a threshold; lines of
the upper one mark content.  The content region is the smallest element that holds all marked lines, or
the article around it; on a page without one, the outermost element around it that has text of its
own.  All lines of the region belong to the text, also short ones, except those inside parts that
pages declare as something else: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments.  A class or id that may as well be a topic ("discussion") declares
nothing about a part of the article that has the ratio of content; outside the article it does.  A form that
holds the article is no form of it.

Elements are numbered as they open, so that one number and the last one inside an element tell what it holds;
work and memory are in proportion to the page, however deep its elements lie in each other.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SIGMA = 2.0
# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = frozenset(
    "script style template noscript head title svg math iframe object canvas audio video select option button "
    "textarea input datalist".split()
)
OUTSIDE = frozenset("nav footer aside form dialog menu header".split())
ARTICLE = frozenset("article main".split())
# Elements that divide a page; all others belong to the flow of a text.
DIVISIONS = frozenset("html body div section center details dialog fieldset article main".split()) | OUTSIDE
# Words of class, id and role that declare a part as not belonging to the article.  A name declares
# if it is made of such words and words of PLACES alone, so "with-sidebar" or "header-files" does not.
DECLARED = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets notice notices cookie cookies "
    "consent gdpr popup modal overlay alert comment comments commentlist disqus reply replies discussion respond "
    "share sharing social related recommended newsletter subscribe subscription signup login search toolbar "
    "pagination pager skip complementary contentinfo".split()
)
PLACES = frozenset(
    "site page main top bottom left right list box container wrapper wrap area bar block link links button buttons "
    "icon icons item items section form inner outer primary secondary global post posts article articles content "
    "body text title slot unit thread meta div col column row".split()
)
# Words that may as well be what a text is about: alone they declare no part that is clearly content.
TOPICS = frozenset(
    "header banner promotion navigation menu notice notices cookie cookies consent gdpr alert discussion respond "
    "share sharing social related recommended newsletter subscription login search skip".split()
)
_HEADINGS = frozenset("h1 h2 h3".split())
# What a head holds; any other block ends it.
_IN_HEAD = frozenset("title style script noscript template".split())
# Unseen elements that hold no blocks; a block ends them.
_NO_BLOCKS = frozenset("button select option datalist textarea".split())
_ENDS_LIKE = frozenset("li dt dd tr td th option".split())
_HEADING = re.compile("h[1-6]")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# How an element stands to the text: part of it, apart if it is not in the article, apart, a form, never part.
TEXT, TOPIC, APART, FORM, NEVER = range(5)


def declared(names: str) -> set[str]:
    """The names of a class or id that declare a part as something else."""
    out = set()
    for name in names.split():
        words = {w.lower() for w in _TOKEN.findall(name)} if name.lower() not in DECLARED else {name.lower()}
        if words & DECLARED and words <= DECLARED | PLACES:
            out.add(" ".join(sorted(words & DECLARED)))
    return out


class Line:
    """A run of text; ``block`` is the innermost block around it and ``apart`` the innermost declared part (or 0)."""

    __slots__ = ("parts", "tags", "link", "block", "apart", "heading", "outside", "text")

    def __init__(self, block: int, apart: int, heading: bool):
        self.parts: list[str] = []
        self.tags, self.link, self.block, self.apart, self.heading = 1, 0, block, apart, heading
        self.outside, self.text = bool(apart), ""


class Element:
    __slots__ = ("name", "number", "unseen", "stands", "block")

    def __init__(self, name: str, number: int, unseen: bool, stands: int, block: bool):
        self.name, self.number, self.unseen, self.stands, self.block = name, number, unseen, stands, block


class PageParser(HTMLParser):
    """Lines of a page with the blocks and declared parts that they are in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Element] = []  # blocks, links, unseen and declared elements
        self.blocks: list[int] = []  # places of the blocks among them
        self.parts: list[Element] = []  # the declared ones among them
        self.named: dict[str, int] = {}  # how many of each name are open
        self.unseen = self.headings = self.articles = 0
        self.strays: list[int] = []  # places of the parts that only a name declares
        self.count = 0
        # By number, of blocks and declared parts: name, the one around it, the last number inside it.
        self.names: dict[int, str] = {0: "html"}
        self.above: dict[int, int] = {0: 0}
        self.last: dict[int, int] = {}
        # Of declared parts: how each stands to the text, and the strongest of those around it and itself.
        self.stands: dict[int, int] = {}
        self.strongest: dict[int, int] = {0: TEXT}
        self.part_above: dict[int, int] = {}
        self.line: Line | None = None

    def _close(self, at: int) -> None:
        for element in reversed(self.open[at:]):
            self.named[element.name] -= 1
            self.unseen -= element.unseen
            self.headings -= element.name in _HEADINGS
            self.articles -= element.name in ARTICLE
            self.last[element.number] = self.count
            if element.block:
                self.blocks.pop()
                self.line = None
            if element.stands:
                self.parts.pop()
                if element.name not in OUTSIDE:
                    self.strays.pop()
        del self.open[at:]

    def _open(self, element: Element) -> None:
        number = element.number
        around = self.open[self.blocks[-1]].number if self.blocks else 0
        if element.block:
            self.blocks.append(len(self.open))
        if element.block or element.stands:
            self.names[number], self.above[number] = element.name, around
        if element.stands:
            before = self.parts[-1].number if self.parts else 0
            self.stands[number], self.part_above[number] = element.stands, before
            self.strongest[number] = max(element.stands, self.strongest[before])
            self.parts.append(element)
            if element.name not in OUTSIDE:
                self.strays.append(len(self.open))
        self.named[element.name] = self.named.get(element.name, 0) + 1
        self.unseen += element.unseen
        self.headings += element.name in _HEADINGS
        self.articles += element.name in ARTICLE
        self.open.append(element)

    def _close_named(self, name: str) -> None:
        if self.named.get(name):
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at].name == name:
                    self._close(at)
                    return

    def _ended_by_block(self, tag: str) -> None:
        """Close what cannot hold the block ``tag``."""
        if tag not in _IN_HEAD and tag != "head":
            self._close_named("head")
        if tag != "option":
            for name in _NO_BLOCKS:
                self._close_named(name)
        # A block ends an open paragraph; an item ends the item before it.
        if self.blocks:
            name = self.open[self.blocks[-1]].name
            if name == "p" or (name == tag and tag in _ENDS_LIKE):
                self._close(self.blocks[-1])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            if tag in BLOCKS:
                self.line = None
            elif self.line is not None:
                self.line.tags += 1
            return
        block = tag in BLOCKS
        if block:
            self._ended_by_block(tag)
            self.line = None
        elif self.line is not None:
            self.line.tags += 1
        if tag == "a":
            self._close_inline("a")  # links do not lie in each other
        own = {name: value or "" for name, value in attrs}
        names = set().union(*(declared(own.get(name, "")) for name in ("class", "id")))
        roles = declared(own.get("role", ""))
        hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
        unseen = tag in UNSEEN or hidden
        root = tag in ("html", "body") or (
            tag in ARTICLE and not {w for x in names | roles for w in x.split()} & {"comment", "comments", "reply", "related"}
        )
        stands = TEXT
        if not root and tag in OUTSIDE:
            # The header of an article may hold its lead, a form the whole page.
            stands = TOPIC if tag == "header" and self.articles else FORM if tag == "form" else NEVER
        elif not root and not _HEADING.fullmatch(tag) and names | roles:
            stands = TOPIC if names <= TOPICS and not roles else APART
        if tag in ARTICLE and root:
            # What stays open before an article was never closed.
            if self.strays:
                self._close(self.strays[0])
        self.count += 1
        if block or unseen or stands or tag == "a":
            self._open(Element(tag, self.count, unseen, stands, block))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close_inline(self, tag: str) -> None:
        """Close an inline element unless a block lies between."""
        if self.named.get(tag):
            least = self.blocks[-1] if self.blocks else -1
            for at in range(len(self.open) - 1, least, -1):
                if self.open[at].name == tag:
                    self._close(at)
                    return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in UNSEEN:
            self._close_named(tag)
        else:
            self._close_inline(tag)

    def handle_data(self, data: str) -> None:
        if self.unseen:
            return
        if self.line is None:
            if not data.strip():
                return
            part = self.parts[-1] if self.parts else None
            apart = part.number if part else 0
            # An article's own heading may stand in its header.
            heading = self.headings > 0
            if heading and self.articles and len(self.parts) == 1 and part.name == "header":
                apart = 0
            block = self.open[self.blocks[-1]].number if self.blocks else 0
            self.line = Line(block, apart, heading)
            self.lines.append(self.line)
        self.line.parts.append(data)
        if self.named.get("a"):
            self.line.link += len(data.strip())

    def finish(self) -> list[Line]:
        self.close()
        self._close(0)
        self.last[0] = self.count
        for line in self.lines:
            line.text = " ".join("".join(line.parts).split())
        return [line for line in self.lines if line.text]

    def holds(self, element: int, block: int) -> bool:
        return element <= block <= self.last[element]

    def around(self, block: int) -> list[int]:
        """The blocks around one, itself first, without the page."""
        out = []
        while block:
            out.append(block)
            block = self.above[block]
        return out


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(values, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The middle between the means of two clusters (two-means in one dimension)."""
    low, high = float(values.min()), float(values.max())
    while True:
        middle = (low + high) / 2
        below, above = values[values <= middle], values[values > middle]
        if not len(below) or not len(above):
            return middle
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            return middle
        low, high = new


def _free(page: PageParser, lines: list[Line], free: set[int]) -> None:
    """Let the lines of ``free`` parts into the text, unless they are in another part that is not free."""
    bound = {0: False}
    for part in sorted(page.stands):
        bound[part] = part not in free or bound[page.part_above[part]]
    for x in lines:
        x.outside = bound[x.apart]


def _content(page: PageParser, lines: list[Line], marked: np.ndarray, stands: int, among) -> set[int]:
    """Declared parts that have the ratio of content: most of their text is in marked lines and few of it in links."""
    sums = {part: [0, 0, 0] for part, kind in page.stands.items() if page.strongest[part] <= stands}
    for k, (x, mark) in enumerate(zip(lines, marked)):
        if x.apart in sums and among(k, x):
            for at, value in enumerate((len(x.text), min(x.link, len(x.text)), len(x.text) * mark)):
                sums[x.apart][at] += value
    for part in sorted(sums, reverse=True):  # those inside come later
        above = page.part_above[part]
        if above in sums:
            for at in range(3):
                sums[above][at] += sums[part][at]
    return {p for p, (n, link, mark) in sums.items() if page.stands[p] == stands and n and 3 * link <= n and 2 * mark >= n}


def _wrappers(page: PageParser, lines: list[Line]) -> set[int]:
    """Forms around a page: those that hold an article, or four fifths of the text that nothing else declares."""
    forms = [p for p, kind in page.stands.items() if kind == FORM and page.strongest[page.part_above[p]] in (TEXT, FORM)]
    if not forms:
        return set()
    articles = np.array(sorted(n for n, name in page.names.items() if name in ARTICLE and n not in page.stands))
    whole, held = 0, dict.fromkeys(forms, 0)
    for x in lines:
        if page.strongest[x.apart] in (TEXT, FORM):
            own = len(x.text) - min(x.link, len(x.text))
            whole += own
            if x.apart in held:
                held[x.apart] += own
    for form in sorted(forms, reverse=True):
        above = page.part_above[form]
        if above in held:
            held[above] += held[form]
    out = set()
    for form in forms:
        at = int(np.searchsorted(articles, form))
        if (at < len(articles) and articles[at] <= page.last[form]) or 5 * held[form] >= 4 * whole > 0:
            out.add(form)
    return out


def _overrule(page: PageParser, lines: list[Line], ratios: np.ndarray, cut: float, above: np.ndarray) -> None:
    """Declared parts that belong to the text after all.

    A form around the page declares nothing.  A topic word declares nothing about a part with the ratio of content that
    lies in the article: inside the content region, and on pages without an article element between two lines of it.
    Other parts count only where the page would have no text without them.
    """
    free = _wrappers(page, lines)
    for part in free:  # parts inside it stand on their own
        page.stands[part] = TEXT
    for part in sorted(page.stands):
        page.strongest[part] = max(page.stands[part], page.strongest[page.part_above[part]])
    _free(page, lines, free)
    text = [k for k, x in enumerate(lines) if not x.outside and not x.heading]
    if text:
        # Half of what is usual in the text is enough, where some other long part has raised the threshold.
        own = ratios > min(cut, float(np.median(ratios[text])) / 2)
        marked = [k for k in text if above[k]] or text
        region = _region(page, lines, marked)
        held = page.names[region] in ARTICLE
        first, last = marked[0], marked[-1]

        def among(k: int, x: Line) -> bool:
            return page.holds(region, x.block) and (held or first < k < last)

        _free(page, lines, free | _content(page, lines, own, TOPIC, among))
        return
    everything = np.ones(len(lines), bool)
    for stands in (TOPIC, APART):
        free |= _content(page, lines, above if above.any() else everything, stands, lambda k, x: True)
        _free(page, lines, free)
        if any(not x.outside and not x.heading for x in lines):
            return


def _region(page: PageParser, lines: list[Line], marked: list[int]) -> int:
    """The element whose lines are the text; 0 for the whole page."""
    blocks = [lines[k].block for k in marked]
    low, high = min(blocks), max(blocks)
    common = [e for e in page.around(low) if page.holds(e, high)][::-1]
    for element in common:
        if page.names[element] in ARTICLE:
            return element
    # Without an article: a list or table is part of the text around it, and so is a division
    # beside which its parent has text that is not mostly links.
    division = {0: 0}
    for element in sorted(page.above):
        if element:
            division[element] = element if page.names[element] in DIVISIONS else division[page.above[element]]
    own = {division[x.block] for x in lines if not x.outside and 2 * x.link < len(x.text)}
    if 0 in own:
        return 0
    for element in common:
        if element in own:
            return element
    return common[-1] if common and page.names[common[-1]] in DIVISIONS else 0


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = PageParser()
    page.feed(html)
    lines = page.finish()
    if not lines:
        return ""
    lengths = np.array([len(x.text) for x in lines], float)
    links = np.array([min(x.link, len(x.text)) for x in lines])
    own = (lengths - links) / np.array([x.tags for x in lines])
    ratios = smoothed(own)
    cut = threshold(ratios)
    above = ratios > cut
    _overrule(page, lines, own, cut, above)
    inside = [k for k, x in enumerate(lines) if not x.outside]
    if not inside:
        return ""
    region = _region(page, lines, [k for k in inside if above[k]] or inside)
    return "\n".join(x.text for x in lines if not x.outside and page.holds(region, x.block))


def extracted(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each in ``out`` and its code points in ``n_chars``.

    A null, empty or textless page has an empty text.  Rows are independent; columns of ``pages``
    with the new names are replaced.
    """
    pages = pages.drop(*[c for c in (out, "n_chars") if c != html])
    at = pages.columns.index(html)
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(at)]
            # Parts of surrogate pairs, from references such as &#xD800;, are no characters.
            texts = [x.encode("utf-8", "replace").decode() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=schema.names,
            )

    return pages.mapInArrow(run, schema)
