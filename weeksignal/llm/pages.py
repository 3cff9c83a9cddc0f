"""Main text of web pages by text-to-tag ratio.

The standard library's parser reads a page once. Block elements end a line; each line knows
its characters, its tags, the elements around it and whether these are boilerplate by name
or by class; a class that surrounds most dense text is none. The ratio of characters to tags per line is smoothed with a Gaussian, and the
smoothed ratios are split into two clusters. The content region is the article around the
innermost container that holds most characters of the lines in the upper cluster; without an
article it is the innermost container that holds all of these lines and the dense ones
beside them. Its lines outside boilerplate are the text, short ones too.

Defined cases: a null, empty or textless page has an empty text; unclosed and unopened tags
are closed as browsers close them; a page cut off anywhere is read as far as it goes; equal
rows are read one by one; an empty table gives an empty result; further columns are
ignored. Pages are read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from weeksignal.llm.rows import texts

#: Elements that end a line (fixed values of the HTML standard).
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("script style noscript template head title textarea select option button svg canvas iframe object".split())
BOILERPLATE = frozenset("nav aside footer form menu dialog search".split())
#: Words of class, id or role that name boilerplate.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu menubar nav navbar navigation newsletter notice notices popup promo promoted promotion "
    "related replies respond share sharing sidebar signup social sponsor sponsored sponsors subscribe teaser toolbar widget "
    "banners alert complementary contentinfo dialog modal".split()
)
#: Of these, the ones that are boilerplate around an article too; other names only style the layout.
READERS = frozenset("comment comments disqus replies respond".split())
#: Notices, adverts and readers' comments can be denser than the content; other names yield to density.
NOTICES = READERS | frozenset(
    "ad ads advert adverts advertisement advertising alert consent cookie cookies dialog modal notice notices popup promo promoted "
    "promotion sponsor sponsored sponsors".split()
)
#: Their own class is not asked, and layout names around an article or main element do not count inside.
KEPT = frozenset("html body main article".split())
#: Elements that can be a content region.
REGIONS = frozenset("html body main article section div td blockquote center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag closes an open element of the same kind up to these (p and the like are often left open).
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_SCOPES = frozenset("article aside body dialog div dl fieldset figure footer form header html main menu nav ol search section table ul td th".split())
SIGMA = 1.0
#: Such as ``with-sidebar``: it tells what is inside.
_INSIDE = re.compile(r"(?<![a-z])(?:with|without|has|have|no)[-_]+[a-z]+")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Line:
    """Text of a block, the tags since the line before, those of them inside a line, and the elements around it (name, number).

    ``named`` has the elements around it whose names make it boilerplate.
    """

    __slots__ = ("path", "text", "tags", "inline", "dropped", "named")

    def __init__(self, path: tuple[tuple[str, int], ...], text: str, tags: int, inline: int, dropped: bool, named: tuple[Named, ...]):
        self.path, self.text, self.tags, self.inline, self.dropped, self.named = path, text, tags, inline, dropped, named


@dataclass(frozen=True)
class Named:
    """An element named as boilerplate, and all words of its names."""

    number: int
    words: frozenset[str]

    @property
    def notice(self) -> bool:
        return bool(self.words & NOTICES)

    @property
    def only(self) -> bool:
        return self.words <= NAMES


_OUTSIDE = ("", 0, False, False, ())


class Reader(HTMLParser):
    """Lines of a page. Open elements are kept as (name, number, boilerplate by tag, silent, named elements around)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool, tuple[Named, ...]]] = []
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.inline = self.count = 0

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            path = tuple((name, number) for name, number, *_ in self.open)
            *_, dropped, _, named = self.open[-1] if self.open else _OUTSIDE
            self.lines.append(Line(path, text, self.tags, self.inline, dropped, named))
            self.tags = self.inline = 0
        self.parts = []

    def _close(self, names: tuple[str, ...], scopes: frozenset = frozenset()) -> None:
        """Close the innermost open element of these names, if it is not outside a scope."""
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in names:
                if any(n in BLOCKS for n, *_ in self.open[k:]):
                    self._end_line()
                del self.open[k:]
                return
            if name in scopes:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        self.inline += tag not in BLOCKS
        if tag in BLOCKS:
            self._close(("p", "h1", "h2", "h3", "h4", "h5", "h6"), _SCOPES)
            self._end_line()
        if tag in _CLOSES:
            self._close(_CLOSES[tag], _SCOPES - {"td", "th"} if tag == "tr" else _SCOPES)
        if tag == "body":
            self._close(("head",))
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        *_, dropped, silent, named = self.open[-1] if self.open else _OUTSIDE
        self.count += 1
        self.open.append((tag, self.count, *self._kind(tag, attrs, dropped, silent or tag in SILENT, named)))

    def _kind(self, tag: str, attrs: list, dropped: bool, silent: bool, named: tuple[Named, ...]) -> tuple[bool, bool, tuple[Named, ...]]:
        if tag in ("article", "main"):
            named = named and tuple(n for n in named if n.words & READERS)
        if dropped or tag in KEPT:
            return dropped, silent, named
        if tag in BOILERPLATE or any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs):
            return True, silent, named
        words = set(_WORDS.findall(_INSIDE.sub(" ", " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower())))
        if tag == "header":
            words.add("header")
        if words and any(name == "article" for name, *_ in self.open):
            words.discard("header")
        return dropped, silent, (*named, Named(self.count, frozenset(words))) if words & NAMES else named

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self._close((tag,))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        self.inline += tag not in BLOCKS
        if tag in BLOCKS:
            self._end_line()
        if tag not in VOID:
            self._close((tag,))

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][3]):
            self.parts.append(data)

    def read(self, html: str) -> list[Line]:
        self.feed(html)
        self.close()
        self._end_line()
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends there are no lines."""
    radius = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """The border between two clusters: the mean of their means, refined until it stays."""
    border = float(values.mean())
    for _ in range(100):
        upper, lower = values[values >= border], values[values < border]
        if not len(lower):
            break
        moved = float(upper.mean() + lower.mean()) / 2
        if moved == border:
            break
        border = moved
    return border


def dense(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, float]:
    """The ratio of each line, smoothed ratios, and the border above which they are dense."""
    ratios = np.array([0.0 if line.dropped else len(line.text) / max(1, line.tags) for line in lines])
    values = smoothed(ratios)
    return ratios, values, threshold(values)


def judge_names(lines: list[Line]) -> None:
    """Drop lines inside boilerplate by name, unless density shows that the named element surrounds the content.

    So it is if elements of the same names hold most dense characters, and all articles.
    Names that also have other words are asked first; notices among them, and then names of
    boilerplate words only, are asked if no line is left otherwise.
    """
    kept: set[Named] = set()
    yielding = (lambda n: not n.notice and not n.only, lambda n: not n.only, lambda n: not n.notice)
    for may_yield in yielding:
        read = [Line(x.path, x.text, x.tags, x.inline, x.dropped or not all(map(may_yield, x.named)), x.named) for x in lines]
        named = {n.number: n.words for line in read if not line.dropped for n in line.named}
        total, articles = 0, 0
        weight: dict[frozenset[str], list[int]] = {}
        if named:
            _, values, border = dense(read)
            for line, value in zip(read, values.tolist(), strict=True):
                if not line.dropped:
                    high = len(line.text) if value >= border else 0
                    held = len(line.text) if not line.named and any(e[0] in ("article", "main") for e in line.path) else 0
                    total, articles = total + high, articles + held
                    for words in {named[e[1]] for e in line.path if e[1] in named}:
                        now = weight.setdefault(words, [0, 0])
                        now[0], now[1] = now[0] + high, now[1] + held
            kept |= {n for line in read for n in line.named if may_yield(n) and 2 * (w := weight.get(n.words, [0, -1]))[0] > total and w[1] == articles}
        if any(not line.dropped and kept.issuperset(line.named) for line in lines):
            break
    for line in lines:
        line.dropped = line.dropped or not kept.issuperset(line.named)


def content(lines: list[Line]) -> list[str]:
    """Lines of the content region, in page order."""
    if any(line.named for line in lines):
        judge_names(lines)
    eligible = [line for line in lines if not line.dropped]
    if not eligible:
        return []
    ratios, values, border = dense(lines)
    weight: dict[tuple[str, int], int] = {}
    total = 0
    for line, value in zip(lines, values.tolist(), strict=True):
        if not line.dropped and value >= border:
            total += len(line.text)
            for element in line.path:
                weight[element] = weight.get(element, 0) + len(line.text)
    # numbers grow inwards, so the last container with most of the weight is the innermost
    heavy = [e for e, n in weight.items() if e[0] in REGIONS and 2 * n > total]
    if not heavy:
        return [line.text for line in eligible]
    path = next(line.path for line in eligible if max(heavy, key=lambda e: e[1]) in line.path)
    around = path[: path.index(max(heavy, key=lambda e: e[1])) + 1]
    held = [e for e in around if e[0] in ("article", "main")]
    if held:
        best = held[-1]
    else:
        upper = (values >= border) & (ratios > 0)
        # smoothing and the tags of containers lower dense lines at the ends of the text: there a line counts by its own element's two tags
        alone = [not line.dropped and len(line.text) / (2 + line.inline) >= border for line in lines]
        for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):
            for k in order:
                upper[k] |= alone[k] and upper[k - order.step]
        shared = set(around).intersection(*(line.path for line, high in zip(lines, upper.tolist(), strict=True) if high))
        whole = [e for e in around if e in shared and e[0] in REGIONS]
        if not whole:
            return [line.text for line in eligible]
        best = whole[-1]
        for parent in reversed(around[: around.index(best)]):  # a heading right above the region belongs to it
            outside = [line for line in eligible if parent in line.path and best not in line.path]
            if parent[0] not in REGIONS or not all(any(e[0] in HEADINGS for e in line.path) for line in outside):
                break
            best = parent
    return [line.text for line in eligible if best in line.path]


def main_text(html: str) -> str:
    return "\n\n".join(content(Reader().read(html))) if html else ""


def _extract(column: pa.Array) -> pa.Array:
    return pa.array([main_text(t) for t in texts(column)], pa.string())


def extract(html: Column) -> Column:
    """The main text of each page, empty if there is none."""
    return F.arrow_udf(_extract, "string")(html)
