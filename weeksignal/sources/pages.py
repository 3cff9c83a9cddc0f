"""Web pages: text extraction, link lists and crawl bookkeeping."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT_TAGS = frozenset(["script", "style", "template"])
BODY_CLASS = re.compile(r"content|article|body|main", re.IGNORECASE)


class _Watcher(HTMLParser):
    """Collects the text pieces of the elements that one of ``rules`` asks for.

    A rule maps a name to a test on (tag, classes). Only the first matching element
    of a rule is kept, except for rules in ``every``. An end tag closes all elements
    opened since its start tag; one without a start tag is ignored.
    """

    def __init__(self, rules, every=()):
        super().__init__(convert_charrefs=True)
        self.rules, self.every = rules, frozenset(every)
        self.stack: list[tuple[str, list]] = []
        self.open: list[list[str]] = []
        self.silent = 0
        self.found: dict[str, list[list[str]]] = {name: [] for name in rules}
        self.attrs: dict[str, dict] = {}
        self.joined = False

    def handle_starttag(self, tag, attrs):
        self.joined = False
        values = {k: (v or "") for k, v in attrs}
        classes = values.get("class", "").split()
        started = []
        for name, test in self.rules.items():
            if (name in self.every or not self.found[name]) and test(tag, classes):
                pieces: list[str] = []
                self.found[name].append(pieces)
                self.attrs.setdefault(name, values)
                started.append(pieces)
        if tag in VOID_TAGS:
            return
        self.open.extend(started)
        self.silent += tag in SILENT_TAGS
        self.stack.append((tag, started))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.joined = False
        if not any(name == tag for name, _ in self.stack):
            return
        while self.stack:
            name, started = self.stack.pop()
            self.silent -= name in SILENT_TAGS
            for pieces in started:
                self.open = [p for p in self.open if p is not pieces]
            if name == tag:
                break

    def handle_comment(self, data):
        self.joined = False

    def handle_data(self, data):
        if self.silent:
            return
        for pieces in self.open:
            if self.joined and pieces:
                pieces[-1] += data
            else:
                pieces.append(data)
        self.joined = True


def _watch(html: str, rules, every=()) -> _Watcher:
    watcher = _Watcher(rules, every)
    watcher.feed(html or "")
    watcher.close()
    return watcher


def _text(pieces: list[str], separator: str = "") -> str:
    return separator.join(s for s in (p.strip() for p in pieces) if s)


def _tag(name: str):
    return lambda tag, classes: tag == name


def _issue(html: str) -> tuple[str, str, str]:
    """Title and body of a newsletter issue page."""
    w = _watch(
        html,
        {
            "h1": _tag("h1"),
            "title": _tag("title"),
            "body": lambda tag, cs: tag == "div"
            and (any(BODY_CLASS.search(c) for c in cs) or bool(cs and BODY_CLASS.search(" ".join(cs)))),
            "p": _tag("p"),
        },
        every=["p"],
    )
    heading = (w.found["h1"] or w.found["title"] or [[]])[0]
    if w.found["body"]:
        text = _text(w.found["body"][0], " ")
    else:
        text = " ".join(_text(p) for p in w.found["p"])
    return _text(heading), text, ""


def _post(html: str) -> tuple[str, str, str]:
    """Body of a blog post page, by the first container that exists."""
    div = lambda name: lambda tag, cs: tag == "div" and name in cs
    w = _watch(
        html, {"available": div("available-content"), "post": div("post-content"), "article": _tag("article")}
    )
    for name in ("available", "post", "article"):
        if w.found[name]:
            return "", _text(w.found[name][0], " "), ""
    return "", "", ""


def _archive_issue(html: str) -> tuple[str, str, str]:
    """Title, body and date of an archived issue page."""
    w = _watch(
        html, {"h1": _tag("h1"), "article": _tag("article"), "main": _tag("main"), "time": _tag("time")}
    )
    body = w.found["article"] or w.found["main"]
    date = ""
    if w.found["time"]:
        date = w.attrs["time"].get("datetime", _text(w.found["time"][0]))[:10]
    title = _text(w.found["h1"][0]) if w.found["h1"] else ""
    return title, _text(body[0], " ") if body else "", date


# Pages that are Python objects at a time.
_PAGES = 64

LAYOUTS = {"issue": _issue, "post": _post, "archive": _archive_issue}


def html_extract(pages: DataFrame, layout: str, html: str = "html", min_chars: int | None = None) -> DataFrame:
    """Replace the HTML column by title, text and date.

    ``post`` takes its title and fallback text from columns ``title``, ``description``
    and ``subtitle`` where the table has them. Issue pages with less than 100
    characters of text are dropped.
    """
    parse = LAYOUTS[layout]
    keep = [c for c in pages.columns if c not in (html, "title", "text", "date")]
    meta = [c for c in ("title", "description", "subtitle") if c in pages.columns]
    kept = [f for f in pages.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", title string, text string, date string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PAGES):
                part = batch.slice(at, _PAGES)
                titles, texts, dates = zip(*(parse(h) for h in part.column(html).to_pylist()), strict=True)
                if layout == "post":
                    if "title" in meta:
                        titles = [t or "" for t in part.column("title").to_pylist()]
                    for column in ("description", "subtitle"):
                        if column in meta:
                            texts = [t if t != "" else other or "" for t, other in zip(texts, part.column(column).to_pylist(), strict=True)]
                made = [pa.array(values, pa.string()) for values in (titles, texts, dates)]
                yield pa.record_batch([*(part.column(f.name) for f in kept), *made], [*(f.name for f in kept), "title", "text", "date"])

    wanted = list(dict.fromkeys([*keep, *meta, html]))
    parsed = pages.select(*wanted).mapInArrow(run, schema)
    limit = 100 if min_chars is None and layout == "issue" else min_chars
    return parsed if limit is None else parsed.where(F.char_length("text") >= limit)


class _Anchors(HTMLParser):
    """Addresses of the links of a page, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [value for name, value in attrs if name == "href" and value is not None][:1]

    handle_startendtag = handle_starttag


def page_links(html: str | None) -> list[str]:
    """Links by the parser: any quoting and case, references decoded, none from comments or scripts."""
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    return parser.links


def extract_links(
    pages: DataFrame,
    pattern: str = r"/the-batch/issue-\d+",
    base: str = "https://www.deeplearning.ai",
    max_links: int = 100,
    html: str = "html",
) -> DataFrame:
    """Distinct links of each page that match ``pattern``, absolute, in page order."""
    @F.pandas_udf("array<string>")
    def found(batch: pd.Series) -> pd.Series:
        return batch.map(page_links)

    hrefs = found(F.col(html))
    wanted = F.filter(hrefs, lambda h: h.rlike(pattern))
    absolute = F.transform(wanted, lambda h: F.when(h.startswith("/"), F.concat(F.lit(base), h)).otherwise(h))
    links = F.slice(F.array_distinct(absolute), 1, max_links)
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(links).alias("position", "link"))


def weekdays(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """All Mondays to Fridays between two dates per row, both included."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr("interval 1 day"))
    keep = [c for c in bounds.columns if c not in (start, end)]
    rows = bounds.select(*keep, F.explode(days).alias("_day")).where(F.weekday("_day") < 5)
    return rows.select(*keep, F.date_format("_day", "yyyy-MM-dd").alias("date"))


def date_chunks(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Calendar-year ranges that cover the span from ``start`` to ``end``."""
    years = F.sequence(F.year(start), F.year(end))
    rows = bounds.select(F.explode(years).alias("_y"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    first = F.greatest(F.make_date("_y", F.lit(1), F.lit(1)), F.col("_s"))
    last = F.least(F.make_date("_y", F.lit(12), F.lit(31)), F.col("_e"))
    return rows.select(
        F.date_format(first, "yyyy-MM-dd").alias("chunk_start"), F.date_format(last, "yyyy-MM-dd").alias("chunk_end")
    )


def resume_pending(wanted: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``wanted`` whose key is not stored yet."""
    return wanted.join(stored.select(*keys).distinct(), keys, "left_anti")
