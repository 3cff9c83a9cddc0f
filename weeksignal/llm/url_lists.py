"""URL filters whose lists change over time.

Dated list entries (add or remove a pattern) become intervals of validity, and each capture
is judged by the entries that were active on the day it was fetched. A pattern is a host,
which holds for its subdomains too, or a host with the beginning of a path, segment by segment.

The as-of join is an equality join on (pattern, month), intervals standing once for each of
their months, with the exact days compared behind it. So a host with a third of all captures
is spread over months and then split further by the adaptive skew join; intervals of one
pattern in one month are few, since entries are first reduced to the last one of each day.

Defined cases: a null or malformed url has no pattern and is never listed; entries without
pattern, list or day are void; of several entries of one day for a pattern the largest by
(order, action) counts; an entry holds from its day on; repeated rows of captures are judged
one by one; without entries nothing is listed; an empty table gives an empty result; further
columns stay as they are, whatever their names, but columns of the captures that are named
``n_active`` or ``lists`` give way to the result. Patterns are read as urls are: the host in
small letters, without empty labels or segments; one without a host is void.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)"


def host(url: Column) -> Column:
    """The host in small letters, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def segments(url: Column) -> Column:
    """The path's non-empty segments."""
    return F.filter(F.split(F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit("")), "/"), lambda s: s != "")


def patterns(url: Column, depth: int) -> Column:
    """All patterns that hold for a url: every suffix of the host, with up to ``depth`` path segments."""
    labels = F.filter(F.split(host(url), r"\."), lambda s: s != "")
    count = F.size(labels)
    suffixes = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda k: F.concat_ws(".", F.slice(labels, k, count))))
    suffixes = F.coalesce(suffixes, F.array().cast("array<string>"))
    path = F.slice(segments(url), 1, depth)
    starts = F.transform(F.sequence(F.lit(0), F.size(path)), lambda n: F.concat_ws("", F.transform(F.slice(path, 1, n), lambda s: F.concat(F.lit("/"), s))))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h, p)))))


def normal(pattern: Column) -> Column:
    """A pattern as ``patterns`` writes it; null without a host."""
    parts = F.split(pattern, "/")
    labels = F.filter(F.split(F.lower(F.element_at(parts, 1)), r"\."), lambda s: s != "")
    path = F.filter(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda s: s != "")
    return F.when(F.size(labels) > 0, F.concat_ws("/", F.concat_ws(".", labels), path))


def intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, since, until (exclusive, null for ever) from list, pattern, day, action, order."""
    read = entries.select("list", normal(F.col("pattern")).alias("pattern"), "day", "action", "order")
    valid = read.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
    daily = valid.groupBy("list", "pattern", "day").agg(F.max(F.struct("order", "action")).alias("last"))
    following = F.expr("lead(day) OVER (PARTITION BY list, pattern ORDER BY day)")
    dated = daily.select("list", "pattern", F.col("day").alias("since"), following.alias("until"), "last.action")
    return dated.where("action = 'add'").drop("action")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def judge(captures: DataFrame, entries: DataFrame, depth: int = 1) -> DataFrame:
    """The captures (url, day and any others) with ``lists``, the sorted lists that hold then, and ``n_active`` entries.

    ``depth`` is the most path segments that a pattern has. A url that was fetched often on
    one day is judged once.
    """
    last = captures.agg(F.max("day")).first()[0]
    until = F.least(F.coalesce(F.date_sub("until", 1), F.lit(last)), F.lit(last))
    spans = intervals(entries).where(F.col("since") <= F.lit(last))
    months = F.explode(F.sequence(_month(F.col("since")), _month(until)))
    spans = spans.select("list", "pattern", "since", "until", months.alias("month")).alias("s")
    cases = captures.where("url IS NOT NULL AND day IS NOT NULL").select("url", "day").distinct()
    keys = cases.select("url", "day", _month(F.col("day")).alias("month"), F.explode(patterns(F.col("url"), depth)).alias("pattern"))
    keys = keys.alias("k")
    same = (F.col("k.pattern") == F.col("s.pattern")) & (F.col("k.month") == F.col("s.month"))
    active = (F.col("s.since") <= F.col("k.day")) & (F.col("s.until").isNull() | (F.col("k.day") < F.col("s.until")))
    met = keys.join(spans, same & active).groupBy("k.url", "k.day").agg(
        F.count(F.lit(1)).alias("n_active"), F.sort_array(F.collect_set("s.list")).alias("lists")
    )
    rows = captures.select(F.struct(*[captures[f"`{c}`"] for c in captures.columns]).alias("row"))
    same = (F.col("c.row").getField("url") == F.col("m.url")) & (F.col("c.row").getField("day") == F.col("m.day"))
    found = rows.alias("c").join(met.alias("m"), same, "left")
    own = [F.col("c.row").getField(c).alias(c) for c in captures.columns if c not in ("n_active", "lists")]
    none = F.array().cast("array<string>")
    return found.select(*own, F.coalesce("m.n_active", F.lit(0)).alias("n_active"), F.coalesce("m.lists", none).alias("lists"))
