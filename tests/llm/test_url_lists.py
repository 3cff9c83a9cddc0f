"""URL lists against looking at every entry for every capture."""

import datetime
import random

from weeksignal.llm import url_lists

DAY = datetime.date(2024, 1, 1)


def holds(url, pattern):
    if not url or "://" not in url:
        return False
    rest = url.split("://", 1)[1]
    host, _, path = rest.partition("/")
    host, path = host.lower(), "/".join(s for s in path.split("?")[0].split("#")[0].split("/") if s)
    p_host, _, p_path = pattern.partition("/")
    return (host == p_host or host.endswith("." + p_host)) and (not p_path or path == p_path or path.startswith(p_path + "/"))


def plain(captures, entries):
    out = []
    for key, url, day in captures:
        last = {}
        for name, pattern, since, action, order in entries:
            if None not in (name, pattern, since, day) and since <= day and holds(url, pattern):
                last[name, pattern] = max(last.get((name, pattern), (DAY - datetime.timedelta(9), 0, "")), (since, order, action))
        on = [name for (name, _), (_, _, action) in last.items() if action == "add"]
        out.append((key, len(on), sorted(set(on))))
    return sorted(out, key=str)


def run(spark, captures, entries):
    c = spark.createDataFrame(captures, "key long, url string, day date")
    e = spark.createDataFrame(entries, "list string, pattern string, day date, action string, order long")
    return sorted(((r["key"], r["n_active"], r["lists"]) for r in url_lists.judge(c, e).collect()), key=str)


def test_equals_every_entry_for_every_capture(spark):
    rng = random.Random(8)
    day = lambda: DAY + datetime.timedelta(rng.randrange(200))
    hosts, paths = ["a.com", "x.a.com", "A.com", "b.org", "aa.com"], ["", "/", "/p", "/p/q?x=1", "/pp#f", "/q/p"]
    captures = [(k, f"http://{rng.choice(hosts)}{rng.choice(paths)}", day()) for k in range(150)] + [(900, None, DAY), (901, "nonsense", DAY), (902, "http://a.com", None)]
    captures += captures[:20]
    entries = [(rng.choice("LMN"), rng.choice(["a.com", "com", "x.a.com", "a.com/p", "b.org/q"]), day(), rng.choice(["add", "add", "remove"]), k) for k in range(60)]
    entries += [(None, "a.com", DAY, "add", 1), ("L", None, DAY, "add", 1), ("L", "a.com", None, "add", 1)]
    assert run(spark, captures, entries) == plain(captures, entries)


def test_same_day_boundaries_and_empty_tables(spark):
    d = lambda k: DAY + datetime.timedelta(k)
    entries = [("L", "a.com", d(5), "add", 1), ("L", "a.com", d(9), "remove", 1), ("L", "a.com", d(9), "add", 0), ("L", "a.com", d(20), "add", 1)]
    captures = [(k, "https://www.a.com/z", d(k)) for k in (4, 5, 8, 9, 19, 20, 400)]
    assert run(spark, captures, entries) == plain(captures, entries)
    assert [n for _, n, _ in run(spark, captures, [])] == [0] * 7
    assert run(spark, [], entries) == []


def test_clashing_columns_and_patterns_in_capitals(spark):
    entries = spark.createDataFrame(
        [("L", "A.org", DAY, "add", 1), ("M", "a.ORG./P/", DAY, "add", 1), ("N", "/p", DAY, "add", 1)], "list string, pattern string, day date, action string, order long"
    )
    captures = spark.createDataFrame(
        [("http://a.org/P", DAY, 1, "x", 2, 3, 4, 5, 6)],
        "url string, day date, names int, lists string, met int, `row` int, pattern int, month int, `a.b` int",
    )
    out = url_lists.judge(captures, entries.withColumn("names", entries["order"]))
    assert out.columns == ["url", "day", "names", "met", "row", "pattern", "month", "a.b", "n_active", "lists"]
    assert tuple(out.first())[2:] == (1, 2, 3, 4, 5, 6, 2, ["L", "M"])
