import json

import pytest

from weeksignal import schemas
from weeksignal.sources import files, pages, payloads


def extract(spark, html, layout, **meta):
    df = spark.createDataFrame([(1, html, *meta.values())], ["page_id", "html", *meta])
    return pages.html_extract(df, layout).first()


BODY = "words " * 30


def test_issue_page(spark):
    html = f"<title>T</title><div class='ad'>x</div><h1> A <b>b</b></h1><div class='x-Main y'>{BODY}<script>no</script><!-- no --><p>end</div>after"
    r = extract(spark, html, "issue")
    assert r.title == "Ab" and r.text == BODY.strip() + " end"


def test_issue_page_falls_back_to_paragraphs_and_title(spark):
    r = extract(spark, f"<title>T &amp; U</title><p>{BODY}</p><br/><p>two<b> x</b></p>", "issue")
    assert r.title == "T & U" and r.text == BODY.strip() + " twox"
    assert extract(spark, "<p>short</p>", "issue") is None


def test_post_page(spark):
    html = "<article>later</article><div class='post-content a'>second</div><div class='available-content'>first <i>one</i></div>"
    r = extract(spark, html, "post", title="Meta", description="d")
    assert (r.title, r.text) == ("Meta", "first one")
    r = extract(spark, "<p>none</p>", "post", title="Meta", description="", subtitle="sub")
    assert r.text == "sub"


def test_archive_page(spark):
    r = extract(spark, "<h1>H</h1><main>m<main>n</main></main><time datetime='2024-05-06T01:00'>May</time>", "archive")
    assert (r.title, r.text, r.date) == ("H", "m n", "2024-05-06")
    r = extract(spark, "<article>a</article><main>m</main><time> 2024-05-07 noon</time></b>", "archive")
    assert (r.title, r.text, r.date) == ("", "a", "2024-05-07")


def test_links_keep_first_occurrence(spark):
    html = '<a href="/the-batch/issue-2/">x</a><a class="c" href="/the-batch/issue-10">y</a><a href="/other">z</a><a href="/the-batch/issue-2/">x</a>'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.link for r in pages.extract_links(df).collect()] == [
        "https://www.deeplearning.ai/the-batch/issue-2/", "https://www.deeplearning.ai/the-batch/issue-10",
    ]
    assert pages.extract_links(df, max_links=1).count() == 1


@pytest.mark.parametrize("html, links", [
    ("<A HREF=/x>1</A><a class=b href = '/y'>2</a>", ["/x", "/y"]),
    ('<a href="/a?x=1&amp;y=2">', ["/a?x=1&y=2"]),
    ('<!-- <a href="/no"> --><script>"<a href=/no>"</script><a name="n">', []),
    ("<a href=/cut", []), ("", []), (None, []),
])
def test_links_by_the_parser(html, links):
    assert pages.page_links(html) == links


def test_calendar_and_pending(spark):
    span = spark.sql("select date'2024-02-28' as start, date'2024-03-05' as end")
    days = pages.weekdays(span)
    assert [r.date for r in days.orderBy("date").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-04", "2024-03-05"]
    done = spark.createDataFrame([("2024-03-01",)], "date string")
    assert pages.resume_pending(days, done, ["date"]).count() == 4
    chunks = pages.date_chunks(spark.sql("select date'2023-01-01' as start, date'2024-03-05' as end")).orderBy("chunk_start")
    assert [tuple(r) for r in chunks.collect()] == [("2023-01-01", "2023-12-31"), ("2024-01-01", "2024-03-05")]


def landed(tmp_path, rows):
    path = tmp_path / "responses.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_story_hits(spark, tmp_path):
    path = landed(tmp_path, [{"query": "gpu", "hits": [
        {"title": "A", "url": None, "points": 3, "created_at": "2024-12-30T10:00:00Z", "objectID": "7"}, {"title": "B", "created_at": ""}, {"title": "C"}]}])
    rows = payloads.stories(payloads.read_responses(spark, path, schemas.HN_RESPONSE)).collect()
    assert [(r.title, r.url, r.points, r.num_comments, r.published, r.week, r.hn_id) for r in rows] == [("A", "", 3, 0, "2024-12-30", "2025-W01", "7")]


def test_posts_repos_papers(spark, tmp_path):
    path = landed(tmp_path, [{"subreddit": "s", "data": [{"id": "x", "title": "t", "selftext": None, "created_utc": 1700000000, "permalink": "/r/s/x"}]}])
    r = payloads.posts(payloads.read_responses(spark, path, schemas.REDDIT_RESPONSE)).first()
    assert (r.text, r.published, r.week, r.url) == ("", "2023-11-14", "2023-W46", "https://reddit.com/r/s/x")
    path = landed(tmp_path, [{"query": "q", "items": [{"id": 5, "full_name": "a/b", "description": None, "topics": ["x", "y"], "created_at": "2024-01-02T00:00:00Z"}]}])
    r = payloads.repositories(payloads.read_responses(spark, path, schemas.GITHUB_RESPONSE)).first()
    assert (r.repo_id, r.description, r.topics, r.language, r.stars, r.week) == ("5", "", "x, y", "", 0, "2024-W01")
    path = landed(tmp_path, [{"query": "q", "data": [{"paperId": "p", "publicationDate": None, "year": 2024}, {"paperId": "r", "publicationDate": "2024-01-02", "year": 2024}]}])
    rows = payloads.papers(payloads.read_responses(spark, path, schemas.S2_RESPONSE)).collect()
    assert [(r.published, r.url) for r in rows] == [("2024", "https://www.semanticscholar.org/paper/p"), ("2024-01-02", "https://www.semanticscholar.org/paper/r")]


def test_broken_responses_are_set_aside(spark, tmp_path):
    good = json.dumps({"query": "q", "hits": [{"title": "A", "created_at": "2024-01-02T00:00:00Z"}, None, {"title": "B", "created_at": "2024-01-03T00:00:00Z"}]})
    wrong = json.dumps({"query": "q", "hits": [{"title": "C", "points": "many", "created_at": "2024-01-02T00:00:00Z"}]})
    bodies = [good, good, good[:-3], wrong, None, " ", "{}", "no json"]
    df = spark.createDataFrame(list(enumerate(bodies)), "page long, body string")
    landed = payloads.land_responses(df, "body", schemas.HN_RESPONSE, str(tmp_path / "landed"), ("page",))
    assert landed.counts == {"read": 8, "parsed": 3, "missing": 2, "broken": 3}
    assert sorted(r.title for r in payloads.stories(landed.rows).collect()) == ["A", "A", "B", "B"]
    aside = {r.page: (r.outcome, r.body) for r in landed.aside.collect()}
    assert aside == {2: ("broken", bodies[2]), 3: ("broken", wrong), 4: ("missing", None), 5: ("missing", " "), 7: ("broken", "no json")}
    empty = payloads.land_responses(df.limit(0), "body", schemas.HN_RESPONSE, str(tmp_path / "none"))
    assert empty.counts["read"] == 0 and empty.rows.count() == 0 and empty.aside.count() == 0


def test_atom_feed(spark, tmp_path):
    entry = "<entry><id> http://x/{d} </id><title>\n T </title><summary> S\n</summary><published>{d}T01:00:00Z</published></entry>"
    feed = '<feed xmlns="http://www.w3.org/2005/Atom">' + "".join(entry.format(d=d) for d in ("2023-12-31", "2024-01-01", "2024-06-01")) + "</feed>"
    (tmp_path / "feed.xml").write_text(feed)
    entries = payloads.read_atom(spark, str(tmp_path / "feed.xml")).selectExpr("*", "'cs' as query")
    rows = payloads.atom_papers(entries, "2024-01-01", "2024-05-31").collect()
    assert [(r.title, r.abstract, r.published, r.citation_count, r.url) for r in rows] == [("T", "S", "2024-01-01", None, "http://x/2024-01-01")]


def test_csv_round_trip(spark, tmp_path):
    rows = [("s", "2024-01-01", 'say "hi"', "u", " two\nlines, and more "), ("s", "", "", "v", "x")]
    df = spark.createDataFrame(rows, schemas.RAW_NEWSLETTER)
    files.write_table(df, str(tmp_path / "t"), "csv")
    back = files.scan_typed_csv(spark, str(tmp_path / "t"), schemas.RAW_NEWSLETTER)
    assert {(r.title or "", r.text) for r in back.collect()} == {(t, x) for _, _, t, _, x in rows}


def test_sources_without_text_drop_out(spark):
    a = spark.createDataFrame([("t" * 15, "b" * 10, "2024-01-01")], "title string, abstract string, published string")
    b = spark.createDataFrame([("x" * 30,)], "title string")
    c = spark.createDataFrame([(1,)], "n int")
    out = files.scan_sources({"arxiv": a, "hackernews": b, "reddit": c}, files.SIGNAL_SOURCES).collect()
    assert sorted((r.source, len(r.combined_text), r.date) for r in out) == [("arxiv", 26, "2024-01-01"), ("hackernews", 30, "")]
