"""Scans, sinks, payloads, pages and crawl bookkeeping over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weeksignal import schemas
from weeksignal.catalog.common import SIG, Registry, feature_table, signals
from weeksignal.catalog.evaluation_queries import SPLIT
from weeksignal.operators import evaluate
from weeksignal.session import scratch_path
from weeksignal.sources import adapters, files, pages, payloads

reg = Registry()


@reg.add("scan_sources", """WITH u AS (
    SELECT 'documents' AS source, text AS t, strftime(DATE '2023-01-01' + (doc_id % 700)::INT, '%Y-%m-%d') AS date FROM documents
    UNION ALL SELECT 'conversations', role || ' ' || text, '' FROM conversations
    UNION ALL SELECT 'benchmark', text, '' FROM benchmark UNION ALL SELECT 'pages', url || ' ' || html, '' FROM pages)
  SELECT source, md5(t) AS digest, length(t) AS chars, date FROM u WHERE length(t) > 20""")
def _scan_sources(spark, d):
    tables = {name: adapters.table(spark, d, name) for name in ("conversations", "benchmark", "pages", "labels")}
    tables["documents"] = adapters.dated_documents(spark, d)
    configs = {
        "documents": files.SourceConfig(("text", "abstract"), "date"),
        "conversations": files.SourceConfig(("role", "text")),
        "benchmark": files.SourceConfig(("text",)),
        "pages": files.SourceConfig(("url", "html")),
        "labels": files.SourceConfig(("title",)),
    }
    out = files.scan_sources(tables, configs)
    return out.select(
        "source", F.md5("combined_text").alias("digest"), F.char_length("combined_text").cast("long").alias("chars"), "date"
    )


@reg.add("scan_typed_csv", """SELECT source, strftime(DATE '2023-01-01' + (doc_id % 700)::INT, '%Y-%m-%d') AS date, lang AS title, doc_id::VARCHAR AS url,
  md5(text) AS digest FROM documents""")
def _csv(spark, d):
    docs = adapters.dated_documents(spark, d).select(
        "source", "date", F.col("lang").alias("title"), F.col("doc_id").cast("string").alias("url"), "text"
    )
    path = scratch_path(spark, "newsletters-csv")
    files.write_table(docs, path, "csv")
    back = files.scan_typed_csv(spark, path, schemas.RAW_NEWSLETTER)
    return back.select("source", "date", "title", "url", F.md5("text").alias("digest"))


@reg.add("append_records", """SELECT source, count(*) * 2 AS n, sum(length(text))::BIGINT * 2 AS chars FROM documents WHERE length(text) > 50 GROUP BY 1""")
def _append(spark, d):
    path = scratch_path(spark, "appended")
    docs = adapters.dated_documents(spark, d)
    files.append_records(docs, path)
    files.append_records(docs, path)
    stored = spark.read.schema(docs.schema).parquet(path)
    return stored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text").cast("long")).alias("chars")
    )


@reg.add("checkpoint_sink", f"{SIG} SELECT source, count(*) AS n FROM sig GROUP BY 1")
def _checkpoint(spark, d):
    path = scratch_path(spark, "by-source")
    rows = signals(spark, d)
    files.checkpoint_sink(rows, path)
    # A second run of one source replaces that source only.
    files.checkpoint_sink(rows.where(F.col("source") == "arxiv"), path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@reg.add("write_splits", f"""{SPLIT} SELECT split, count(*) AS rows, sum(label_next2wk)::BIGINT AS positives FROM parted GROUP BY 1""")
def _splits(spark, d):
    path = scratch_path(spark, "splits")
    files.write_splits(evaluate.temporal_split(feature_table(spark, d)), path)
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label_next2wk").alias("positives")
    )


# --- payloads: responses are built from table rows, landed, then parsed ------------------
#
# A response holds the records of ``PAGE`` consecutive ids and a null record behind them. Of nine
# responses one is cut off and one has no body; these are set aside, so their records do not appear.

PAGE = 20


def _landed(spark, rows, page, record, query: str, array: str, schema: str):
    """``rows`` with a column ``query``, as landed responses of several records each."""
    grouped = rows.select("query", F.floor(page / PAGE).alias("page"), record.alias("record")).groupBy("query", "page").agg(
        F.collect_list("record").alias("records")
    )
    nothing = F.lit(None).cast(grouped.schema["records"].dataType.elementType)
    body = F.to_json(F.struct(F.col("query").alias(query), F.concat("records", F.array(nothing)).alias(array)))
    turn = F.pmod("page", F.lit(9))
    body = F.when(turn == 4, F.left(body, F.length(body) - 2)).when(turn != 7, body)
    return payloads.land_responses(grouped.select(body.alias("body")), "body", schema, scratch_path(spark, f"landed-{array}"))


def _whole(page: str) -> str:
    return f"(({page}) // {PAGE}) % 9 NOT IN (4, 7)"


def _hit_responses(spark, d):
    e = adapters.table(spark, d, "events")
    hit = F.struct(
        F.concat_ws(" ", "event_type", "event_id").alias("title"),
        F.col("user_id").cast("string").alias("author"),
        F.floor("value").alias("points"),
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_at"),
        F.col("event_id").cast("string").alias("objectID"),
    )
    return _landed(spark, e.withColumn("query", F.col("event_type")), F.col("event_id"), hit, "query", "hits", schemas.HN_RESPONSE)


def _post_responses(spark, d):
    """Orders are posts without a text, turns of conversations posts with one."""
    o, c = adapters.table(spark, d, "orders"), adapters.table(spark, d, "conversations")
    orders = o.select(
        F.col("o_orderpriority").alias("query"), F.col("o_orderkey").alias("page"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("title"), F.lit(None).cast("string").alias("selftext"), F.col("o_custkey").cast("string").alias("author"),
        F.floor("o_totalprice").alias("score"), F.unix_timestamp("o_orderdate").cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), "o_orderkey").alias("permalink"),
    )
    key = F.concat_ws("-", "conv_id", "turn")
    turns = c.select(
        F.col("role").alias("query"), F.col("conv_id").alias("page"), key.alias("id"), F.lit("turn").alias("title"),
        F.col("text").alias("selftext"), F.col("conv_id").cast("string").alias("author"), F.col("turn").alias("score"),
        (F.pmod("conv_id", F.lit(700)) * 86_400).cast("double").alias("created_utc"), F.concat(F.lit("/r/"), key).alias("permalink"),
    )
    rows = orders.unionByName(turns)
    post = F.struct(*[c for c in rows.columns if c not in ("query", "page")])
    return _landed(spark, rows, F.col("page"), post, "subreddit", "data", schemas.REDDIT_RESPONSE)


def _repo_responses(spark, d):
    p = adapters.table(spark, d, "part")
    created = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd'T'00:00:00'Z'")
    repo = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("full_name"), F.col("p_size").alias("stargazers_count"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("language"), F.array("p_brand", "p_type").alias("topics"),
        created.alias("created_at"), F.concat(F.lit("https://github.com/"), "p_partkey").alias("html_url"),
    )
    return _landed(spark, p.withColumn("query", F.col("p_brand")), F.col("p_partkey"), repo, "query", "items", schemas.GITHUB_RESPONSE)


def _paper_responses(spark, d):
    docs = adapters.table(spark, d, "documents")
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("doc_id", F.lit(700)).cast("int"))
    paper = F.struct(
        F.col("doc_id").cast("string").alias("paperId"), F.col("source").alias("title"), F.col("text").alias("abstract"),
        F.when(F.pmod("doc_id", F.lit(2)) == 0, F.date_format(day, "yyyy-MM-dd")).alias("publicationDate"),
        (F.lit(2000) + F.pmod("doc_id", F.lit(25))).alias("year"), F.col("n_chars").alias("citationCount"),
    )
    return _landed(spark, docs.withColumn("query", F.col("lang")), F.col("doc_id"), paper, "query", "data", schemas.S2_RESPONSE)


@reg.add("json_hits_to_table", f"""SELECT 'hackernews' AS source, event_type AS query, event_type || ' ' || event_id AS title, '' AS url, user_id::VARCHAR AS author,
  floor(value)::BIGINT AS points, 0::BIGINT AS num_comments, strftime(ts, '%Y-%m-%d') AS published, strftime(ts, '%G-W%V') AS week, event_id::VARCHAR AS hn_id
  FROM events WHERE event_type <> 'error' AND {_whole('event_id')}""")
def _hits(spark, d):
    return payloads.stories(_hit_responses(spark, d).rows)


@reg.add("json_posts_to_table", f"""WITH p AS (
    SELECT o_orderkey AS page, o_orderpriority AS subreddit, o_orderstatus AS title, '' AS text, o_custkey::VARCHAR AS author,
      floor(o_totalprice)::BIGINT AS score, o_orderdate::DATE AS day, o_orderkey::VARCHAR AS post_id FROM orders
    UNION ALL SELECT conv_id, role, 'turn', coalesce(text, ''), conv_id::VARCHAR, turn, DATE '1970-01-01' + (conv_id % 700)::INT, conv_id || '-' || turn FROM conversations)
  SELECT 'reddit' AS source, subreddit, title, text, author, score, 0::BIGINT AS num_comments, strftime(day, '%Y-%m-%d') AS published,
    strftime(day, '%G-W%V') AS week, post_id, 'https://reddit.com/r/' || post_id AS url FROM p WHERE {_whole('page')}""")
def _posts(spark, d):
    return payloads.posts(_post_responses(spark, d).rows)


@reg.add("json_repos_to_table", f"""SELECT 'github' AS source, p_brand AS query, p_partkey::VARCHAR AS repo_id, p_name AS name, '' AS description, p_size::BIGINT AS stars,
  0::BIGINT AS forks, CASE WHEN p_size > 25 THEN p_type ELSE '' END AS language, p_brand || ', ' || p_type AS topics,
  strftime(DATE '2023-01-01' + p_size, '%Y-%m-%d') AS published, strftime(DATE '2023-01-01' + p_size, '%G-W%V') AS week, 'https://github.com/' || p_partkey AS url
  FROM part WHERE {_whole('p_partkey')}""")
def _repos(spark, d):
    return payloads.repositories(_repo_responses(spark, d).rows)


@reg.add("json_papers_to_table", f"""SELECT 'semantic_scholar' AS source, lang AS query, source AS title, coalesce(text, '') AS abstract,
  CASE WHEN doc_id % 2 = 0 THEN strftime(DATE '2023-01-01' + (doc_id % 700)::INT, '%Y-%m-%d') ELSE (2000 + doc_id % 25)::VARCHAR END AS published,
  n_chars AS citation_count, 'https://www.semanticscholar.org/paper/' || doc_id AS url FROM documents WHERE {_whole('doc_id')}""")
def _papers(spark, d):
    return payloads.papers(_paper_responses(spark, d).rows)


def _counts_sql(source: str, query: str, page: str, table: str) -> str:
    return f"""SELECT '{source}' AS source, count(*) AS "read", count(*) FILTER (page % 9 NOT IN (4, 7)) AS parsed,
      count(*) FILTER (page % 9 = 7) AS missing, count(*) FILTER (page % 9 = 4) AS broken FROM (SELECT DISTINCT {query} AS q, {page} // {PAGE} AS page FROM {table})"""


@reg.add("payload_quarantine", " UNION ALL ".join([
    _counts_sql("hackernews", "event_type", "event_id", "events"), _counts_sql("github", "p_brand", "p_partkey", "part"),
    _counts_sql("semantic_scholar", "lang", "doc_id", "documents"),
]))
def _quarantine(spark, d):
    """How many responses of each kind were read, parsed and set aside; the stored ones are counted again."""
    made = {"hackernews": _hit_responses, "github": _repo_responses, "semantic_scholar": _paper_responses}
    parts = []
    for source, responses in made.items():
        landed = responses(spark, d)
        stored = [F.count_if(F.col("outcome") == name).alias(name) for name in ("missing", "broken")]
        counted = landed.aside.agg(*stored)
        parts.append(counted.select(
            F.lit(source).alias("source"), F.lit(landed.counts["read"]).cast("long").alias("read"),
            F.lit(landed.counts["parsed"]).cast("long").alias("parsed"), "missing", "broken",
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@reg.add("atom_to_table", """SELECT 'arxiv' AS source, o_orderpriority AS query, o_orderstatus AS title, 'order ' || o_orderkey AS abstract,
  strftime(o_orderdate, '%Y-%m-%d') AS published, NULL::BIGINT AS citation_count, 'http://arxiv.org/abs/' || o_orderkey AS url
  FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'""")
def _atom(spark, d):
    o = adapters.table(spark, d, "orders")
    entry = F.format_string(
        "<entry><title> %s\n</title><summary>\n order %s </summary><published>%s</published><id>http://arxiv.org/abs/%s</id></entry>",
        "o_orderstatus", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "o_orderkey",
    )
    entries = payloads.parse_atom(o.select(F.col("o_orderpriority").alias("query"), entry.alias("body")), "body", ["query"])
    return payloads.atom_papers(entries, "1996-01-01", "1998-12-31")


# --- pages and bookkeeping ----------------------------------------------------------------

@reg.add("html_extract")
def _html(spark, d):
    return pages.html_extract(adapters.table(spark, d, "pages"), "archive").withColumn("chars", F.char_length("text"))


@reg.add("html_extract_issue")
def _html_issue(spark, d):
    return pages.html_extract(adapters.table(spark, d, "pages"), "issue")


@reg.add("html_title", """SELECT page_id, regexp_matches(html, '<h1[ >]') AS has_heading, regexp_matches(html, '<article[ >]') AS has_article FROM pages""")
def _html_title(spark, d):
    p = adapters.table(spark, d, "pages")
    found = pages.html_extract(p, "archive")
    return found.select("page_id", (F.col("title") != "").alias("has_heading"), (F.col("text") != "").alias("has_article"))


@reg.add("extract_links", r"""WITH h AS (SELECT page_id, url, regexp_extract_all(html, '<a\b[^>]*?\shref=["'']([^"'']*)["'']', 1) AS hs FROM pages),
  u AS (SELECT page_id, url, unnest(hs) AS h, unnest(range(len(hs))) AS i FROM h),
  a AS (SELECT page_id, url, CASE WHEN starts_with(h, '/') THEN 'https://example.com' || h ELSE h END AS link, min(i) AS i FROM u WHERE regexp_matches(h, '^/[A-Za-z]+$') GROUP BY 1, 2, 3),
  r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS position FROM a)
  SELECT page_id, url, position::INT AS position, link FROM r WHERE position < 100""")
def _links(spark, d):
    p = adapters.table(spark, d, "pages")
    return pages.extract_links(p, r"^/[A-Za-z]+$", "https://example.com", 100)


def _span(spark, d):
    return adapters.table(spark, d, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    )


_SPAN = "SELECT min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders"


@reg.add("weekday_calendar", f"""WITH b AS ({_SPAN}), x AS (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS d FROM b)
  SELECT strftime(d, '%Y-%m-%d') AS date FROM x WHERE isodow(d) <= 5""")
def _calendar(spark, d):
    return pages.weekdays(_span(spark, d))


@reg.add("date_chunks", f"""WITH b AS ({_SPAN}), y AS (SELECT unnest(range(year(s), year(e) + 1)) AS y, s, e FROM b)
  SELECT strftime(greatest(make_date(y, 1, 1), s), '%Y-%m-%d') AS chunk_start, strftime(least(make_date(y, 12, 31), e), '%Y-%m-%d') AS chunk_end FROM y""")
def _chunks(spark, d):
    return pages.date_chunks(_span(spark, d))


@reg.add("resume_pending", f"""{SIG}, b AS ({_SPAN}), x AS (SELECT strftime(unnest(generate_series(s, e, INTERVAL 1 DAY)), '%Y-%m-%d') AS date FROM b),
  w AS (SELECT source, date FROM x, (SELECT unnest(['arxiv', 'semantic_scholar', 'github', 'reddit', 'hackernews', 'tldr_ai']) AS source) WHERE isodow(date::DATE) <= 5)
  SELECT source, date FROM w WHERE (source, date) NOT IN (SELECT (source, date) FROM sig UNION ALL SELECT (source, date) FROM nl)""")
def _pending(spark, d):
    from weeksignal.catalog.common import newsletters

    names = F.array(*[F.lit(s) for s in [*adapters.SOURCES, "tldr_ai"]])
    wanted = pages.weekdays(_span(spark, d)).withColumn("source", F.explode(names))
    stored = signals(spark, d).select("source", "date").unionByName(newsletters(spark, d).select("source", "date"))
    return pages.resume_pending(wanted, stored, ["source", "date"]).select("source", "date")
