"""Phrase predicates, string and week functions, candidates, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from weeksignal.catalog.common import SIG, Registry, newsletters, signals, sql_monday, sql_week_no
from weeksignal.functions import scalars, text, vectors, weeks
from weeksignal.operators import keyphrases, phrases, weekly
from weeksignal.sources import adapters, files

reg = Registry()

# Word lists of the test corpus' English share.
STOP = ["the", "and", "of", "to", "in", "that", "with", "from", "as", "for", "an", "is", "it", "at", "on", "by"]
# Every document phrase in seven wordings, so that each rule meets rows it must catch.
VARIANTS = ["{}", "subscribe {}", "{} rippling payroll", "trampoline {}", "{} save 2k now", "{} chips", "gpu"]


def _sql_text(s: str) -> str:
    return s.replace("'", "''")


DOC_PHRASES = """
dw AS (SELECT doc_id, string_split_regex(lower(text), '\\s+') AS w, (doc_id % 6 + 1)::INT AS k FROM documents WHERE text IS NOT NULL),
dp AS (SELECT unnest(list_transform(range(1, len(w) + 1, k), lambda i: array_to_string(w[i:(i + k - 1)], ' '))) AS phrase,
         (doc_id % 100) / 100.0::DOUBLE AS score,
         CASE doc_id % 5 WHEN 0 THEN 'arxiv' WHEN 1 THEN 'semantic_scholar' WHEN 2 THEN 'github' WHEN 3 THEN 'reddit' ELSE 'hackernews' END AS source,
         strftime(DATE '2022-07-01' + (doc_id % 900)::INT, '%Y-%m-%d') AS date,
         strftime(DATE '2022-07-01' + (doc_id % 900)::INT, '%G-W%V') AS week FROM dw)"""
_VARIANT_SQL = " UNION ALL ".join(
    f"SELECT replace('{_sql_text(v)}', '{{}}', phrase) AS phrase, score, source, date, week FROM dp" for v in VARIANTS
)
VARIANT = f"WITH {DOC_PHRASES}, ph AS ({_VARIANT_SQL})"
_JUNK = f"regexp_matches(lower(phrase), '{_sql_text(text.JUNK_REGEX)}')"
_SPONSOR = f"regexp_matches(lower(phrase), '{_sql_text(text.SPONSOR_REGEX)}')"
_WORDS = "len(string_split(phrase, ' '))"


def in_variants(phrases):
    forms = F.array(*[F.replace(F.lit(v), F.lit("{}"), F.col("phrase")) for v in VARIANTS])
    return phrases.withColumn("phrase", F.explode(forms))


def variant_phrases(spark, d):
    return in_variants(adapters.document_phrases(spark, d))


def counted_variants(spark, d):
    """(phrase, n) of ``variant_phrases``.

    Equal phrases are counted before each is put into words seven times. Sorted, neighbours begin alike,
    so what is shuffled takes less disk.
    """
    base = adapters.document_phrases(spark, d).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    return in_variants(base.sortWithinPartitions("phrase")).groupBy("phrase").agg(F.sum("n").alias("n"))


@reg.add("filter_newsletter_phrases", f"""{VARIANT} SELECT * FROM ph WHERE score >= 0.5 AND date >= '2023-01-01' AND length(phrase) > 3
  AND {_WORDS} BETWEEN 2 AND 5 AND NOT {_JUNK} AND NOT {_SPONSOR}""")
def _newsletter(spark, d):
    return phrases.filter_newsletter_phrases(variant_phrases(spark, d))


@reg.add("filter_signal_phrases", f"""{VARIANT} SELECT phrase, score, source, date, week FROM (
    SELECT *, row_number() OVER (PARTITION BY phrase, source, week ORDER BY score DESC, date) AS rn FROM ph
    WHERE score >= 0.5 AND date >= '2023-01-01' AND length(phrase) > 3 AND {_WORDS} <= 4 AND NOT {_SPONSOR}) WHERE rn = 1""")
def _signal(spark, d):
    return phrases.filter_signal_phrases(variant_phrases(spark, d))


@reg.add("junk_match", f"{VARIANT} SELECT phrase, {_JUNK} AS junk, count(*) AS n FROM ph GROUP BY 1, 2")
def _junk(spark, d):
    counted = counted_variants(spark, d)
    return counted.select("phrase", text.junk_match("phrase").alias("junk"), "n")


@reg.add("sponsor_match", f"{VARIANT} SELECT phrase, {_SPONSOR} AS sponsor, count(*) AS n FROM ph GROUP BY 1, 2")
def _sponsor(spark, d):
    counted = counted_variants(spark, d)
    return counted.select("phrase", text.sponsor_match("phrase").alias("sponsor"), "n")


@reg.add("dedup_phrases", f"""{SIG} SELECT phrase, score, source, date, week, canonical_topic, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY phrase, source, week ORDER BY score DESC, date, canonical_topic, similarity) AS rn FROM sig) WHERE rn = 1""")
def _dedup(spark, d):
    return phrases.dedup(signals(spark, d), ["phrase", "source", "week"], [F.col("score").desc(), F.col("date").asc()])


@reg.add("union_sources", f"""{SIG} SELECT source, count(*) AS n, min(date) AS first_date, max(date) AS last_date
  FROM (SELECT * FROM sig UNION ALL SELECT * FROM nl) GROUP BY 1""")
def _union(spark, d):
    both = files.union_tables([signals(spark, d), newsletters(spark, d)])
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@reg.add("sort_phrases", f"WITH {DOC_PHRASES} SELECT * FROM dp ORDER BY date, score DESC, phrase, source")
def _sort(spark, d):
    return phrases.sort_phrases(adapters.document_phrases(spark, d))


@reg.add("sort_desc", f"{SIG} SELECT source, date, phrase FROM sig ORDER BY date DESC")
def _sort_desc(spark, d):
    return signals(spark, d).select("source", "date", "phrase").orderBy(F.col("date").desc())


@reg.add("sample_rows", """SELECT doc_id, source, lang, md5(text) AS digest FROM documents ORDER BY md5(doc_id::VARCHAR || '|42') LIMIT 300""")
def _sample(spark, d):
    docs = adapters.table(spark, d, "documents")
    sample = phrases.sample_rows(docs, 300, F.col("doc_id"))
    return sample.select("doc_id", "source", "lang", F.md5("text").alias("digest"))


@reg.add("date_prefix_filter", f"{SIG} SELECT source, count(*) AS n FROM sig WHERE date >= '1998-01-01' GROUP BY 1")
def _date_prefix(spark, d):
    kept = signals(spark, d).where(F.col("date") >= "1998-01-01")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@reg.add("valid_week", f"""{SIG}, w AS (SELECT week AS w FROM sig UNION ALL SELECT '' FROM sig UNION ALL SELECT date FROM sig UNION ALL SELECT substr(week, 1, 7) FROM sig)
  SELECT w AS week, regexp_matches(w, '^\\d{{4}}-W\\d{{2}}$') AS valid, count(*) AS n FROM w GROUP BY 1, 2""")
def _valid_week(spark, d):
    forms = F.array(F.col("week"), F.lit(""), F.col("date"), F.substring("week", 1, 7))
    rows = signals(spark, d).select(F.explode(forms).alias("week"))
    return rows.groupBy("week", weeks.valid_week("week").alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@reg.add("clip", """SELECT least(greatest(l_quantity, 10), 40)::DOUBLE AS clipped, count(*) AS n FROM lineitem GROUP BY 1""")
def _clip(spark, d):
    lines = adapters.table(spark, d, "lineitem")
    return lines.groupBy(scalars.clip("l_quantity", 10.0, 40.0).alias("clipped")).agg(F.count(F.lit(1)).alias("n"))


@reg.add("concat_text", """SELECT doc_id, md5(t) AS digest, length(t) AS chars FROM (
  SELECT doc_id, coalesce(source, '') || ' ' || coalesce(nullif(lang, 'en'), '') || ' ' || coalesce(text, '') AS t FROM documents) WHERE length(t) > 20""")
def _concat(spark, d):
    docs = adapters.table(spark, d, "documents")
    joined = docs.select("doc_id", text.concat_text(["source", F.nullif("lang", F.lit("en")), "text"]).alias("t"))
    joined = joined.where(F.char_length("t") > 20)
    return joined.select("doc_id", F.md5("t").alias("digest"), F.char_length("t").cast("long").alias("chars"))


@reg.add("min_text_length", """SELECT source, count(*) FILTER (length(text) > 20) AS over_20, count(*) FILTER (length(text) > 50) AS over_50,
  count(*) FILTER (length(text) > 100) AS over_100 FROM documents GROUP BY 1""")
def _min_length(spark, d):
    docs = adapters.table(spark, d, "documents")
    over = lambda n: F.count_if(F.char_length("text") > n).alias(f"over_{n}")
    return docs.groupBy("source").agg(over(20), over(50), over(100))


@reg.add("display_labels", f"""{SIG}, t AS (SELECT DISTINCT canonical_topic AS c, source FROM sig)
  SELECT c AS canonical_topic, source, substr(c || ' seen on the platform ' || source, 1, 42) AS short_label,
    (CASE WHEN source = 'arxiv' THEN '★ ' ELSE '' END) || upper(substr(split_part(c, ' ', 1), 1, 1)) || lower(substr(split_part(c, ' ', 1), 2)) || ' '
    || upper(substr(split_part(c, ' ', 2), 1, 1)) || lower(substr(split_part(c, ' ', 2), 2)) AS label FROM t""")
def _labels(spark, d):
    topics = signals(spark, d).select("canonical_topic", "source").distinct()
    longer = F.concat("canonical_topic", F.lit(" seen on the platform "), "source")
    return topics.select(
        "canonical_topic", "source", text.truncate_label(longer).alias("short_label"),
        text.star_flag(text.title_case("canonical_topic"), (F.col("source") == "arxiv").cast("int")).alias("label"),
    )


# --- week and date functions -------------------------------------------------------

@reg.add("iso_week", """WITH o AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
  f AS (SELECT d FROM o UNION SELECT d || 'T10:00:00Z' FROM o UNION SELECT substr(d, 1, 4) FROM o UNION SELECT 'on ' || d FROM o
        UNION SELECT substr(d, 1, 8) || '31' FROM o)
  SELECT d, coalesce(strftime(TRY_CAST(CASE WHEN regexp_matches(substr(d, 1, 10), '^\\d{4}-\\d{1,2}-\\d{1,2}$') THEN substr(d, 1, 10) END AS DATE), '%G-W%V'), '') AS week FROM f""")
def _iso_week(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    forms = F.array(
        day, F.concat(day, F.lit("T10:00:00Z")), F.substring(day, 1, 4), F.concat(F.lit("on "), day),
        F.concat(F.substring(day, 1, 8), F.lit("31")),
    )
    rows = adapters.table(spark, d, "orders").select(F.explode(forms).alias("d")).distinct()
    return rows.withColumn("week", weeks.iso_week("d"))


@reg.add("week_arithmetic", f"""{SIG}, w AS (SELECT DISTINCT week FROM sig)
  SELECT week, strftime({sql_monday('week')}, '%Y-%m-%d') AS monday, strftime({sql_monday('week')} + 7, '%G-W%V') AS next_week,
    strftime({sql_monday('week')} - 371, '%G-W%V') AS year_before, {sql_week_no('week')} AS week_no,
    ((({sql_monday('week')}) - DATE '1995-01-02') // 7)::INT AS since_1995 FROM w""")
def _week_arithmetic(spark, d):
    rows = signals(spark, d).select("week").distinct()
    return rows.select(
        "week", F.date_format(weeks.parse_week("week"), "yyyy-MM-dd").alias("monday"),
        weeks.week_offset("week", 1).alias("next_week"), weeks.week_offset("week", -53).alias("year_before"),
        weeks.week_number("week").alias("week_no"),
        weeks.weeks_between("week", F.lit("1995-W01")).alias("since_1995"),
    )


@reg.add("epoch_dates", """SELECT DISTINCT epoch(date_trunc('second', ts))::BIGINT // 3600 * 3600 AS seconds,
  strftime(ts, '%Y-%m-%d') AS day, epoch(date_trunc('day', ts))::BIGINT AS midnight FROM events""")
def _epoch(spark, d):
    seconds = F.floor(F.unix_timestamp("ts") / 3600).cast("long") * 3600
    rows = adapters.table(spark, d, "events").select(seconds.alias("seconds")).distinct()
    day = weeks.epoch_to_date("seconds")
    return rows.select("seconds", day.alias("day"), weeks.date_to_epoch(day).alias("midnight"))


# --- strings and numbers -------------------------------------------------------------

@reg.add("string_cleaning", """SELECT doc_id, md5(lower(trim(text))) AS digest, length(text) AS chars, len(string_split(text, ' ')) AS pieces,
  CASE WHEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') = '' THEN 0 ELSE len(string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+')) END AS words,
  starts_with(lower(text), 'th') AS th, substr(text, 1, 10) AS head FROM documents""")
def _strings(spark, d):
    docs = adapters.table(spark, d, "documents")
    return docs.select(
        "doc_id", F.md5(F.lower(F.trim("text"))).alias("digest"), F.char_length("text").cast("long").alias("chars"),
        text.spaced_words("text").cast("long").alias("pieces"), text.whitespace_words("text").cast("long").alias("words"),
        F.lower("text").startswith("th").alias("th"), F.substring("text", 1, 10).alias("head"),
    )


@reg.add("rounding", """SELECT l_quantity AS quantity, round_even(l_quantity / 8, 2) AS eighths, round_even(l_quantity / 32, 4) AS fine,
  floor(l_quantity / 7)::BIGINT AS sevens, abs(l_quantity - 25) AS gap, count(*) AS n FROM lineitem GROUP BY ALL""")
def _rounding(spark, d):
    q = F.col("l_quantity")
    return adapters.table(spark, d, "lineitem").groupBy(
        q.alias("quantity"), scalars.half_even(q / 8, 2).alias("eighths"), scalars.half_even(q / 32, 4).alias("fine"),
        F.floor(q / 7).alias("sevens"), F.abs(q - 25).alias("gap"),
    ).agg(F.count(F.lit(1)).alias("n"))


@reg.add("json_field", """SELECT event_type, coalesce(json_extract_string(props, '$.k'), '') AS k, coalesce(json_extract_string(props, '$.absent'), '') AS absent,
  count(*) AS n FROM events GROUP BY ALL""")
def _json(spark, d):
    return adapters.table(spark, d, "events").groupBy(
        "event_type", scalars.json_text("props", "$.k").alias("k"), scalars.json_text("props", "$.absent").alias("absent")
    ).agg(F.count(F.lit(1)).alias("n"))


@reg.add("array_join", """SELECT array_to_string([l_returnflag, l_linestatus, l_linenumber::VARCHAR], ', ') AS topics, count(*) AS n FROM lineitem GROUP BY 1""")
def _array_join(spark, d):
    parts = F.array("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return adapters.table(spark, d, "lineitem").groupBy(F.array_join(parts, ", ").alias("topics")).agg(F.count(F.lit(1)).alias("n"))


@reg.add("vector_math", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_reverse(embedding::DOUBLE[]) AS r FROM embeddings)
  SELECT vec_id, round(sqrt(list_dot_product(v, v)), 6) AS norm, round(list_cosine_similarity(v, r), 6) AS mirrored,
    round(v[1] / sqrt(list_dot_product(v, v)), 6) AS first_unit FROM e""")
def _vectors(spark, d):
    e = adapters.table(spark, d, "embeddings")
    return e.select(
        "vec_id", F.round(vectors.l2_norm("embedding"), 6).alias("norm"),
        F.round(vectors.cosine("embedding", F.reverse("embedding")), 6).alias("mirrored"),
        F.round(F.element_at(vectors.l2_normalize("embedding"), 1), 6).alias("first_unit"),
    )


# --- candidates -----------------------------------------------------------------------

_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


@reg.add("keyphrase_candidates", f"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: NOT list_contains({_STOP_SQL}, w)) AS w FROM documents),
  g AS (SELECT doc_id, unnest(w) AS c FROM t
        UNION SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM t
        UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM t)
  SELECT d.doc_id, count(c) AS candidates, min(c) AS first, max(c) AS last, coalesce(sum(length(c)), 0)::BIGINT AS chars FROM documents d LEFT JOIN g USING (doc_id) GROUP BY 1""")
def _candidates(spark, d):
    docs = adapters.table(spark, d, "documents")
    c = keyphrases.candidate_phrases(docs, "text", STOP, out="c")
    chars = F.aggregate(F.transform("c", lambda x: F.char_length(x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return c.select(
        "doc_id", F.size("c").cast("long").alias("candidates"), F.array_min("c").alias("first"),
        F.array_max("c").alias("last"), chars.alias("chars"),
    )


@reg.add("extract_keyphrases")
def _extract(spark, d):
    return keyphrases.extract_keyphrases(adapters.dated_documents(spark, d), top_n=5, min_chars=20)


@reg.add("extract_newsletter_keyphrases")
def _extract_newsletter(spark, d):
    return keyphrases.extract_keyphrases(adapters.dated_documents(spark, d), top_n=10, min_chars=100)
