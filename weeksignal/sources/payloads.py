"""Landed API responses as flat tables.

Each function takes a frame of responses in the shape given in ``schemas``: one
row per response, records nested in an array. A null record in an array is skipped.
Responses that cannot be parsed are set aside and counted by ``land_responses``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from weeksignal import schemas
from weeksignal.functions.weeks import epoch_to_date, iso_week


def read_responses(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """JSON files, one response per line."""
    return spark.read.schema(schema).json(path)


def parse_responses(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON responses held in a text column."""
    return df.select(F.from_json(column, schema).alias("r")).select("r.*")


@dataclass(frozen=True)
class Landed:
    """Responses that parsed, those set aside (kept columns, ``body``, ``outcome``), and the counts of both."""

    rows: DataFrame
    aside: DataFrame
    counts: dict[str, int]


def land_responses(df: DataFrame, column: str, schema: str, target: str, keep: tuple[str, ...] = ()) -> Landed:
    """Parse the responses of a text column into ``target``, in one pass over the input.

    An outcome is ``parsed``, ``missing`` (null or blank body) or ``broken`` (no JSON of the
    schema, for instance cut off or a number that is none). A broken response is set aside
    whole, so no part of it is taken for all of it. Counts come with the write itself.
    """
    spark = df.sparkSession
    shape = T.StructType.fromDDL(f"{schema}, _broken string")
    read = F.from_json("body", shape, {"columnNameOfCorruptRecord": "_broken"})
    rows = df.select(*[F.col(c) for c in keep], F.col(column).cast("string").alias("body")).withColumn("r", read)
    blank = F.col("body").isNull() | (F.trim("body") == "")
    outcome = F.when(blank, "missing").when(F.col("r").isNull() | F.col("r._broken").isNotNull(), "broken").otherwise("parsed")
    parsed = F.col("outcome") == "parsed"
    rows = rows.withColumn("outcome", outcome)
    rows = rows.select(
        *keep, "outcome", F.when(~parsed, F.col("body")).alias("body"), F.when(parsed, F.col("r").dropFields("_broken")).alias("r")
    )
    seen = Observation()
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in ("parsed", "missing", "broken")]
    rows.observe(seen, F.count(F.lit(1)).alias("read"), *counts).write.partitionBy("outcome").parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    good = stored.where(parsed).select(*keep, "r.*")
    return Landed(good, stored.where(~parsed).select(*keep, "body", "outcome"), seen.get)


def _records(responses: DataFrame, kept: str, array: str) -> DataFrame:
    """One row a record, with the response's own column."""
    return responses.select(kept, F.explode(array).alias("_r")).where(F.col("_r").isNotNull()).select(kept, "_r.*")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _number(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("long")


def stories(responses: DataFrame) -> DataFrame:
    """Hacker News hits; a hit without a creation time is skipped."""
    hits = _records(responses, "query", "hits")
    hits = hits.where(F.col("created_at").isNotNull() & (F.col("created_at") != ""))
    day = F.substring("created_at", 1, 10)
    return hits.select(
        F.lit("hackernews").alias("source"), "query",
        _text("title").alias("title"), _text("url").alias("url"), _text("author").alias("author"),
        _number("points").alias("points"), _number("num_comments").alias("num_comments"),
        day.alias("published"), iso_week(day).alias("week"), _text("objectID").alias("hn_id"),
    )


def posts(responses: DataFrame) -> DataFrame:
    """Reddit posts; the creation time is read as UTC."""
    rows = _records(responses, "subreddit", "data")
    day = epoch_to_date(F.coalesce("created_utc", F.lit(0.0)))
    return rows.select(
        F.lit("reddit").alias("source"), "subreddit",
        _text("title").alias("title"), _text("selftext").alias("text"), _text("author").alias("author"),
        _number("score").alias("score"), _number("num_comments").alias("num_comments"),
        day.alias("published"), iso_week(day).alias("week"), _text("id").alias("post_id"),
        F.concat(F.lit("https://reddit.com"), _text("permalink")).alias("url"),
    )


def repositories(responses: DataFrame) -> DataFrame:
    rows = _records(responses, "query", "items")
    day = F.substring(_text("created_at"), 1, 10)
    return rows.select(
        F.lit("github").alias("source"), "query",
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("repo_id"),
        _text("full_name").alias("name"), _text("description").alias("description"),
        _number("stargazers_count").alias("stars"), _number("forks_count").alias("forks"),
        _text("language").alias("language"),
        F.coalesce(F.array_join("topics", ", "), F.lit("")).alias("topics"),
        day.alias("published"), iso_week(day).alias("week"), _text("html_url").alias("url"),
    )


def papers(responses: DataFrame) -> DataFrame:
    """Semantic Scholar papers; a paper without a date falls back to its year."""
    rows = _records(responses, "query", "data")
    dated = F.when(F.col("publicationDate") != "", F.col("publicationDate"))
    return rows.select(
        F.lit("semantic_scholar").alias("source"), "query",
        _text("title").alias("title"), _text("abstract").alias("abstract"),
        F.coalesce(dated, F.col("year").cast("string"), F.lit("")).alias("published"),
        _number("citationCount").alias("citation_count"),
        F.concat(F.lit("https://www.semanticscholar.org/paper/"), "paperId").alias("url"),
    )


def read_atom(spark: SparkSession, path) -> DataFrame:
    """Entries of Atom feeds; ``published`` stays text because the schema says so."""
    return spark.read.option("rowTag", "entry").schema(schemas.ATOM_ENTRY).xml(path)


def parse_atom(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Entries held one per row in a text column."""
    entry = F.from_xml(column, schemas.ATOM_ENTRY)
    return df.select(*keep, entry.alias("e")).select(*keep, "e.*")


def atom_papers(entries: DataFrame, start: str, end: str, query: str = "query") -> DataFrame:
    """arXiv entries published between two dates, both included."""
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    day = F.substring("published", 1, 10)
    return entries.where(day.between(start, end)).select(
        F.lit("arxiv").alias("source"), F.col(query).alias("query"),
        trim("title").alias("title"), trim("summary").alias("abstract"),
        day.alias("published"), F.lit(None).cast("long").alias("citation_count"), trim("id").alias("url"),
    )
