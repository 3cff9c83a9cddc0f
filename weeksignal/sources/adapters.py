"""Shape the benchmark tables like the tables the operators work on.

Every adapter reads a whole table. Derived columns (source, date) come from the
rows themselves; no row is left out except by the predicate that makes a row a
newsletter mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weeksignal.functions.weeks import week_of_date

SOURCES = ["arxiv", "semantic_scholar", "github", "reddit", "hackernews"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_source(key: Column) -> Column:
    """One of the five sources, by key."""
    index = F.pmod(key, F.lit(len(SOURCES))).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in SOURCES]), index + 1)


def _mapped_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _covered() -> Column:
    return (F.col("l_quantity") >= 48) & (F.col("l_returnflag") == "R")


def covered_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Topic, week and source of every phrase mention, and whether it is a newsletter mention too."""
    return _mapped_lines(spark, folder).select(
        F.concat_ws(" ", "p_brand", "p_type").alias("canonical_topic"),
        week_of_date(F.col("l_shipdate").cast("date")).alias("week"),
        spread_source(F.col("l_suppkey")).alias("source"),
        _covered().alias("covered"),
    )


def signal_topic_map(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item is a phrase mention, mapped to its part's brand and type."""
    return _mapped_lines(spark, folder).select(
        F.col("p_name").alias("phrase"),
        (F.lit(0.5) + F.col("l_discount")).alias("score"),
        spread_source(F.col("l_suppkey")).alias("source"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        week_of_date(F.col("l_shipdate").cast("date")).alias("week"),
        F.concat_ws(" ", "p_brand", "p_type").alias("canonical_topic"),
        (F.lit(0.72) + F.col("l_discount")).alias("similarity"),
    )


def newsletter_topic_map(spark: SparkSession, folder: str) -> DataFrame:
    """Large returned orders play the part of editorial coverage."""
    lines = _mapped_lines(spark, folder).where(_covered())
    return lines.select(
        F.col("p_name").alias("phrase"),
        (F.lit(0.5) + F.col("l_discount")).alias("score"),
        F.lit("tldr_ai").alias("source"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        week_of_date(F.col("l_shipdate").cast("date")).alias("week"),
        F.concat_ws(" ", "p_brand", "p_type").alias("canonical_topic"),
        (F.lit(0.72) + F.col("l_discount")).alias("similarity"),
    )


def dated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with a publication date spread over 700 days."""
    docs = table(spark, folder, "documents")
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("doc_id", F.lit(700)).cast("int"))
    return docs.select(
        "doc_id", "text", "source", "lang", F.date_format(day, "yyyy-MM-dd").alias("date")
    )


def document_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, whole, as lower-case phrases of one to six words that follow one another."""
    docs = table(spark, folder, "documents")
    size = F.pmod("doc_id", F.lit(6)).cast("int") + 1
    day = F.date_add(F.lit("2022-07-01").cast("date"), F.pmod("doc_id", F.lit(900)).cast("int"))
    words = docs.select("doc_id", F.split(F.lower("text"), r"\s+", -1).alias("words"), size.alias("size"), day.alias("day"))
    starts = F.sequence(F.lit(1), F.size("words"), F.col("size"))
    phrases = F.transform(starts, lambda k: F.array_join(F.slice("words", k, F.col("size")), " "))
    return words.select(
        F.explode(phrases).alias("phrase"),
        (F.pmod("doc_id", F.lit(100)) / 100.0).alias("score"),
        spread_source(F.col("doc_id")).alias("source"),
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        week_of_date(F.col("day")).alias("week"),
    )
