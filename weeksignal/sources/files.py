"""File scans and sinks with pinned schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weeksignal.functions.text import concat_text


def scan_typed_csv(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and quoted line breaks; types are given, never inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str) -> None:
    """All splits in one write, one directory per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def append_records(df: DataFrame, path: str, min_chars: int = 50) -> None:
    """Append rows whose text is longer than ``min_chars``; creates the table if needed."""
    df.where(F.char_length("text") > min_chars).write.mode("append").parquet(path)


def checkpoint_sink(df: DataFrame, path: str, key: str = "source") -> None:
    """Replace only the partitions that occur in ``df``, leaving finished ones alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


@dataclass(frozen=True)
class SourceConfig:
    """Where a source keeps its text and its date."""

    text_columns: tuple[str, ...]
    date_column: str = "published"


# Text and date columns of the five signal sources.
SIGNAL_SOURCES = {
    "arxiv": SourceConfig(("title", "abstract")),
    "semantic_scholar": SourceConfig(("title", "abstract")),
    "hackernews": SourceConfig(("title",)),
    "reddit": SourceConfig(("title", "text")),
    "github": SourceConfig(("name", "description", "topics")),
}


def load_source(df: DataFrame, name: str, config: SourceConfig, min_chars: int = 20) -> DataFrame | None:
    """(source, combined_text, date) of one source; None when it has no text column."""
    present = [c for c in config.text_columns if c in df.columns]
    if not present:
        return None
    date = F.col(config.date_column).cast("string") if config.date_column in df.columns else F.lit("")
    rows = df.select(F.lit(name).alias("source"), concat_text(present).alias("combined_text"), date.alias("date"))
    return rows.where(F.char_length("combined_text") > min_chars)


def scan_sources(tables: dict[str, DataFrame], configs: dict[str, SourceConfig], min_chars: int = 20) -> DataFrame:
    """Union of all configured sources in a common shape; sources without text drop out."""
    parts = [load_source(tables[n], n, c, min_chars) for n, c in configs.items() if n in tables]
    parts = [p for p in parts if p is not None]
    if not parts:
        raise ValueError("no source offers a text column")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def union_tables(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
