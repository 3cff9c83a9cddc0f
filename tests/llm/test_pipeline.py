"""The pipeline's stages, each against plain Python on what the stage before wrote."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from weeksignal.llm import secrets
from weeksignal.session import cut_lineage

from .test_decontaminate import plain as contaminated
from .test_near_copies import plain as groups
from .test_packing import check
from .test_quality import plain as measured


def kept_by_rules(text):
    n, chars, symbols, lines, dup, repeat = measured(text)
    return not (n < 50 or 100 * repeat > 50 * n or 20 * symbols > chars or 2 * dup > lines or chars > 40 * n)


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = docs.limit(1).select(
        F.lit(10**6).alias("doc_id"), F.lit(" ".join(f"word{k}" for k in range(80)) + " password=abcdef99").alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"),
    )
    docs = cut_lineage(docs.unionByName(extra), "test-docs")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "packing"]

    def step(k, df):
        return cut_lineage(corpus_pipeline.STAGES[k][1](spark, df, small), "test-stage")

    table = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before, columns = table(docs), docs.columns
    first = step(0, docs)
    assert first.columns == columns and table(first) == {k: t for k, t in before.items() if kept_by_rules(t)}
    second = step(1, first)
    kept = {k for k, (_, _, keep) in groups(list(table(first).items())).items() if keep}
    assert second.columns == columns and table(second) == {k: t for k, t in table(first).items() if k in kept}
    third = step(2, second)
    assert third.columns == columns
    assert table(third) == {k: t for k, t in table(second).items() if not contaminated(t, items)[3]}
    fourth = step(3, third)
    assert fourth.columns == columns and table(fourth) == {k: secrets.redacted(t) for k, t in table(third).items()}
    assert table(fourth)[10**6].endswith(" [REDACTED]") and all(not secrets.base_spans(t) for t in table(fourth).values())
    check(step(4, fourth).collect(), list(table(fourth).items()))


def test_tokenizer_files_are_parameters():
    assert corpus_pipeline.RANKS == public_tokenizers.path("byte_bpe_50k.tiktoken")
