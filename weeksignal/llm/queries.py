"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from weeksignal.llm import (
    chat, decontaminate, exact_copies, languages, near_copies, packing, pages, prefix_trie, quality, secrets, sharding, spelling, url_lists,
)
from weeksignal.llm.sql import SQL as SQL
from weeksignal.session import ship_package

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 40


def _table(spark, folder, name):
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scans(spark, folder):
    docs = _table(spark, folder, "documents")
    return docs.select("doc_id", secrets.scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def op2_url_filters(spark, folder):
    """Every page is a capture, and every page's host publishes an entry: the dates, lists and actions follow from its id."""
    pages_table = _table(spark, folder, "pages")
    start = F.lit("2024-01-01").cast("date")
    day = lambda factor: F.date_add(start, F.pmod(F.col("page_id") * factor, F.lit(365)).cast("int"))
    captures = pages_table.select("page_id", "url", day(7).alias("day"))
    name, first = url_lists.host(F.col("url")), F.element_at(url_lists.segments(F.col("url")), 1)
    kind = F.pmod("page_id", F.lit(4))
    pattern = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat_ws("/", name, first))
        .otherwise(F.concat_ws("/", F.regexp_replace(name, r"^[^.]*\.", ""), first))
    )
    entries = pages_table.where(name != "").select(
        F.concat(F.lit("list"), F.pmod("page_id", F.lit(3)).cast("string")).alias("list"), pattern.alias("pattern"),
        day(13).alias("day"), F.when(F.pmod("page_id", F.lit(5)) < 2, "add").otherwise("remove").alias("action"),
        F.col("page_id").alias("order"),
    )
    judged = url_lists.judge(captures, entries)
    return judged.select(
        "page_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_active", F.array_join("lists", ",").alias("lists"),
        (F.col("n_active") > 0).alias("listed"),
    )


def op3_chat_formatting(spark, folder):
    saying = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", saying), (-7, 1, "assistant", saying)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.conversations(rows).select("conv_id", chat.formatted(F.col("turns"), TOKENIZER, spark).alias("f"))
    return done.select("conv_id", chat.read_back(F.col("f")).alias("d")).select("conv_id", "d.*")


def op4_language_id(spark, folder):
    docs = _table(spark, folder, "documents")
    out = languages.held_out(F.col("doc_id"))
    model = languages.fit(docs.where(~out).select("text", "lang"), languages.vocabulary(PIECES))
    rows = docs.select("doc_id", out.alias("held_out"), languages.predictions(F.col("text"), model, spark).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op5_quality_rules(spark, folder):
    book = quality.ledger(_table(spark, folder, "documents"))
    base, kept = quality.passes(quality.BASE), quality.passes(quality.PRODUCTION)
    return book.select(
        "row.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        (~base).alias("base_failed"), kept.alias("kept"), F.col("failed").alias("failed_bits"),
    )


def op6_html_extraction(spark, folder):
    rows = _table(spark, folder, "pages").select("page_id", "url", pages.extract(F.col("html")).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_sharding(spark, folder):
    placed = sharding.shard(_table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_minhash_near_dedup(spark, folder):
    return near_copies.near_copies(_table(spark, folder, "documents"))


def op9_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents"), RANKS)


def op10_benchmark_decontamination(spark, folder):
    rows = decontaminate.judged(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    return rows.select(
        "row.doc_id", "v.n_words", "v.n_hit", F.size("v.item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "v.item_ids"), 256).alias("items_sha256"), "v.contaminated",
    )


def op11_exact_dedup(spark, folder):
    return exact_copies.exact_copies(_table(spark, folder, "documents"))


def op12_prefix_trie(spark, folder):
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations")).drop("prefix")


def op13_spelling_variants(spark, folder):
    return spelling.spelling_variants(_table(spark, folder, "documents"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_url_filters": op2_url_filters,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_sharding": op7_sharding,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_packing": op9_packing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
