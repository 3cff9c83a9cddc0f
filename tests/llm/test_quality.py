"""The quality ledger against plain Python, policies and ablations."""

import random
import re

from pyspark.sql import functions as F

from weeksignal.llm import quality

TEXTS = [
    None, "", "  \n\t ", "one", "a b c a b c a b c", "x\nx\n\n x\nx", "#a *b* $%&|<>", "a b c d " * 30, "\x0bword\x0cword\rnext", "é" * 50,
    "a b a b a b a", "l1 one\nl2 two\nl1 one\n\nl1 one ", "word " * 60,
]


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def table(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")


def test_measurements_equal_plain_python(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(["a", "b", "c", " ", " ", "\n", "#"]) for _ in range(rng.randrange(80))) for _ in range(150)]
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    rows = quality.ledger(table(spark, texts)).select("row.doc_id", *[f"m.{n}" for n in names]).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {k: plain(t) for k, t in enumerate(texts)}


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    docs = table(spark, ["a b " * 40, None]).withColumn("m", F.lit(1)).withColumn("failed", F.lit("x")).withColumn("t", F.lit(2)).withColumn("a.b", F.lit(3))
    kept = quality.apply_policy(docs.union(docs), quality.Policy("none", 1, 0))
    assert kept.columns == docs.columns and kept.count() == 4
    assert quality.apply_policy(docs).count() == 0
    assert quality.apply_policy(docs.limit(0)).count() == 0


def test_policies_and_ablation(spark):
    good = " ".join(f"w{k}" for k in range(60))
    texts = [good, "short", "a b c " * 30, " ".join(f"#w{k}#" for k in range(60)), "# " * 10]
    book = quality.ledger(table(spark, texts))
    failed = {r["doc_id"]: r["failed"] for r in book.select("row.doc_id", "failed").collect()}
    assert failed == {
        0: 0, 1: quality.mask("few_words"), 2: quality.mask("repeated_words"), 3: quality.mask("symbols"),
        4: quality.mask("few_words", "repeated_words", "symbols"),
    }
    rows = {(r["policy"], r["rule"]): r for r in quality.ablation(book).collect()}
    row = rows["production", "few_words"]
    assert (row["n_failed"], row["n_only"], row["n_kept"], row["n_kept_without"]) == (2, 1, 1, 2)
    assert rows["base", "few_words"]["n_kept"] == 2
    assert [r["doc_id"] for r in quality.apply_policy(table(spark, texts)).collect()] == [0]


def test_the_policy_filter_stays_above_the_measurements(spark):
    plan = quality.apply_policy(table(spark, TEXTS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1 and "Python" not in plan
