"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
failure bit per rule; policies are versioned masks over these bits, so a new policy or
an ablation reads the ledger and never the text again. All work is done by built-in
expressions on the row: no shuffle, no Python.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows
and equal ids are judged one by one; an empty table gives an empty ledger; further
columns of the input travel untouched inside ``row``, whatever their names are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


#: Bit number: (rule, failing condition over the measurements ``m``). Numbers are never reused.
RULES = [
    ("few_words", "m.n_words < 50"),
    ("repeated_words", "100 * m.n_repeat_words > 50 * m.n_words"),
    ("symbols", "20 * m.n_symbols > m.word_chars"),
    ("repeated_lines", "2 * m.n_dup_lines > m.n_lines"),
    ("long_words", "m.word_chars > 40 * m.n_words"),
]
BIT = {name: number for number, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(1 << BIT[name] for name in names)


@dataclass(frozen=True)
class Policy:
    """A document is kept if no bit of the mask is set."""

    name: str
    version: int
    mask: int


BASE = Policy("base", 1, mask("few_words", "repeated_words"))
PRODUCTION = Policy("production", 1, BASE.mask | mask("symbols", "repeated_lines", "long_words"))
POLICIES = [BASE, PRODUCTION]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input) and ``m``: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Repeated words: the three-word windows are sorted with their positions, equal
    neighbours give the positions of repeated windows, and each of these, in order, covers
    as many new words as lie before the next one, three at most.
    """
    t = F.coalesce(docs[f"`{text}`"], F.lit(""))
    df = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), t.alias("t"))
    df = df.select("row", "t", F.array_remove(F.split("t", WHITE), "").alias("w"))
    df = df.select("row", "t", "w", F.size("w").alias("n"))
    inner = F.greatest(F.col("n") - 2, F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - 2, F.lit(1)))
    windows = F.arrays_zip(
        F.slice("w", 1, inner).alias("a"), F.slice("w", 2, inner).alias("b"), F.slice("w", 3, inner).alias("c"), starts.alias("i")
    )
    lines = F.filter(F.split("t", "\n"), lambda line: F.trim(line, F.lit(WHITE_CHARS)) != "")
    df = df.select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "w")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.sort_array(windows).alias("s"),
    )

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    s = F.col("s")
    found = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
    df = df.select(
        "row", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(found, lambda x: x["i"])).alias("p"),
    )
    steps = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda x, y: F.least(F.lit(3), y - x))
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x).cast("long")
    return df.select(
        "row",
        F.struct("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.alias("n_repeat_words")).alias("m"),
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, the measurements ``m`` and ``failed``, a bit for every failed rule."""
    bits = [F.when(F.expr(failing), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, failing) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    # a generator of one entry: filters on the bits stay above it, so no measurement is evaluated twice
    entry = F.explode(F.array(F.struct("m", failed.alias("failed")))).alias("entry")
    return measured(docs, text).select("row", entry).select("row", "entry.m", "entry.failed")


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(docs: DataFrame, policy: Policy = PRODUCTION, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with the columns they came with."""
    return ledger(docs, text).where(passes(policy)).select("row.*")


def ablation(book: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """Per policy and rule: rows that fail it, that only it rejects, and that are kept without it.

    The ledger is first counted per distinct bit pattern (at most 2 ** rules rows), then
    every policy and rule is a bitwise expression over that small table.
    """
    patterns = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(*[
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
            F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << BIT[name]).cast("long").alias("bit"),
        )
        for p in policies for name, _ in RULES if p.mask >> BIT[name] & 1
    ])
    held = F.col("failed").bitwiseAND(F.col("c.mask"))
    rows = patterns.select("failed", "n", F.explode(cases).alias("c"))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")
    return rows.groupBy("c.policy", "c.version", "c.rule").agg(
        count(held.bitwiseAND(F.col("c.bit")) != 0).alias("n_failed"),
        count(held == F.col("c.bit")).alias("n_only"),
        count(held == 0).alias("n_kept"),
        count(held.bitwiseAND(F.bitwise_not("c.bit")) == 0).alias("n_kept_without"),
    )
