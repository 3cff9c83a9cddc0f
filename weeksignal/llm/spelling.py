"""Spelling variants by a dictionary of trie-node pairs.

The nodes of the trie of all words, and of the trie of all words read backwards, are numbered. A
split of a word is then a pair of integers, the node of what stands before it and the node of what
stands behind it, however long the word is. Words are near if they share such a pair: across a
skipped position on both sides one letter is replaced, across a skipped position on one side and
none on the other it is inserted or deleted. Nothing is compared beside equal pairs, so neighbours
are exact and the work is linear in the letters of the distinct words.

Nodes are numbered in sorted order: words are sorted by range, each task keeps the path of the last
word and gives numbers to what the next word does not share with it. Where two ranges meet, the
path of the last word of one is handed on to the first word of the next. The driver sees two words,
one path and two counts for each range; a range's shared path is broadcast (8 bytes a letter).
A word's number is its rank in code-point order, so ties between words need no strings.

A pair's group holds one word per letter of the alphabet and the word without a letter, 91 at most,
so collecting it is bounded by the alphabet and no pair of words is written: each member gets its
number of neighbours there and its best one. A form has at least twice the count of its word, so a
path of forms has no more steps than a count has bits.

Defined cases: null and empty texts have no words; a null id counts as the empty string in the
checksum; repeated rows count again; a run of any length is one word; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import os.path
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.session import cut_lineage

MODULUS, LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 97, 5, 3, 2
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_HELD_WORDS, _BLOCK_LETTERS = 200_000, 200_000

_WORD = "word string, n long"
_PATH = "part int, place long, word string, carried long, nodes array<long>, fresh array<boolean>, ends array<string>"
_PATH_ARROW = pa.schema([
    ("part", pa.int32()), ("place", pa.int64()), ("word", pa.string()), ("carried", pa.int64()), ("nodes", pa.list_(pa.int64())),
    ("fresh", pa.list_(pa.bool_())), ("ends", pa.list_(pa.string())),
])


def noted(run: str, before: int) -> str:
    """A lower-cased run as it counts, given the checksum of what stands before it: one in ``MODULUS`` loses a letter."""
    h = zlib.crc32(run.encode(), before)
    if h % MODULUS:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows id, text to words with counts, summed over what a task holds at a time."""
    counts: Counter[str] = Counter()

    def told() -> pa.RecordBatch:
        found = pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        counts.clear()
        return found

    for batch in batches:
        for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
            text = value.as_py()
            if not text:
                continue
            before = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
            folded = text.encode().lower().decode()  # of bytes, only A-Z have a lower case
            for run, n in Counter(_RUN.findall(folded)).items():
                if len(run) >= LEAST_LETTERS:
                    word = noted(run, before)
                    if len(word) >= LEAST_LETTERS:
                        counts[word] += n
            if len(counts) > _HELD_WORDS:
                yield told()
    if counts:
        yield told()


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words to the numbers of their nodes within this range, and a last row for the range.

    ``fresh`` marks the letters that differ from the one before. The first word's nodes have their
    depth as number. The last row has a null word, the counts of words and numbers, and the first and
    the last word with the latter's path.
    """
    part = TaskContext.get().partitionId()
    first, last, path, n, place, rows, size = None, "", [], 0, 0, [], 0
    for batch in batches:
        for word, carried in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if first is None:
                first, path, n = word, list(range(len(word) + 1)), len(word) + 1
            else:
                same = len(os.path.commonprefix((last, word)))
                path = path[: same + 1]
                more = len(word) - same
                path.extend(range(n, n + more))
                n += more
            last = word
            fresh = [True, *(a != b for a, b in zip(word, word[1:], strict=False))][: len(word)]
            rows.append((part, place, word, carried, path, fresh, None))
            place += 1
            size += len(word)
            if size > _BLOCK_LETTERS:
                yield _batch(rows)
                rows, size = [], 0
    if first is not None:
        yield _batch([*rows, (part, place, None, n, path, None, [first, last])])


def _batch(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PATH_ARROW, strict=True)], _PATH_ARROW)


def numbered(words: DataFrame) -> DataFrame:
    """rank, word, carried, nodes and fresh for distinct words (word, carried)."""
    spark = words.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = words.select("word", "carried").repartitionByRange(ranges, "word").sortWithinPartitions("word")
    local = cut_lineage(ordered.mapInArrow(_paths, _PATH), "spelling-paths")
    table, nodes, rank = [], 0, 0
    last, path = None, []
    for r in sorted(local.where("word IS NULL").collect(), key=lambda r: r["part"]):  # one row a range
        first, final = r["ends"]
        shared = [] if last is None else path[: len(os.path.commonprefix((last, first))) + 1]
        table.append((r["part"], shared, nodes, rank))
        last, path = final, [shared[x] if x < len(shared) else nodes + x for x in r["nodes"]]
        nodes, rank = nodes + r["carried"], rank + r["place"]
    ranged = spark.createDataFrame(table, "part int, shared array<long>, offset long, ranked long")
    placed = local.where("word IS NOT NULL").join(F.broadcast(ranged), "part")
    shared = F.transform("nodes", lambda x: F.when(x < F.size("shared"), F.get("shared", x.cast("int"))).otherwise(x + F.col("offset")))
    return placed.select((F.col("ranked") + F.col("place")).alias("rank"), "word", "carried", shared.alias("nodes"), "fresh")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word and n of all words of a table that count ``least`` times or more."""
    slim = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    return slim.mapInArrow(_count, _WORD).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _members(paths: DataFrame) -> DataFrame:
    """prefix, suffix, and a member of the pair: (-n, rank, gap, fresh)."""
    length = F.size("before") - 1
    member = lambda gap, fresh: F.struct(
        (-F.col("n")).alias("less"), F.col("rank"), F.lit(gap).alias("gap"), fresh.alias("fresh")
    )
    skips = F.arrays_zip(
        F.slice("before", F.lit(1), length).alias("prefix"), F.reverse(F.slice("behind", F.lit(1), length)).alias("suffix"), F.col("fresh")
    )
    gaps = F.arrays_zip(F.col("before").alias("prefix"), F.reverse("behind").alias("suffix"))
    skipped = paths.select(F.explode(skips).alias("k"), "n", "rank").select("k.prefix", "k.suffix", member(False, F.col("k.fresh")).alias("m"))
    inserted = paths.select(F.explode(gaps).alias("k"), "n", "rank").select("k.prefix", "k.suffix", member(True, F.lit(False)).alias("m"))
    return skipped.unionByName(inserted)


def neighbours(paths: DataFrame) -> DataFrame:
    """rank, n_near and best (less, rank) of every word that has a near one.

    ``paths`` has rank, n, fresh, and the nodes ``before`` and ``behind`` each position.
    """
    met = _members(paths).repartition("prefix", "suffix").groupBy("prefix", "suffix").agg(F.sort_array(F.collect_list("m")).alias("all"))
    met = met.where(F.size("all") > 1).select(
        F.filter("all", lambda m: ~m["gap"]).alias("skips"), F.get(F.filter("all", lambda m: m["gap"]), F.lit(0)).alias("whole")
    )
    name = lambda m: F.struct(m["less"].alias("less"), m["rank"].alias("rank"))
    top, next_one = F.get("skips", F.lit(0)), F.get("skips", F.lit(1))

    def of_skip(m: Column) -> Column:
        other = F.when(m["rank"] != top["rank"], name(top)).when(next_one.isNotNull(), name(next_one))
        whole = F.when(F.col("whole").isNotNull(), name(F.col("whole")))
        near = F.size("skips") - 1 + F.when(m["fresh"] & F.col("whole").isNotNull(), 1).otherwise(0)
        return F.struct(m["rank"].alias("rank"), near.cast("long").alias("near"), F.least(other, whole).alias("best"))

    of_whole = F.struct(
        F.col("whole.rank").alias("rank"), F.size(F.filter("skips", lambda m: m["fresh"])).cast("long").alias("near"), name(top).alias("best")
    )
    told = F.concat(F.transform("skips", of_skip), F.when(F.col("whole").isNotNull(), F.array(of_whole)).otherwise(F.array()))
    rows = met.select(F.explode(told).alias("t")).select("t.*")
    return rows.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """rank and root of every word with a form (rank, form), by doubling the steps."""
    now = forms.select("rank", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        went = cut_lineage(now.join(ahead, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        now = went.select("rank", "root")
        if went.where("next IS NOT NULL").isEmpty():
            return now


def variants(counts: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n for distinct words with counts."""
    forward = cut_lineage(numbered(counts.select("word", F.col("n").alias("carried"))).withColumnRenamed("carried", "n"), "spelling-forward")
    backward = numbered(forward.select(F.reverse("word").alias("word"), F.col("rank").alias("carried")))
    paths = forward.select("rank", "n", "fresh", F.col("nodes").alias("before")).join(
        backward.select(F.col("carried").alias("rank"), F.col("nodes").alias("behind")), "rank"
    )
    words = forward.select("rank", "word", "n")
    near = words.join(neighbours(paths), "rank", "left")
    fits = -F.col("best.less") >= factor * F.col("n")
    near = near.select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.rank")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    near = cut_lineage(near, "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    of_form = words.select(F.col("rank").alias("form"), F.col("word").alias("form_word"))
    of_root = words.select(F.col("rank").alias("root"), F.col("word").alias("root_word"))
    found = near.join(ends, "rank", "left").join(of_form, "form", "left").join(of_root, "root", "left")
    return found.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of a table, each with its more frequent form and the form at the end of the path."""
    return variants(cut_lineage(word_counts(docs, id_col, text), "spelling-words"))
