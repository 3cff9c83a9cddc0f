"""Benchmark decontamination with one Aho-Corasick automaton.

The items' windows of normalised words are the patterns of one automaton. It reads three
characters a word, the digits of the word's number among the items' words, from three
separate ranges, so a match can only begin at a word; all other words share one code. Each
text is normalised once, A-Z lowered, scanned once, and the matched word ranges are mapped to
code points of the original text. Documents never leave their partition: no shuffle.

One automaton takes items of up to ``AUTOMATON_BYTES`` (measured first; about 120 MB in a
worker). The windows of a larger benchmark are rows and never pass the driver: a filter of
bits of bounded size, sent to the workers, picks the windows of the texts that may be among
them, and an equality join on the windows' words decides. Only such windows are shuffled.

Defined cases: a null or empty text has no words and is clean; a null or wordless item has
no window; equal items all count; an empty benchmark finds nothing; an empty table gives
an empty result. A text is scanned whole, whatever its length. Further columns stay as they
are, in a struct of their own, so no name clashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.llm.rows import cached, text_bytes
from weeksignal.session import cut_lineage

WINDOW = 13
#: One automaton is built for items of at most so many bytes in all, each counted with ``ITEM_BYTES`` more.
AUTOMATON_BYTES, ITEM_BYTES = 1 << 18, 16
#: Bits a window in the filter of larger benchmarks, and its most bits (128 MB); a fuller filter lets more windows pass.
WINDOW_BITS, MOST_BITS = 16, 1 << 30
#: The filter is made in chunks of so many bits.
CHUNK_BITS = 1 << 16
#: What was found in texts is broadcast up to so many numbers, else joined by a shuffle.
BROADCAST_FOUND = 1_000_000

RESULT = (
    "struct<n_words: long, n_hit: long, item_ids: array<string>, contaminated: boolean, "
    "spans: array<struct<start: long, end: long>>>"
)
_RESULT_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("contaminated", pa.bool_()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])

#: ASCII bytes that are no digit or letter become a space, capitals small letters; others stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text."""
    return text.translate(_FOLD).split()


def _code(number: int) -> bytes:
    """Digits to the base 80: more words than an automaton's bytes can hold."""
    return bytes((number // 6400 % 80, 80 + number // 80 % 80, 160 + number % 80))


_OTHER = b"\xff\xff\xff"


class Matcher:
    """The automaton; each pattern leads to its number of words and the items it belongs to."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.codes: dict[bytes, bytes] = {}
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            words = normal_words(text)
            codes = [self.codes.setdefault(w, _code(len(self.codes))) for w in words]
            for k in range(max(1, len(words) - WINDOW + 1) if words else 0):
                owners.setdefault(b"".join(codes[k : k + WINDOW]), set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.automaton.add_word(window.decode("latin-1"), (len(window) // 3, ids))
        if owners:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (end exclusive) of the occurrences, and the items they belong to."""
        if not self.codes or not words:
            return [], set()
        get = self.codes.get
        coded = b"".join([get(w, _OTHER) for w in words]).decode("latin-1")
        ranges, ids = [], set()
        for last, (length, owners) in self.automaton.iter(coded):
            end = (last + 1) // 3
            ranges.append((end - length, end))
            ids |= owners
        return ranges, ids


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code points of the original text."""
    if not ranges:
        return []
    gap = np.concatenate(([True], np.frombuffer(text.translate(_FOLD), np.uint8) == 32, [True]))
    bounds = np.flatnonzero(gap[1:] != gap[:-1])  # where words begin and end, in turn
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(before[bounds[2 * a]]), "end": int(before[bounds[2 * b - 1]])} for a, b in ranges]


def judge(text: bytes, ranges: list[tuple[int, int]], ids: set[str], n_words: int) -> dict:
    merged = merge(ranges)
    hit = sum(end - first for first, end in merged)
    return {
        "n_words": n_words, "n_hit": hit, "item_ids": sorted(ids), "contaminated": hit > 0 and 20 * hit >= n_words,
        "spans": original_spans(text, merged),
    }


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[int, bytes]]:
    """Number of the first word and the words of each window."""
    for k in range(len(words) - size + 1):
        yield k, b" ".join(words[k : k + size])


def _places(windows: list[bytes], bits: int) -> np.ndarray:
    """Two places in the filter for each window."""
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in windows], np.uint64)
    return np.stack((hashed % np.uint64(bits), (hashed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)) % np.uint64(bits))).astype(np.int64)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0), text_bytes(batch.column(1)), strict=True):
            words = normal_words(text)
            size = min(WINDOW, len(words))
            found = sorted({w for _, w in windows_of(words, size)}) if words else []
            columns = [pa.array(found, pa.binary()), pa.array([size] * len(found), pa.int32()), pa.array([item.as_py()] * len(found), pa.string())]
            yield pa.record_batch(columns, ["window", "size", "item"])


def _filter_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0).to_pylist(), bits).reshape(-1)
            yield pa.record_batch([pa.array(at // CHUNK_BITS), pa.array(at % CHUNK_BITS)], ["chunk", "bit"])

    return run


def _chunk(rows: pa.Table) -> pa.Table:
    marks = np.zeros(CHUNK_BITS, np.uint8)
    marks[rows["bit"].to_numpy()] = 1
    return pa.table({"chunk": rows["chunk"].slice(0, 1), "bits": pa.array([np.packbits(marks).tobytes()], pa.binary())})


def _filter(windows: DataFrame) -> tuple[int, np.ndarray]:
    """The filter's number of bits and its bytes, at most ``MOST_BITS``, whatever the benchmark."""
    bits = CHUNK_BITS
    wanted = min(MOST_BITS, WINDOW_BITS * windows.count())
    while bits < wanted:
        bits *= 2
    places = windows.mapInArrow(_filter_places(bits), "chunk long, bit long").distinct()
    out = np.zeros(bits // 8, np.uint8)
    for row in places.groupBy("chunk").applyInArrow(_chunk, "chunk long, bits binary").toLocalIterator():
        first = row["chunk"] * (CHUNK_BITS // 8)
        out[first : first + CHUNK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits, out


def _likely(shared: Broadcast, bits: int, sizes: list[int]):
    """Rows key, text to those of the text's windows that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            for key, text in zip(batch.column(0), text_bytes(batch.column(1)), strict=True):
                words = normal_words(text)
                for size in sizes:
                    for at in range(0, len(words) - size + 1, 65_536):
                        block = [w for _, w in windows_of(words[at : at + 65_536 + size - 1], size)]
                        place = _places(block, bits)
                        passed = np.flatnonzero(np.all(marks[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1, axis=0))
                        columns = [
                            pa.array([key.as_py()] * len(passed), pa.string()), pa.array(at + passed),
                            pa.array(at + passed + size), pa.array([block[k] for k in passed], pa.binary()),
                        ]
                        yield pa.record_batch(columns, ["key", "first", "end", "window"])

    return run


def _judge(column: pa.Array, ranges: pa.Array, ids: pa.Array) -> pa.Array:
    out = []
    for text, places, items in zip(text_bytes(column), ranges, ids, strict=True):
        found = [(p["first"], p["end"]) for p in places.as_py() or ()]
        out.append(judge(text, found, set(items.as_py() or ()), len(normal_words(text))))
    return pa.array(out, _RESULT_ARROW)


def _by_automaton(column: Column, items: DataFrame) -> Column:
    """A column of ``RESULT``; the items are of a size that was checked."""
    shared = items.sparkSession.sparkContext.broadcast([(r["item"], r["text"].encode()) for r in items.collect()])
    key = uuid.uuid4().hex

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        matcher, out = cached(key, lambda: Matcher(shared.value)), []
        for text in text_bytes(texts):
            words = normal_words(text)
            out.append(judge(text, *matcher.find(words), len(words)))
        return pa.array(out, _RESULT_ARROW)

    return scan(column)


def _by_windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (row, text) with their verdict; equal texts are told by their digest."""
    spark = items.sparkSession
    windows = cut_lineage(items.mapInArrow(_item_windows, "window binary, size int, item string").distinct(), "bench-windows")
    alone = windows.select("window").distinct()
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # 13 at most
    bits, marks = _filter(alone)
    keyed = rows.withColumn("key", F.sha2("text", 256))
    likely = keyed.where("text <> ''").select("key", "text").mapInArrow(
        _likely(spark.sparkContext.broadcast(marks), bits, sizes), "key string, first long, end long, window binary"
    )
    hits = cut_lineage(likely.join(alone, "window", "left_semi").distinct(), "bench-hits")
    ranges = hits.groupBy("key").agg(F.collect_set(F.struct("first", "end")).alias("ranges"))
    owners = hits.select("key", "window").distinct().join(windows, "window").groupBy("key").agg(F.collect_set("item").alias("ids"))
    found = cut_lineage(ranges.join(owners, "key"), "bench-found")
    size = found.agg(F.sum(F.size("ranges") + F.size("ids") + 8)).first()[0] or 0
    joined = keyed.join(F.broadcast(found) if size <= BROADCAST_FOUND else found, "key", "left")
    return joined.select("row", F.arrow_udf(_judge, RESULT)("text", "ranges", "ids").alias("v"))


def judged(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``row``, a document with the columns it came with, and ``v``, its ``RESULT`` against a benchmark table."""
    bench = items.select(F.coalesce(items[f"`{item_id}`"].cast("string"), F.lit("")).alias("item"), items[f"`{item_text}`"].alias("text"))
    bench = bench.where("text IS NOT NULL")
    size = bench.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text}`"].alias("text"))
    if size <= AUTOMATON_BYTES:
        return rows.select("row", _by_automaton(F.col("text"), bench).alias("v"))
    return _by_windows(rows, bench)


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are not contaminated, with the columns they came with."""
    return judged(docs, items, text).where("NOT v.contaminated").select("row.*")
