"""Exact copies by an extendible-hash index on shared files.

A text is lower-cased in A-Z only. Each task collapses equal texts of its rows to entries
(key, text, ids) and writes them to the shared folder; the key is a 64-bit hash. So a text that
fills a third of the table is a few entries a task.

The directory starts with as many buckets as the entries' bytes ask for. A bucket is a range of
keys: number 1 is the whole range, 2b and 2b + 1 are the halves of b. Buckets that hold more than
``BUCKET_BYTES`` and more than one key are split, the directory doubling where they were as deep
as it, until none is overfull. A split goes at once to the first bit in which the bucket's keys
differ. The directory stays a table on shared files; the driver sees only whether any bucket was
split.

Owner tasks then read whole buckets in order of the key. Entries of one key are a chain: each is
compared byte by byte with the different texts of the chain, so equal hashes never make two texts
one. A task holds the texts of one chain at a time and streams through the rest. Owners return
numbers only, and each entry's rows get the result by the entry's number, which spreads the rows
of a frequent text over its entries.

Defined cases: a null text counts as empty, and empty texts are copies of each other; a null id is
smaller than all others, so ``keep_id`` is null only where all ids of a group are; of rows equal in
text and id one is kept; an empty table gives an empty result; further columns, whatever their
names, are ignored by ``exact_copies``. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.session import cut_lineage

BUCKET_BYTES = 64 << 20
#: A task lets go of its entries at so many bytes of text, an entry is closed at so many rows.
HELD_BYTES, ENTRY_ROWS = 32 << 20, 1 << 16
#: Up to so many split buckets a round are broadcast (16 bytes each), more are joined by a shuffle.
BROADCAST_BUCKETS = 1_000_000

_ENTRY = "entry long, key long, length long, n long, max_id long, ids array<long>, digest binary, text binary"
_ENTRY_ARROW = pa.schema([
    ("entry", pa.int64()), ("key", pa.int64()), ("length", pa.int64()), ("n", pa.int64()), ("max_id", pa.int64()),
    ("ids", pa.list_(pa.int64())), ("digest", pa.binary()), ("text", pa.binary()),
])
_OWNED = "entry long, bucket long, keep_id long, group_size long, wins boolean"
_OWNED_ARROW = pa.schema([
    ("entry", pa.int64()), ("bucket", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("wins", pa.bool_()),
])


def hash_key(text: bytes) -> int:
    """The signed 64-bit key of a normalised text."""
    return int.from_bytes(xxhash.xxh3_64_digest(text), "big", signed=True)


def _rank(doc_id: int | None) -> tuple[bool, int]:
    return doc_id is not None, doc_id or 0


def _entry_batches(entries: list[tuple[bytes, list]], number: Iterator[int]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for text, ids in entries:
        ids.sort(key=_rank, reverse=True)
        rows.append((next(number), hash_key(text), len(text), len(ids), ids[0], ids, hashlib.sha256(text).digest(), text))
        size += len(text)
        if size > HELD_BYTES // 2:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENTRY_ARROW, strict=True)], _ENTRY_ARROW)
            rows, size = [], 0
    if rows:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENTRY_ARROW, strict=True)], _ENTRY_ARROW)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows id, text to entries; texts met again stay when the others are let go."""
    number = iter(range(TaskContext.get().partitionId() << 36, (TaskContext.get().partitionId() + 1) << 36))
    held: dict[bytes, list] = {}
    size = 0
    for batch in batches:
        for doc_id, value in zip(batch.column(0), batch.column(1).cast(pa.large_binary()), strict=True):
            text = (value.as_py() or b"").lower()
            ids = held.get(text)
            if ids is None:
                ids = held[text] = []
                size += len(text) + 200
            ids.append(doc_id.as_py())
            if len(ids) >= ENTRY_ROWS:
                yield from _entry_batches([(text, held.pop(text))], number)
                size -= len(text) + 200
            if size > HELD_BYTES:
                often = {t: i for t, i in held.items() if len(i) > 1}
                if 2 * sum(len(t) + 200 for t in often) > HELD_BYTES:
                    often = {}
                yield from _entry_batches([x for x in held.items() if x[0] not in often], number)
                held, size = often, sum(len(t) + 200 for t in often)
    yield from _entry_batches(list(held.items()), number)


class Directory:
    """Which bucket a key belongs to: a first depth, and the buckets split since, round by round."""

    def __init__(self, depth: int, bucket_bytes: int):
        self.depth, self.bucket_bytes = depth, bucket_bytes
        self.splits: list[tuple[DataFrame, bool]] = []

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have a column key, with their bucket."""
        names = rows.columns
        rows = rows.withColumn("bucket", _bucket(F.lit(self.depth)))
        for table, small in self.splits:
            rows = rows.join(F.broadcast(table) if small else table, "bucket", "left").select(
                *names, F.when(F.col("at").isNull(), F.col("bucket")).otherwise(_bucket(F.col("at"))).alias("bucket")
            )
        return rows

    def split(self, counted: DataFrame) -> bool:
        """Split the buckets that hold too much, given bucket, bytes, low and high key; whether there were any."""
        # the first bit in which two keys differ follows what they share
        deeper = F.expr("1 + greatest(length(bin(bucket)) - 1, 64 - length(bin(low ^ high)))").cast("int")
        overfull = counted.where((F.col("bytes") > self.bucket_bytes) & (F.col("low") != F.col("high")))
        table = cut_lineage(overfull.select("bucket", deeper.alias("at")), "exact-splits")
        n = table.count()
        if n:
            self.splits.append((table, n <= BROADCAST_BUCKETS))
        return n > 0


def _bucket(depth: Column) -> Column:
    """The number of the bucket of ``key`` at a depth: its leading bits behind a one."""
    leading = F.call_function("shiftrightunsigned", F.col("key"), F.lit(64) - depth)
    return F.when(depth == 0, F.lit(1)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), depth).bitwiseOR(leading)).cast("long")


def directory(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[Directory, DataFrame]:
    """The directory of entries (key, length), and its table: bucket, depth, bytes, entries, low, high."""
    total = entries.agg(F.sum("length")).first()[0] or 0
    found = Directory(max(0, -(-total // bucket_bytes) - 1).bit_length(), bucket_bytes)
    while True:
        counted = found.place(entries.select("key", "length")).groupBy("bucket").agg(
            F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("entries"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        counted = cut_lineage(counted, "exact-directory")
        if not found.split(counted):
            return found, counted.withColumn("depth", F.expr("length(bin(bucket)) - 1"))


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of bucket and key to the results of their chains."""
    last, chain, out = None, [], []

    def close() -> None:
        for _, best, winner, n, members in chain:
            out.extend((entry, bucket, best, n, entry == winner) for entry, bucket in members)

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OWNED_ARROW, strict=True)], _OWNED_ARROW)

    for batch in batches:
        numbers = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
        for (entry, bucket, key, max_id, n), value in zip(numbers, batch.column(5).cast(pa.large_binary()), strict=True):
            if key != last:
                close()
                last, chain = key, []
            text = value.as_py()
            for link in chain:
                if link[0] == text:
                    if _rank(max_id) > _rank(link[1]):
                        link[1], link[2] = max_id, entry
                    link[3] += n
                    link[4].append((entry, bucket))
                    break
            else:
                chain.append([text, max_id, entry, n, [(entry, bucket)]])
        if len(out) > 10_000:
            yield batch_of(out)
            out.clear()
    close()
    if out:
        yield batch_of(out)


def exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, a row for each row of the input."""
    slim = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    entries = cut_lineage(slim.mapInArrow(_collapse, _ENTRY), "exact-entries")
    found, _ = directory(entries, bucket_bytes)
    chains = found.place(entries.select("entry", "key", "max_id", "n", "text")).repartition("bucket")
    chains = chains.select("entry", "bucket", "key", "max_id", "n", "text").sortWithinPartitions("bucket", "key", "entry")
    owned = cut_lineage(chains.mapInArrow(_owner, _OWNED), "exact-index")
    rows = entries.select("entry", "ids", "digest").join(owned, "entry")
    rows = rows.select(F.posexplode("ids").alias("place", "doc_id"), "keep_id", "group_size", "wins", "digest")
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("wins") & (F.col("place") == 0)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
