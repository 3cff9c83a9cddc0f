"""Exact copies against a plain grouping by text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from weeksignal.llm import exact_copies as E


def plain(rows):
    groups = {}
    for place, (doc_id, text) in enumerate(rows):
        groups.setdefault((text or "").encode().lower(), []).append((doc_id is not None, doc_id or 0, -place, doc_id))
    out = []
    for text, members in groups.items():
        members.sort(reverse=True)
        for k, member in enumerate(members):
            out.append((member[3], members[0][3], len(members), k == 0, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def run(df, **kind):
    return sorted(map(tuple, E.exact_copies(df, **kind).collect()), key=repr)


def corpus():
    rng = random.Random(5)
    rows = [(k, rng.choice(["the Same text", "THE same TEXT", "Ärger", "ärger", "", None, " ", f"own {k}", f"pair {k // 2}"])) for k in range(900)]
    rows += [(None, "the same text"), (None, "only null"), (None, "ONLY null"), (7, "tie"), (7, "TIE"), (-3, "x" * 300_000), (-9, "X" * 300_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, bucket int, key int")


@pytest.mark.parametrize("bucket_bytes", [1, 200, E.BUCKET_BYTES])
def test_equals_a_plain_grouping(spark, bucket_bytes):
    rows = corpus()
    assert run(frame(spark, rows), bucket_bytes=bucket_bytes) == plain(rows)


def test_empty_table(spark):
    assert run(frame(spark, [(1, "a")]).limit(0)) == []


def test_equal_hashes_are_told_apart_by_bytes(spark):
    """Two texts of one key chain up; each keeps its own group."""
    rows = [(11, 5, 0, b"one", 2, 40), (12, 5, 0, b"two", 1, 50), (13, 5, 0, b"one", 3, 60), (14, 6, 0, b"one", 1, 1)]
    df = spark.createDataFrame(rows, "entry long, key long, bucket long, text binary, n long, max_id long").coalesce(1)
    df = df.select("entry", "bucket", "key", "max_id", "n", "text").sortWithinPartitions("key", "entry")
    found = {r["entry"]: (r["keep_id"], r["group_size"], r["wins"]) for r in df.mapInArrow(E._owner, E._OWNED).collect()}
    assert found == {11: (60, 5, False), 13: (60, 5, True), 12: (50, 1, True), 14: (1, 1, True)}


def test_buckets_split_until_they_fit_or_hold_one_key(spark):
    rng = random.Random(1)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(400)] + [-1] * 50 + [0, 1, 2, 3]
    entries = spark.createDataFrame([(k, 10) for k in keys], "key long, length long")
    found, table = E.directory(entries, 100)
    assert len(found.splits) > 0
    for r in table.collect():
        assert r["bytes"] <= 100 or r["low"] == r["high"]
    placed = {r["key"]: r["bucket"] for r in found.place(entries.select("key")).collect()}
    for key, bucket in placed.items():
        depth = bucket.bit_length() - 1
        assert bucket == (1 << depth) | ((key % 2**64) >> (64 - depth))
    ranges = sorted((b << (63 - b.bit_length() + 1)) - 2**63 for b in set(placed.values()))
    assert len(ranges) == len(set(ranges))  # no bucket lies in another


def test_entries_are_closed_and_repeated_texts_held(spark, monkeypatch):
    monkeypatch.setattr(E, "ENTRY_ROWS", 7)
    monkeypatch.setattr(E, "HELD_BYTES", 900)

    class Context:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(E.TaskContext, "get", staticmethod(Context))
    import pyarrow as pa

    texts = ["often"] * 20 + [f"text {k}" for k in range(30)] + ["often"] * 3
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = [r for b in E._collapse(iter([batch])) for r in b.to_pylist()]
    assert len({r["entry"] for r in rows}) == len(rows) and all(r["entry"] >> 36 == 3 for r in rows)
    assert sorted(i for r in rows for i in r["ids"]) == list(range(len(texts)))
    assert max(r["n"] for r in rows) == 7 and sum(r["text"] == b"often" for r in rows) == 4


def test_one_row_of_each_group_is_kept(spark):
    out = E.exact_copies(frame(spark, corpus()))
    per = out.groupBy("text_sha256").agg(F.sum(F.col("kept").cast("int")).alias("k"), F.count(F.lit(1)).alias("n"), F.max("group_size").alias("g"))
    assert per.where("k <> 1 OR n <> g").count() == 0
