"""Shards against one sorted list."""

import hashlib
import random
import zlib

import pytest

from weeksignal.llm import sharding


def plain(rows, shards):
    """Sort by digest and id; a row's shard follows from the bytes before it."""
    def key(row):
        text = row[1] or ""
        return hashlib.md5(text.encode()).hexdigest()[:16], -(2**63) - 1 if row[0] is None else row[0]

    ordered = sorted(rows, key=key)
    total = sum(len((t or "").encode()) + 16 for _, t in ordered)
    out, before, last, slot = {}, 0, -1, 0
    for doc_id, text in ordered:
        size = len((text or "").encode()) + 16
        shard = before * shards // total
        slot = slot + 1 if shard == last else 0
        last = shard
        out[doc_id] = (size, zlib.crc32((text or "").encode()), shard, slot)
        before += size
    return out


def run(spark, rows, shards=7):
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, shard string"), shards).collect()
    return {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found}


@pytest.mark.parametrize("hot", [0, 400])
def test_equals_a_sorted_list(spark, hot):
    rng = random.Random(hot)
    rows = [(k - 50, "".join(rng.choice("aé ") for _ in range(rng.randrange(200)))) for k in range(300)]
    rows += [(1000 + k, "the same text") for k in range(hot)] + [(5000, None), (5001, ""), (5002, "x" * 20_000), (None, "no id")]
    assert run(spark, [(*r, "clash") for r in rows]) == plain(rows, 7)


def test_shards_are_near_equal_and_slots_gapless(spark):
    rows = [(k, "w" * (k % 90), None) for k in range(3000)]
    found = run(spark, rows, 10)
    sizes, slots = {}, {}
    for size, _, shard, slot in found.values():
        sizes[shard] = sizes.get(shard, 0) + size
        slots.setdefault(shard, []).append(slot)
    assert set(sizes) == set(range(10)) and max(sizes.values()) - min(sizes.values()) <= 2 * 106
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_repeated_rows_are_spread_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "same text")] * 300 + [(k, f"own text {k}") for k in range(2, 302)] + [(None, "same text")] * 50, "doc_id long, text string")
    rows = sharding.shard(df, 10).collect()
    sizes, slots = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == 650 and set(sizes) == set(range(10)) and max(sizes.values()) - min(sizes.values()) <= 60
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard(df.limit(0), 4).count() == 0
