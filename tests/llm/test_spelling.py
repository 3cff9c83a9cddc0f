"""Spelling variants against comparing all words."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from weeksignal.llm import spelling as S


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    found = {w: [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and near(v, w)] for w in counts}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(found[w]), counts.get(form[w])) for w, n in counts.items()), key=repr)


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def run_variants(spark, counts):
    return sorted(map(tuple, S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghij"])
def test_equals_comparing_all_words(spark, letters):
    rng = random.Random(len(letters))
    counts = {"".join(rng.choices(letters, k=rng.randrange(5, 9))): rng.choice([3, 4, 6, 7, 20, 100]) for _ in range(250)}
    assert run_variants(spark, counts) == plain_variants(counts)


def test_long_words_and_one_word(spark):
    long = "ab" * 30_000
    counts = {long: 9, long + "a": 3, long[:30_000] + "c" + long[30_001:]: 4, "b" * 20_000: 5, "b" * 19_999: 50, "a" * 5: 3}
    assert run_variants(spark, counts) == plain_variants(counts)
    assert run_variants(spark, {"alone": 3}) == [("alone", None, "alone", 3, 0, None)]


def test_nodes_are_numbered_alike_over_ranges(spark):
    """Every prefix has one number and every number one prefix, wherever ranges end."""
    rng = random.Random(4)
    words = sorted({"same" * 3 + "".join(rng.choices("xyz", k=rng.randrange(0, 7))) for _ in range(300)})
    found = S.numbered(spark.createDataFrame([(w, 1) for w in words], "word string, carried long")).collect()
    assert [r["word"] for r in sorted(found, key=lambda r: r["rank"])] == words
    names = {}
    for r in found:
        for k, node in enumerate(r["nodes"]):
            assert names.setdefault(node, r["word"][:k]) == r["word"][:k]
    assert len(set(names.values())) == len(names)


def test_words_of_documents(spark):
    rng = random.Random(9)
    vocabulary = ["Colour", "color", "colours", "ÄRGERN", "ärgern", "Ärgern", "naïve", "naive", "x" * 300, "tiny", "a×b÷c"]
    rows = [(rng.choice([None, *range(400)]), " ".join(rng.choices(vocabulary, k=12)) + "'s 12") for _ in range(300)]
    rows += [(1, None), (2, ""), (3, "123 !"), (4, "only twice"), (5, "only twice")]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert {r["word"]: r["n"] for r in S.word_counts(df).collect()} == plain_counts(rows)
    assert sorted(map(tuple, S.spelling_variants(df).collect()), key=repr) == plain_variants(plain_counts(rows))
    assert S.spelling_variants(df.limit(0)).count() == 0


def test_counts_are_let_go_in_parts(monkeypatch):
    monkeypatch.setattr(S, "_HELD_WORDS", 3)
    batch = pa.record_batch([pa.array([1, 2, 3], pa.int64()), pa.array(["alpha bravo charlie delta", "alpha bravo", "alpha"])], ["doc_id", "text"])
    parts = [b.to_pydict() for b in S._count(iter([batch]))]
    total = Counter()
    for p in parts:
        total.update(dict(zip(p["word"], p["n"], strict=True)))
    assert len(parts) == 2 and sum(total.values()) == 7
