"""The automaton against comparing all windows."""

import random
import re

import pytest

from weeksignal.llm import decontaminate as D


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items):
    doc, hit, ids = words(text), set(), set()
    for item, body in items:
        w = words(body)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for k in range(len(doc) - size + 1):
                if doc[k : k + size] == w[i : i + size]:
                    hit |= set(range(k, k + size))
                    ids.add(str(item))
    return len(doc), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(doc)


def run(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.judged(docs, bench).select("row.doc_id", "v.*").collect()
    return {r["doc_id"]: r for r in rows}


def cases():
    rng = random.Random(3)
    some = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(10, some(20)), (9, some(14)), (9, some(13)), (3, "A-b!"), (4, ""), (5, None), (6, "É x"), (11, some(13))]
    texts = [None, "", "...", "É X y", "É x", "a b", *[some(rng.randrange(1, 120)) for _ in range(60)]]
    texts += [f"{some(30)}, {items[0][1].upper()}; {some(40)}" for _ in range(5)]
    return texts, items


def test_equals_comparing_all_windows(spark, monkeypatch):
    texts, items = cases()
    for size, broadcast in ((1 << 18, 0), (60, 1 << 20), (60, 0)):
        monkeypatch.setattr(D, "AUTOMATON_BYTES", size)
        monkeypatch.setattr(D, "BROADCAST_FOUND", broadcast)
        found = run(spark, texts, items)
        for k, text in enumerate(texts):
            row = found[k]
            assert (row["n_words"], row["n_hit"], row["item_ids"], row["contaminated"]) == plain(text, items), text


def test_a_large_benchmark_goes_by_windows(spark, monkeypatch):
    rng = random.Random(5)
    items = [(k, " ".join(f"w{rng.randrange(90_000)}" for _ in range(60))) for k in range(1200)]
    items.append((1200, " ".join(f"only{k}" for k in range(30_000))))  # an item that is too large for an automaton by itself
    texts = [f"so {items[7][1]} and", items[1200][1][500:9000], " ".join(items[9][1].split()[:12]), None, ""]
    monkeypatch.setattr(D, "_by_automaton", None)
    found = run(spark, texts, items)
    assert [found[k]["item_ids"] for k in range(5)] == [["7"], ["1200"], [], [], []]
    assert [found[k]["n_hit"] for k in (0, 2, 3)] == [60, 0, 0] and found[0]["spans"][0]["start"] == 3
    assert found[1]["n_hit"] > 900 and [found[k]["contaminated"] for k in range(5)] == [True, True, False, False, False]


@pytest.mark.parametrize("size", [1 << 18, 0])
def test_repeated_rows_and_ids(spark, monkeypatch, size):
    monkeypatch.setattr(D, "AUTOMATON_BYTES", size)
    docs = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 1), (None, "a b", 2), (1, "x", 3), (2, None, 4)], "doc_id long, text string, key int")
    bench = spark.createDataFrame([(1, "B c"), (1, "B c"), (None, "x")], "item_id long, text string")
    rows = D.judged(docs, bench).select("row.*", "v.n_hit", "v.item_ids").collect()
    assert sorted((r["key"], r["n_hit"], r["item_ids"]) for r in rows) == [(1, 2, ["1"]), (1, 2, ["1"]), (2, 0, []), (3, 1, [""]), (4, 0, [])]
    assert sorted(r["key"] for r in D.clean(docs, bench).collect()) == [2, 4]


def test_spans_lie_on_the_original(spark):
    item = " ".join(f"wörd{k}" for k in range(15))
    text = f"Ünrelated; {item.replace('d', 'D').replace(' ', ' -- ')}! rest"
    span = run(spark, [text], [(1, item)])[0]["spans"][0]
    assert text[span["start"] : span["end"]] == item.replace("d", "D").replace(" ", " -- ")


def test_empty_benchmark_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c", 1, 2), (1, "a b c", 1, 2)], "doc_id long, text string, v int, t int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(docs, none).columns == docs.columns and D.clean(docs, none).count() == 2
    short = spark.createDataFrame([(1, "B c")], "item_id long, text string")
    assert D.clean(docs, short).count() == 0 and D.clean(docs.limit(0), short).count() == 0
