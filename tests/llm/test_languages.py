"""Language ID: sums over segmentations by enumeration, accuracy on held-out documents."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from weeksignal.llm import languages as L

PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]


def model(pieces=PIECES, names=("de", "en"), seed=1):
    p = np.random.default_rng(seed).random((len(pieces) + 2, len(names)))
    p[-1] = 0
    return L.Model(list(names), np.log(np.full(len(names), 1 / len(names))), {x: k for k, x in enumerate(pieces)}, p / p.sum(axis=0))


def segmentations(marked, m):
    """All ways to cut a marked word, as lists of piece numbers."""
    if not marked:
        yield []
    for k in range(1, len(marked) + 1):
        number = m.pieces.get(marked[:k], len(m.pieces) if k == 1 else None)
        if number is not None:
            for rest in segmentations(marked[k:], m):
                yield [number, *rest]


@pytest.mark.parametrize("word", ["a", "ab", "abab", "xyz", "abaxba"])
def test_forward_and_backward_sums_equal_enumeration(word):
    m = model()
    ways = list(segmentations(L.START + word, m))
    for k in range(2):
        weights = [math.prod(m.probability[n, k] for n in way) for way in ways]
        assert np.isclose(m.log_words([word])[0, k], math.log(sum(weights)))
        want = np.zeros(len(m.probability))
        for way, w in zip(ways, weights, strict=True):
            for n in way:
                want[n] += 3 * w / sum(weights)
        assert np.allclose(m.expected([word], np.array([3.0]), k), want)


def test_long_words_stay_in_range():
    values = model().log_words(["ab" * 3000])
    assert np.isfinite(values).all() and (values < -1000).all()


@pytest.mark.parametrize("n", [1, 20, 33, 100])
def test_plain_sums_and_sums_in_logarithms_agree(n):
    m, word = model(), "abaxb" * n
    plain, L.LONG = L.LONG, 10**9 if n < 40 else L.LONG
    try:
        want, uses = m.log_words([word])[0], m.expected([word], np.array([2.0]), 1)
    finally:
        L.LONG = plain
    assert np.allclose(m._log_long(word), want)
    assert np.allclose(m._expected_in_logs([word], np.array([2.0]), 1), uses)
    assert np.isclose(sum(uses[k] * len(p) for p, k in m.pieces.items()) + uses[len(m.pieces)], 2 * len(L.START + word))


def test_improbable_words_are_counted():
    m = model()
    m.probability[:-1] = 1e-12
    uses = m.expected(["ab" * 16, "b" * 32], np.array([1.0, 3.0]), 0)
    assert np.isfinite(uses).all()
    assert np.isclose(sum(uses[k] * len(p) for p, k in m.pieces.items()) + uses[len(m.pieces)], 4 * 33)


def test_long_words_are_learned_whole(spark):
    words = ["ab" * 40 + "ba", "aba" * 200, "ab"]
    docs = spark.createDataFrame([("de", " ".join(words)), ("en", "xy"), ("en", None)], "lang string, text string")
    m = L.fit(docs, PIECES, rounds=1)
    first = model()
    first.probability[:] = 1.0 / (len(PIECES) + 1)
    want = sum(first.expected([w], np.array([1.0]), 0) for w in words) + L.SMOOTHING
    want[-1] = 0
    assert np.allclose(m.probability[:, 0], want / want.sum(), atol=1e-6)


def test_a_plain_version_learns_and_predicts_the_same(spark):
    texts = [("de", "abab ab½ba"), ("de", "ba aba"), ("en", "bb b xb"), ("en", "bx bbb"), (None, "ab"), ("en", "")]
    docs = spark.createDataFrame(texts, "lang string, text string")
    got = L.fit(docs, PIECES)
    m = model()
    m.prior, m.probability = np.log([2 / 5, 3 / 5]), np.full(m.probability.shape, 1.0 / (len(PIECES) + 1))
    for _ in range(L.ROUNDS):
        sums = np.full(m.probability.shape, L.SMOOTHING)
        for lang, text in texts:
            for word in text.replace("½", " ").split() if lang else ():
                k = ["de", "en"].index(lang)
                ways = list(segmentations(L.START + word, m))
                weights = [math.prod(m.probability[n, k] for n in way) for way in ways]
                for way, w in zip(ways, weights, strict=True):
                    for n in way:
                        sums[n, k] += w / sum(weights)
        sums[-1] = 0
        m.probability = sums / sums.sum(axis=0)
    assert np.allclose(got.probability, m.probability, atol=1e-5) and np.allclose(got.prior, m.prior)
    rows = docs.select("text", L.predictions(F.col("text"), got, spark).alias("p")).select("text", "p.*").collect()
    for r in rows:
        likely = [
            m.prior[k] + sum(math.log(sum(math.prod(m.probability[n, k] for n in way) for way in segmentations(L.START + w, m)))
                             for w in r["text"].replace("½", " ").split())
            for k in range(2)
        ]
        want = ["de", "en"][int(np.argmax(likely))] if r["text"] else "und"
        assert r["lang_pred"] == want
        assert not r["text"] or np.isclose(r["score"], 1 / sum(math.exp(x - max(likely)) for x in likely), atol=1e-3)


def test_null_empty_letterless_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "12 ²! _", "de"), (4, "hello there", None)], "doc_id long, text string, lang string")
    for m in (model(), L.fit(docs.where("lang IS NULL"), PIECES)):
        rows = docs.select("doc_id", L.predictions(F.col("text"), m, spark).alias("p")).select("doc_id", "p.*").collect()
        got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
        assert got[1] == got[2] == got[3] == ("und", 0.0)
        assert (got[4][0] in ("de", "en") and 0 < got[4][1] <= 1) if m.languages else got[4] == ("und", 0.0)
    assert docs.limit(0).select(L.predictions(F.col("text"), model(), spark)).count() == 0


def test_held_out_accuracy_and_no_peeking(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = L.held_out(F.col("doc_id"))
    m = L.fit(docs.where(~out).select("text", "lang"), L.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    assert np.allclose(m.probability.sum(axis=0), 1)
    rows = docs.where(out).select("lang", L.predictions(F.col("text"), m, spark).alias("p")).select("lang", "p.*").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 20
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_two_rounds_raise_the_likelihood(spark):
    docs = spark.createDataFrame([("de", "abab ab aba"), ("de", "ba"), ("en", "xy yx xxy"), (None, "q")], "lang string, text string")
    counts = {(r["lang"], r["word"]): r["n"] for r in L.word_counts(docs).collect()}
    assert counts["de", "ab"] == 1 and ("de", "q") not in counts
    one, three = (L.fit(docs, PIECES, rounds=k) for k in (1, 3))
    total = lambda m: sum(n * m.log_words([w])[0, m.languages.index(lang)] for (lang, w), n in counts.items())
    assert total(three) > total(one)
