"""Language identification by unigram pieces, all segmentations summed.

A fixed public vocabulary gives the pieces; per language each piece has a probability. A
word's probability is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words. Training counts every word of every
labelled document per language, then two rounds of expectation and maximisation turn the
word counts into piece probabilities by the forward and backward sums. Words are maximal
runs of letters and are learned and scored whole, however long they are: long words, and
words too improbable for plain numbers, are summed in logarithms with memory that grows
with one word only.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0;
a null label is not learned from; without any learned label everything is ``und``; ties
go to the language that sorts first; repeated rows are learned from and scored one by one;
an empty table gives an empty result; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.llm.rows import cached, texts
from weeksignal.session import cut_lineage

UNDETERMINED = "und"
#: Mark of the beginning of a word in the vocabulary (a fixed value).
START = "▁"
#: Added to each expected count, so that no piece is impossible.
SMOOTHING = 0.01
ROUNDS = 2
#: A worker keeps the scores of so many words; beyond that it begins anew.
KEPT_WORDS = 400_000
#: Texts that are scored together.
TEXTS = 256
#: Words of more letters are summed one by one; a worker keeps at most so many letters waiting while it learns.
LONG, WAITING = 64, 4_000_000
#: Below this the sum of a word's segmentations is taken again in logarithms.
TINY = 1e-250

_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = bytes(b | 32 if chr(b).isalpha() and b < 128 else 32 for b in range(256))


def vocabulary(model_path: str) -> list[str]:
    """Pieces of letters, with or without the mark; read on the driver, tens of thousands at most."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = (model.id_to_piece(k) for k in range(model.get_piece_size()))
    return sorted({START, *(p.lower() for p in pieces if _WORD.fullmatch(p.removeprefix(START)))})


@dataclass
class Model:
    """Log prior per language; piece probabilities, a row for each piece and a column for each language.

    The last two rows are a character without a piece, and what is no piece at all.
    """

    languages: list[str]
    prior: np.ndarray
    pieces: dict[str, int]
    probability: np.ndarray

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)

    def edges(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Start, end, the words (of one length) with a piece there, and these pieces; in order of the end."""
        marked, get, none = [START + w for w in words], self.pieces.get, len(self.pieces) + 1
        out = []
        for end in range(1, len(marked[0]) + 1):
            for start in range(max(0, end - self.longest), end):
                other = none - 1 if end - start == 1 else none
                found = np.array([get(m[start:end], other) for m in marked])
                rows = np.flatnonzero(found != none)
                if len(rows):
                    out.append((start, end, rows, found[rows]))
        return out

    def log_words(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, for words of one length and each language."""
        if len(words[0]) > LONG:
            return np.stack([self._log_long(w) for w in words])
        size = len(words[0]) + 2
        sums, scale = np.zeros((size, len(words), len(self.languages))), np.zeros((len(words), 1))
        sums[0] = 1.0
        for start, end, rows, found in self.edges(words):
            sums[end, rows] += sums[start, rows] * self.probability[found]
            if start == end - 1 and end % 16 == 0:  # the last edge to this end: keep long words within range
                top = sums[end].max(axis=1, keepdims=True)
                first = max(0, end - self.longest)
                sums[first : end + 1] = np.maximum(sums[first : end + 1] / top, 1e-290)
                scale += np.log(top)
        return np.log(sums[-1]) + scale

    def ending(self, marked: str, end: int) -> Iterator[tuple[int, int]]:
        """Size and number of the pieces of one word that end here."""
        get = self.pieces.get
        for size in range(1, min(end, self.longest) + 1):
            piece = get(marked[end - size : end], len(self.pieces) if size == 1 else None)
            if piece is not None:
                yield size, piece

    def _log_long(self, word: str) -> np.ndarray:
        """The same for one word; only the sums within a piece's length are kept."""
        marked, scale = START + word, np.zeros(len(self.languages))
        recent = deque([np.ones(len(self.languages))], maxlen=self.longest)
        for end in range(1, len(marked) + 1):
            now = sum(recent[-size] * self.probability[piece] for size, piece in self.ending(marked, end))
            recent.append(now)
            if end % 8 == 0:
                recent = deque([r / now for r in recent], maxlen=self.longest)
                scale += np.log(now)
        return np.log(recent[-1]) + scale

    def expected(self, words: list[str], weights: np.ndarray, language: int) -> np.ndarray:
        """Expected uses of each piece in words of one length, weighted: forward and backward sums."""
        if len(words[0]) > LONG:
            return self._expected_in_logs(words, weights, language)
        size = len(words[0]) + 2
        p, edges = self.probability[:, language], self.edges(words)
        forward, backward = np.zeros((2, size, len(words)))
        forward[0] = backward[-1] = 1.0
        for start, end, rows, found in edges:
            forward[end, rows] += forward[start, rows] * p[found]
        for start, end, rows, found in reversed(edges):
            backward[start, rows] += backward[end, rows] * p[found]
        # sums are at most one, so where the whole is not tiny no part that matters was lost
        tiny = forward[-1] < TINY
        share = np.where(tiny, 0.0, weights / np.where(tiny, 1.0, forward[-1]))
        uses = [share[rows] * forward[start, rows] * p[found] * backward[end, rows] for start, end, rows, found in edges]
        out = np.bincount(np.concatenate([e[3] for e in edges]), np.concatenate(uses), len(p))
        if tiny.any():
            out += self._expected_in_logs([words[k] for k in np.flatnonzero(tiny)], weights[tiny], language)
        return out

    def _expected_in_logs(self, words: list[str], weights: np.ndarray, language: int) -> np.ndarray:
        """The same in logarithms, one word after the other."""
        logs = [math.log(x) if x > 0 else -math.inf for x in self.probability[:, language].tolist()]
        out = np.zeros(len(logs))
        for word, weight in zip(words, weights.tolist(), strict=True):
            marked = START + word
            forward, backward = [0.0], [-math.inf] * len(marked) + [0.0]
            for end in range(1, len(marked) + 1):
                forward.append(_log_sum([forward[end - size] + logs[piece] for size, piece in self.ending(marked, end)]))
            for end in range(len(marked), 0, -1):
                for size, piece in self.ending(marked, end):
                    way = backward[end] + logs[piece]
                    backward[end - size] = _log_sum([backward[end - size], way])
                    out[piece] += weight * math.exp(forward[end - size] + way - forward[-1])
        return out


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


def by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and words, all of one length at a time, a few thousand at most."""
    places: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        places.setdefault(len(word), []).append(k)
    for same in places.values():
        for at in range(0, len(same), 4096):
            part = same[at : at + 4096]
            yield part, [words[k] for k in part]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, n over all given documents: counted in each task before the shuffle."""
    words = F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")
    return docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), words).where("word <> ''").groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n")
    )


def _expect(shared, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = cached(key, lambda: shared.value)
        totals = np.zeros(model.probability.shape[::-1])
        number = {name: k for k, name in enumerate(model.languages)}
        waiting: dict[tuple[int, int], tuple[list[str], list[int]]] = {}
        letters_waiting = 0

        def count() -> None:
            for (lang, _), (words, weights) in waiting.items():
                totals[lang] += model.expected(words, np.array(weights, float), lang)
            waiting.clear()

        # words of one language and length wait for each other, up to blocks of bounded size
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = (number[lang], len(word))
                words, weights = waiting.setdefault(place, ([], []))
                words.append(word)
                weights.append(n)
                letters_waiting += len(word)
                if len(words) == 4096:
                    del waiting[place]
                    letters_waiting -= 4096 * len(word)
                    totals[number[lang]] += model.expected(words, np.array(weights, float), number[lang])
                elif letters_waiting > WAITING:
                    count()
                    letters_waiting = 0
        count()
        totals = totals.T
        pieces, langs = np.nonzero(totals)
        columns = [pa.array(langs.astype(np.int32)), pa.array(pieces.astype(np.int32)), pa.array(totals[pieces, langs])]
        yield pa.record_batch(columns, ["lang", "piece", "n"])

    return run


def fit(docs: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang", rounds: int = ROUNDS) -> Model:
    """Learn from all given documents.

    What reaches the driver is one number for each language and piece. Sums of expected
    counts are rounded, so that the order of the tasks does not show.
    """
    counts = cut_lineage(word_counts(docs, text, lang), "language-words")
    labels = docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    labels = {r["lang"]: r["n"] for r in labels.collect()}
    languages, index = sorted(labels), {p: k for k, p in enumerate(pieces)}
    total = sum(labels.values())
    start = np.full((len(pieces) + 2, len(languages)), 1.0 / (len(pieces) + 1))
    start[-1] = 0.0
    model = Model(languages, np.log([labels[name] / total for name in languages]), index, start)
    for _ in range(rounds if languages else 0):
        shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
        found = counts.mapInArrow(_expect(shared, key), "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        expected = np.full(start.shape, SMOOTHING)
        expected[-1] = 0.0
        for row in found.collect():
            expected[row["piece"], row["lang"]] += round(row["n"], 6)
        model = Model(languages, model.prior, index, expected / expected.sum(axis=0))
    return model


def letters(text: str) -> list[str]:
    """Words of a text, small letters."""
    if text.isascii():
        return text.encode().translate(_LETTERS).decode().split()
    if not any(map(str.isalpha, text)):
        return []
    # what counts as a letter where words are counted for learning is one here too: not ½ or ²
    found = _WORD.findall(text.lower())
    return [part for word in found for part in ([word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split())]


class Scorer:
    """Scores texts; word scores are kept."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.empty((1 << 16, len(self.model.languages)))

    def _learn(self, words: list[str]) -> None:
        first = len(self.known)
        while first + len(words) > len(self.scores):
            self.scores = np.concatenate((self.scores, np.empty_like(self.scores)))
        for places, same in by_length(words):
            self.scores[[first + k for k in places]] = self.model.log_words(same)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def best(self, some: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(some)
        split = [letters(text) for text in some]
        if len(self.known) > KEPT_WORDS:
            self._forget()
        self._learn(sorted(set().union(*split).difference(self.known)))
        out, get = [], self.known.__getitem__
        for words in split:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            total = self.model.prior + self.scores[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
            place = int(np.argmax(total))
            out.append((self.model.languages[place], float(1.0 / np.exp(total - total[place]).sum())))
        return out


RESULT = "struct<lang_pred: string, score: double>"
_RESULT_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def predictions(text: Column, model: Model, spark) -> Column:
    """A column of ``RESULT``; the score is the language's share of the probability."""
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(column: pa.Array) -> pa.Array:
        scorer = cached(key, lambda: Scorer(shared.value))
        found = []
        for at in range(0, len(column), TEXTS):
            found += scorer.best(list(texts(column.slice(at, TEXTS))))
        return pa.array([{"lang_pred": a, "score": b} for a, b in found], _RESULT_ARROW)

    return F.arrow_udf(run, RESULT)(text)
