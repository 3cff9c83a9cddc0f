"""Hierarchical packing into several context sizes.

Documents become token ids (their text's ids and one end id) and are routed to tiers by
length: each full longest window is a sequence of its own, the rest goes to the shortest
context that holds it. Tiers are packed from the longest down. A window starts with the
longest piece of its tier; its gap is filled with whole pieces of shorter tiers, the longest
that fits first, and closed by cutting one piece, whose remainder is routed anew. So windows
are full, and most documents stay in one piece. Sequences are dealt to step groups of near
equal numbers of tokens.

Each partition of the input packs its own documents in blocks of bounded size, so nothing is
shuffled and a sequence never waits for another partition; a partition's last tokens, fewer
than one window, form sequences of powers of two and need no padding either.

Defined cases: a null text counts as empty, an empty one has the end id only; a document
of any length is cut at will; rows equal in everything are packed one by one; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
import uuid
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weeksignal.llm.rows import cached

END_ID = 0
CONTEXTS = (128, 256, 512, 1024)
#: Rests of documents that are packed together, in tokens.
BLOCK_TOKENS = 1 << 20
#: Tokens of a step group; a block's sequences are dealt to as many groups as this gives.
STEP_TOKENS = 1 << 16

_SPECIAL = "<|endoftext|>"
_SPECIAL_ID = 50256
#: The splitting rule that belongs to this vocabulary (a fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as that rule means it.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")

RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context int, step_group long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("context", pa.int32()),
    ("step_group", pa.int64()),
])


class Encoder:
    """Ids of whole texts, the same as the vocabulary's own tokenizer gives."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """The special string is its own id, as in the tokenizer's plain use."""
        first, *others = text.split(_SPECIAL)
        ids = self._ordinary(first)
        for part in others:
            ids.append(_SPECIAL_ID)
            ids += self._ordinary(part)
        return ids

    def _ordinary(self, text: str) -> list[int]:
        """A long run of white space is one piece by the splitting rule, without its last character if
        something follows; it goes past the rule, whose search is too deep for such runs."""
        ids, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.plain.encode_ordinary(text[at : run.start()])
            ids += self.plain._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self.plain.encode_ordinary(text[at:])


class Piece:
    """Ids ``start`` to ``start + len(ids)`` of a document."""

    __slots__ = ("doc_id", "ids", "start", "total")

    def __init__(self, doc_id, start: int, ids: np.ndarray, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:length], self.total),
            Piece(self.doc_id, self.start + length, self.ids[length:], self.total),
        )


class Packer:
    """Packs the documents of one partition, block by block."""

    def __init__(self, first_id: int, contexts: tuple[int, ...] = CONTEXTS):
        self.contexts, self.next_id, self.next_group = contexts, first_id, first_id
        self.rests: list[tuple[int, int, Piece]] = []  # by length, then by arrival
        self.arrived = self.held = 0
        self.sequences: list[tuple[int, list[Piece]]] = []  # context and content

    def _route(self, piece: Piece) -> None:
        self.arrived += 1
        insort(self.rests, (len(piece.ids), self.arrived, piece), key=lambda rest: rest[:2])

    def add(self, doc_id, ids: np.ndarray) -> None:
        longest = self.contexts[-1]
        piece = Piece(doc_id, 0, ids, len(ids))
        while len(piece.ids) >= longest:
            window, piece = piece.cut(longest)
            self.sequences.append((longest, [window]))
        if len(piece.ids):
            self._route(piece)
        self.held += len(ids)

    def _fill(self, context: int, gap: int, window: list[Piece]) -> int:
        """Close the gap: the longest rest that fits, again and again, at last a cut one."""
        while gap and self.rests:
            place = bisect_right(self.rests, gap, key=lambda rest: rest[0])
            piece = self.rests.pop(max(0, place - 1))[2]
            if not place:
                piece, rest = piece.cut(gap)
                self._route(rest)
            window.append(piece)
            gap -= len(piece.ids)
        return gap

    def pack(self) -> None:
        """Windows from the longest tier down; an unfinished one goes back to the rests."""
        while self.rests:
            piece = self.rests.pop()[2]
            context = next(c for c in self.contexts if c >= len(piece.ids))
            window = [piece]
            if self._fill(context, context - len(piece.ids), window):
                for piece in window:
                    self._route(piece)
                return
            self.sequences.append((context, window))

    def finish(self) -> None:
        """The last rests, fewer tokens than a window, as sequences of powers of two."""
        left = sum(rest[0] for rest in self.rests)
        for power in reversed(range(left.bit_length())):
            if left >> power & 1:
                window: list[Piece] = []
                self._fill(1 << power, 1 << power, window)
                self.sequences.append((1 << power, window))

    def take(self) -> pa.RecordBatch:
        """The finished sequences as rows, dealt to step groups: the longest first, each to the emptiest group."""
        sequences, self.sequences, self.held = sorted(self.sequences, key=lambda s: -s[0]), [], 0
        groups = max(1, round(sum(s[0] for s in sequences) / STEP_TOKENS))
        loads = [(0, g) for g in range(groups)]
        rows = []
        for context, window in sequences:
            load, group = heapq.heappop(loads)
            heapq.heappush(loads, (load + context, group))
            offset = 0
            for p in window:
                crc = zlib.crc32(p.ids)
                rows.append((p.doc_id, p.start, len(p.ids), crc, p.total, self.next_id, offset, context, self.next_group + group))
                offset += len(p.ids)
            self.next_id += 1
        self.next_group += groups
        columns = list(zip(*rows, strict=True)) or [[] for _ in _ARROW]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], _ARROW)


def pack(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text: str = "text", contexts: tuple[int, ...] = CONTEXTS) -> DataFrame:
    """A row per piece, ``RESULT``; ``contexts`` are powers of two, shortest first."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached(key, lambda: Encoder(shared.value))
        packer = Packer(TaskContext.get().partitionId() << 32, contexts)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "")
                ids.append(END_ID)
                packer.add(doc_id.as_py(), np.array(ids, "<u4"))
                if packer.held >= BLOCK_TOKENS:
                    packer.pack()
                    yield packer.take()
        packer.pack()
        packer.finish()
        yield packer.take()

    columns = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    return columns.mapInArrow(run, RESULT)
