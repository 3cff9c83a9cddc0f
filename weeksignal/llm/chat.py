"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole and encoded once with offsets. Turns are marked by the
vocabulary's end-of-text string, an added token that the tokenizer splits off before anything
else, so no token crosses the border of a turn. Texts and roles are escaped: a backslash is
doubled and ``<|`` becomes ``<\\|``, so no control string can stand in them and all is
reversible. The spans of the assistant's turns, sorted, are met with the sorted token spans by
binary search; the mask is a list of token runs.

Defined cases: a null text or role counts as empty; rows with one turn number are ordered by
role and text; a null conversation id is a conversation of its own; an empty assistant text
has no token under the mask; repeated rows are repeated turns; an empty table gives an empty
result; further columns are ignored. A conversation is one string by nature, so its rows meet
in one task; nothing else does.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from weeksignal.llm.rows import cached

MARK = "<|endoftext|>"
TRAINED = "assistant"

FORMATTED = (
    "struct<formatted: string, ids: array<int>, loss_tokens: array<struct<first: int, end: int>>, "
    "loss_spans: array<struct<start: long, end: long>>>"
)
_FORMATTED_ARROW = pa.struct([
    ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
    ("loss_tokens", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
    ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
DIGESTS = (
    "struct<n_turns: long, turns_sha256: string, loss_chars: long, loss_sha256: string, formatted_chars: long>"
)
_DIGESTS_ARROW = pa.struct([
    ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
])


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to be learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{MARK}{escape(role)}{MARK}", escape(text)
        if role == TRAINED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body]
        at += len(head) + len(body)
    return "".join(parts) + MARK, spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts, read back."""
    parts = formatted.split(MARK)[1:-1]
    return [(unescape(a), unescape(b)) for a, b in zip(parts[::2], parts[1::2], strict=True)]


def masked(spans: list[tuple[int, int]], offsets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of tokens (end exclusive) that meet the spans; both are sorted."""
    starts, ends = np.array(offsets, np.int64).reshape(-1, 2).T
    wanted = np.array(spans, np.int64).reshape(-1, 2)
    first, end = np.searchsorted(ends, wanted[:, 0], "right"), np.searchsorted(starts, wanted[:, 1], "left")
    return list(zip(first.tolist(), end.tolist(), strict=True))


def format_one(turns: list[tuple[str, str]], tokenizer: Tokenizer) -> dict:
    formatted, spans = render(turns)
    encoded = tokenizer.encode(formatted, add_special_tokens=False)
    offsets = encoded.offsets
    runs = masked(spans, offsets)
    return {
        "formatted": formatted, "ids": encoded.ids,
        "loss_tokens": [{"first": a, "end": b} for a, b in runs],
        "loss_spans": [{"start": offsets[a][0], "end": offsets[b - 1][1]} for a, b in runs],
    }


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and its turns in order."""
    slim = rows.select(
        rows[f"`{conv}`"].alias("conv_id"), rows[f"`{turn}`"].alias("turn"),
        F.coalesce(rows[f"`{role}`"], F.lit("")).alias("role"), F.coalesce(rows[f"`{text}`"], F.lit("")).alias("text"),
    )
    return slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def formatted(turns: Column, tokenizer_path: str, spark) -> Column:
    """A column of ``FORMATTED`` for a column of turns."""
    shared, key = spark.sparkContext.broadcast(Path(tokenizer_path).read_text()), uuid.uuid4().hex

    def run(column: pa.Array) -> pa.Array:
        tokenizer = cached(key, lambda: Tokenizer.from_str(shared.value))
        out = [format_one([(t["role"], t["text"]) for t in row.as_py()], tokenizer) for row in column]
        return pa.array(out, _FORMATTED_ARROW)

    return F.arrow_udf(run, FORMATTED)(turns)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _read_back(column: pa.Array) -> pa.Array:
    out = []
    for row in column:
        value = row.as_py()
        whole = value["formatted"]
        turns = parse(whole)
        loss = "".join(unescape(whole[s["start"] : s["end"]]) for s in value["loss_spans"])
        out.append({
            "n_turns": len(turns), "turns_sha256": _sha("".join(f"{role}\n{text}\n" for role, text in turns)),
            "loss_chars": len(loss), "loss_sha256": _sha(loss), "formatted_chars": len(whole),
        })
    return pa.array(out, _DIGESTS_ARROW)


def read_back(output: Column) -> Column:
    """A column of ``DIGESTS``, taken from the formatted conversations alone."""
    return F.arrow_udf(_read_back, DIGESTS)(output)
