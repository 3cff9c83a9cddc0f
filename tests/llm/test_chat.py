"""Chat formatting: exact round trips, masks by comparing all tokens and spans."""

import hashlib
import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weeksignal.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
PARTS = ["\\", "<|", "<|endoftext|>", "|>", "<", "a", " ", "\n", "é", "日本", "</turn>", "### Assistant:", "'s", "  ", "."]


def test_round_trip_and_mask():
    rng = random.Random(4)
    for _ in range(400):
        text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(9)))
        turns = [(rng.choice(["user", "assistant", "assistant", "sys<|tem"]), text()) for _ in range(rng.randrange(1, 6))]
        out = chat.format_one(turns, TOKENIZER)
        assert chat.parse(out["formatted"]) == turns
        loss = "".join(chat.unescape(out["formatted"][s["start"] : s["end"]]) for s in out["loss_spans"])
        assert loss == "".join(t for role, t in turns if role == "assistant")
        offsets = TOKENIZER.encode(out["formatted"], add_special_tokens=False).offsets
        spans = chat.render(turns)[1]
        meets = {k for k, (a, b) in enumerate(offsets) if any(a < end and b > start for start, end in spans)}
        assert meets == {k for run in out["loss_tokens"] for k in range(run["first"], run["end"])}


def test_order_nulls_ties_and_clashing_columns(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", None, 0), (2, 0, None, "x", 0), (1, 1, "assistant", "a", 0), (None, 0, "assistant", "n", 0), (1, 1, "assistant", "a", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    done = chat.conversations(df).select("conv_id", chat.formatted(F.col("turns"), PATH, spark).alias("f"))
    got = {r["conv_id"]: r["d"] for r in done.select("conv_id", chat.read_back(F.col("f")).alias("d")).collect()}
    assert got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 3
    assert got[1]["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\na\nassistant\na\nassistant\nb\n").hexdigest()
    assert got[None]["loss_chars"] == 1 and got[2]["loss_chars"] == 0
    assert chat.conversations(df.limit(0)).count() == 0
