"""Packing: ids by the tokenizer, every id once, no padding, balanced step groups."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from weeksignal.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(2)
    encoder = packing.Encoder(open(RANKS, "rb").read())
    texts = ["", " ", "a  b\n\n c\t", "x<|endoftext|>y <|endoftext|>", "日本語 テスト", "I'll don't 'S", "\x1c \x85 \xa0"]
    texts += ["".join(rng.choice("ab é\n\t1.'!s<|>  ") for _ in range(60)) for _ in range(500)]
    for text in texts:
        assert encoder.encode(text) == TOKENIZER.encode(text, add_special_tokens=False).ids, text


def test_long_runs_are_encoded_whole():
    encoder = packing.Encoder(open(RANKS, "rb").read())
    for text in [" " * 1_000_000 + "word", "\n" * 1_000_000, "a" + " \n" * 4000 + "<|endoftext|>" + "\t" * 9000 + "é", "a" * 300_000, "!" * 300_000, " " * 4095 + "b"]:
        assert encoder.encode(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def check(rows, texts):
    ids = {k: TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts}
    pieces, sequences = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["context"]))
    for k, _ in texts:
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at
            at += length
        assert at == len(ids[k])
    for parts in sequences.values():
        at = 0
        for offset, length, context in sorted(parts):
            assert offset == at
            at += length
        assert at == context <= 1024 and context & (context - 1) == 0


def test_every_id_once_and_no_padding(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "word " * 9000)]
    df = spark.createDataFrame([(*t, 5) for t in texts], "doc_id long, text string, start int").repartition(3)
    rows = packing.pack(df, RANKS).collect()
    check(rows, texts)
    assert len(rows) < 3 * len(texts)


def test_blocks_and_groups(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 4000)
    monkeypatch.setattr(packing, "STEP_TOKENS", 2048)
    rng, packer, out, total = random.Random(1), packing.Packer(7 << 32), [], 0
    for k in range(300):
        size = rng.choice([1, 3, 60, 200, 600, 1023, 1024, 1025, 3000])
        packer.add(k, np.arange(size, dtype="<u4"))
        total += size
        if packer.held >= packing.BLOCK_TOKENS:
            packer.pack()
            out.append(packer.take().to_pandas())
    packer.pack()
    packer.finish()
    out.append(packer.take().to_pandas())
    assert sum(len(f) for f in out) and sum(f.length.sum() for f in out) == total
    for f in out[:-1]:
        loads = f.groupby("step_group").length.sum()
        assert loads.max() - loads.min() <= 1024


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string")
    assert packing.pack(df.limit(0), RANKS).count() == 0
    assert packing.pack(df.coalesce(1), RANKS).count() >= 3
