"""The prefix trie against rebuilding conversations and walking a dictionary."""

import hashlib
import random
import zlib

import pytest

from weeksignal.llm import prefix_trie as T


def plain(rows, head):
    talks = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            talks.setdefault(conv_id, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in talks.items()}
    first = lambda c: c - (c % 5 if c >= 0 else -(-c % 5))
    built = {c: tuple(own.get(first(c), [])[: head(c)] + t[head(c) :]) for c, t in own.items()}
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(m) == len(node) + 1 for m in below),
            sum(not any(len(o) == len(m) + 1 and o[:-1] == m for o in below) for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, prefix string")


def run(spark, rows, head):
    df = T.prefix_trie(frame(spark, rows), head)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "prefix"]
    found = df.collect()
    assert len({r["prefix"] for r in found}) == len(found)
    return sorted((tuple(r)[:8] for r in found), key=repr)


def talks(seed, ids, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in ids:
        for k in range(rng.randrange(longest + 1)):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi", "é", "longer text"])))
    rng.shuffle(rows)
    return rows


HEADS = [T.head_of, lambda c: 0, lambda c: 8, lambda c: abs(c) % 3]


@pytest.mark.parametrize("head", HEADS)
def test_equals_a_plain_trie(spark, head):
    rows = talks(3, range(-12, 60))
    assert run(spark, rows, head) == plain(rows, head)


def test_frequent_conversation_and_first_turn(spark):
    rows = [(c, k, "user", f"same {k}") for c in range(80) for k in range(3)] + [(c, k, "user", "same 0" if k == 0 else f"own {c} {k}") for c in range(80, 140) for k in range(4)]
    assert run(spark, rows, lambda c: 0) == plain(rows, lambda c: 0)


def test_nulls_ties_repeats_and_a_long_conversation(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "b"),
            (None, 0, "user", "lost"), (3, 5, "user", ""), (3, 6, None, ""), (10, 0, "user", "x" * 200_000), (11, 0, "user", "x" * 200_000)]
    rows += [(20, k, "user", f"t{k % 3}") for k in range(300)] + [(21, k, "user", f"t{k % 3}") for k in range(299)]
    for head in HEADS[1:]:
        assert run(spark, rows, head) == plain(rows, head)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(6, 0, "user", "gone"), (7, 0, "user", "gone too")]
    found = run(spark, rows, lambda c: 8)
    assert found == [(6, 0, None, 2, 0, 1, 0, hashlib.sha256(b"6,7").hexdigest())] == plain(rows, lambda c: 8)


def test_empty_table_has_no_node(spark):
    assert T.prefix_trie(frame(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0


def test_head_follows_the_checksum():
    assert [T.head_of(c) for c in (0, 12, -7)] == [zlib.crc32(str(c).encode()) % 9 for c in (0, 12, -7)]
