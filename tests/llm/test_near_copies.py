"""Near-copies against comparing all pairs."""

import random
import tracemalloc

import numpy as np
import pytest

from weeksignal.llm import near_copies as N


def sets_of(text, width):
    words = (text or "").encode().lower().split()
    span = min(width, len(words))
    return {tuple(words[k : k + span]) for k in range(len(words) - span + 1)} if words else set()


def plain(rows, width=2):
    sets = {k: sets_of(t, width) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def corpus(seed):
    """Unrelated texts, copies, near-copies around the threshold and a chain of small edits."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    texts = [" ".join(word() for _ in range(rng.randrange(30, 60))) for _ in range(12)]
    out = list(texts)
    for text in texts[:8]:
        for _ in range(12):
            words = text.split()
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = word()
            out.append(" ".join(words))
    chain = texts[9].split()
    for k in range(0, len(chain), 2):
        chain[k] = word()
        out.append(" ".join(chain))
    out += [texts[0]] * 3 + [texts[0].upper(), None, "", " \n", "one", "One", "one two", "a a a a", "a a"]
    return list(enumerate(out, 100))


def run(spark, rows, **rule):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, n int")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_copies(df, **rule).collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_comparing_all_pairs(spark, width):
    rows = corpus(width)
    assert run(spark, rows, width=width) == plain(rows, width)


@pytest.mark.parametrize("deepest", [N.DEPTH + 1, N.DEPTH + 3])
def test_crowded_nodes_are_branched_on_and_ended_exactly(spark, monkeypatch, deepest):
    """With no comparison allowed beside the leader's, nodes are branched on and compared fully at the last depth."""
    monkeypatch.setattr(N, "MAX_DEPTH", deepest)
    monkeypatch.setattr(N, "NODE_PAIRS", 0)
    rows = corpus(11)
    assert run(spark, rows) == plain(rows)


def test_children_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    met = []
    for _ in range(300):
        a = rng.integers(0, 2**63, 90, np.uint64)
        b = np.concatenate((a[:80], rng.integers(0, 2**63, 10, np.uint64)))
        x, y = N.paths(np.unique(a))[0], N.paths(np.unique(b))[0]
        met.append(len(np.intersect1d(x, y)))
    assert min(met) > 0  # similarity 0.8 is met in some tree every time
    alone = N.paths(np.array([5], np.uint64))[0]
    assert len(np.unique(alone)) == N.TREES


def test_long_sets_are_cut_into_blocks():
    values = np.unique(np.random.default_rng(2).integers(0, 2**63, 20_000, np.uint64))
    two = N._least(values, N._FACTORS[0], True)
    want = np.sort(N._FACTORS[0][:, None] * values[None, :], axis=1)[:, :2]
    assert (two == want).all() and (N._least(values, N._FACTORS[0], False) == want[:, 0]).all()
    tail = values[: 8192 + 1]
    assert (N._least(tail, N._FACTORS[1], True) == np.sort(N._FACTORS[1][:, None] * tail[None, :], axis=1)[:, :2]).all()


def test_drop_copies_keeps_columns_and_one_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(5, text, 1), (3, text, 2), (4, text + " more", 3), (9, "other words here", 4), (None, text, 5), (None, None, 6), (9, "other words here", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    out = N.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["kept"]) for r in out.collect()) == [(-1, 5), (-1, 6), (3, 2), (9, 4), (9, 4)]
    assert N.near_copies(df.limit(0)).count() == 0 and N.drop_copies(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (100, 102)]
    found = N.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_components_take_in_further_links(spark):
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    labels = N.components(frame([(1, 2), (2, 3), (10, 11)], "a long, b long"))
    found = {r["id"]: r["component"] for r in N.joined(labels, frame([(3, 11), (20, 21), (1, 3)], "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 20: 20, 21: 20}
    assert N.joined(labels, frame([(1, 3)], "a long, b long")) is labels


def pattern(m, own, seed=3):
    """m texts of one pattern, each with ``own`` of its 200 words replaced: similarities a little below 0.8."""
    rng = random.Random(seed)
    base = [f"base{k}" for k in range(200)]
    out = []
    for _ in range(m):
        words = list(base)
        for k in rng.sample(range(200), own):
            words[k] = f"own{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return list(enumerate(out))


def candidates(spark, rows, monkeypatch):
    seen = []
    confirm = N._Join.confirm
    monkeypatch.setattr(N._Join, "confirm", lambda self, pairs: seen.append(pairs.distinct().count()) or confirm(self, pairs))
    found = run(spark, rows)
    monkeypatch.undo()
    return sum(seen), found


def test_candidates_of_a_pattern_grow_with_its_length(spark, monkeypatch):
    counts = []
    for m in (150, 600):
        n, found = candidates(spark, pattern(m, 9), monkeypatch)
        assert all(kept for _, _, kept in found.values())  # no pair is linked
        counts.append(n)
    assert counts[1] < 6 * counts[0] and counts[1] < 60 * 600


def test_links_within_a_crowd_are_found(spark, monkeypatch):
    """Some texts of a pattern have near-copies of their own; with a crowd of four they are compared within tasks."""
    monkeypatch.setattr(N, "CROWD", 4)
    rows = pattern(60, 7)
    rng = random.Random(8)
    for k in range(0, 60, 3):
        words = rows[k][1].split()
        for _ in range(6):
            words[rng.randrange(200)] = f"edit{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(words)))
    assert run(spark, rows) == plain(rows)


def test_rows_of_one_id_are_judged_by_their_text(spark):
    x, y = " ".join(f"x{k}" for k in range(40)), " ".join(f"y{k}" for k in range(40))
    df = spark.createDataFrame([(3, x), (5, x), (5, y), (5, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"] or "") for r in N.drop_copies(df).collect()) == [(3, x), (5, ""), (5, y)]
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in N.near_copies(df).collect())
    assert found == [(3, 3, True), (5, 3, False), (5, 5, True), (5, 5, True)]


def test_crowds_of_one_leader_are_put_together(spark, monkeypatch):
    """A group of near-copies is in nearly all nodes of its leader; each document goes to its tasks once and not once a node."""
    rng = random.Random(4)
    base = [f"base{k}" for k in range(150)]
    rows = []
    for k in range(80):
        words = list(base)
        for _ in range(rng.randrange(1, 20)):
            words[rng.randrange(150)] = f"own{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    sizes, cut = {}, N.cut_lineage

    def counted(df, name):
        out = cut(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(N, "cut_lineage", counted)
    assert run(spark, rows) == plain(rows)
    assert 0 < sizes["near-crowd"] < 15 * len(rows)


def test_crowds_number_their_tokens_in_little_memory():
    values = np.random.default_rng(3).integers(-(2**31), 2**31, 2_000_000).astype(np.int32)
    values[::3] = values[0]
    among, place = np.unique(values, return_inverse=True)
    tracemalloc.start()
    size, found = N.numbered(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size == len(among) and (found == place).all() and found.dtype == np.int32
    assert peak < 24 * len(values)
