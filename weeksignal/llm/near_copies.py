"""Near-copies by chosen-path set similarity join.

A document is the set of its word shingles. In each tree a document goes down from the root
by minwise tokens: at a node it takes the one or two tokens of its set with the smallest
value under that level's hash, and a child for each. Similar sets take the same tokens with
high probability, others hardly ever. Trees are independent; ``TREES`` of them leave a pair
at the threshold out with a probability below one in a million.

In a node all documents are first compared with two of them, the smallest and the largest id. The
links found this way in all nodes give components, and in each small node only documents outside the
node's largest component are then compared, with all documents of other components there. So a group of
near-copies costs its length and not its square.

Texts of one pattern that resemble each other a little less than the threshold would still be
candidates in all their pairs. So a node of more than ``CROWD`` documents is compared within one
task, which gets the token numbers of its documents: each outsider is intersected with all others
at once, and only pairs that reach the threshold leave the task. Nodes of too many pairs are
branched on first, so a task's node has a size bound. Crowds of one leader that hold nearly the same
documents, as those of a group of near-copies do in all trees, are compared as one.

Equal sets are one vertex from the start. Pairs must first agree in size and in a 128-bit
sketch (a pair at the threshold fails that with a probability of about 10 ** -8), then links
are confirmed on the full sets of words. Components are found by spreading the smallest vertex
along the links with pointer jumping. Nothing is collected on the driver.

Defined cases: a null or empty text has no shingle and is linked with nothing; a text with
fewer words than a shingle has its word sequence as the only shingle; rows with one id and
different texts are judged by their own text each; a null id has a null component and is kept;
an empty table gives an empty result; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from weeksignal.session import cut_lineage

TREES, DEPTH, MAX_DEPTH = 28, 5, 12
#: A node is branched on if more comparisons than this would be left in it.
NODE_PAIRS = 1 << 20
#: A node of more documents is compared within a task, if their tokens (4 bytes each) are no more than this.
CROWD, CROWD_TOKENS = 16, 16_000_000
#: Crowds of one leader are put together where a document is in so many of them on the average.
BUNDLE = 4
#: Of 128 bits, so many may differ; at the threshold of 0.8 the mean is 13.
MOST_DIFFERENT = 34
#: Rows that are Python objects at a time, and tokens that get their place at a time (8 MB).
ROWS, PLACES = 64, 1 << 20
#: Up to so many ids are broadcast (8 bytes each), more are joined by a shuffle.
BROADCAST_IDS = 4_000_000

_SIGNS = "doc_id long, version long, n_shingles long, digest binary, s1 long, s2 long, keys array<long>"
_ROW = "node long, tree int, id long, n long, s1 long, s2 long"
_SIGNS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("version", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("s1", pa.int64()), ("s2", pa.int64()),
    ("keys", pa.list_(pa.int64())),
])
_ROW_ARROW = pa.schema([
    ("node", pa.int64()), ("tree", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
])

#: One odd factor for each level and tree: the level's hash of a token, itself a well mixed number.
_FACTORS = np.random.default_rng(20240229).integers(0, 2**63, (MAX_DEPTH, TREES), np.uint64) * np.uint64(2) + np.uint64(1)
_ROOT = np.random.default_rng(7).integers(0, 2**63, TREES, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return text.lower().split()


def tokens(words: list[bytes], width: int) -> np.ndarray:
    """A number for each distinct shingle."""
    if not words:
        return np.empty(0, np.uint64)
    numbers = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    value = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        value = _mix(value * _STEP + numbers[k : len(words) - span + 1 + k])
    return np.unique(_mix(value))


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    span = min(width, len(words))
    return set(zip(*(words[k:] for k in range(span)), strict=False)) if words else set()


def _least(values: np.ndarray, factors: np.ndarray, two: bool) -> np.ndarray:
    """Per factor the smallest (two) of the hashed tokens; a lone token stands twice."""
    best = None
    for at in range(0, len(values), 8192):
        hashed = factors[:, None] * values[None, at : at + 8192]
        if two:
            part = np.partition(hashed, min(1, hashed.shape[1] - 1), axis=1)[:, :2]
            part = np.repeat(part, 2, axis=1) if part.shape[1] == 1 else part
            if best is not None:
                merged = np.sort(np.concatenate((best, part), axis=1), axis=1)
                lone = merged[:, 0] == merged[:, 1]  # a chunk of one token
                merged[lone, 1] = merged[lone, 2]
                part = merged[:, :2]
        else:
            part = hashed.min(axis=1)
            if best is not None:
                part = np.minimum(best, part)
        best = part
    return best


def paths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers at ``DEPTH``, two for each tree, and the bits of the sketch."""
    first = _least(values, _FACTORS[0], True)
    rest = _least(values, _FACTORS[1:DEPTH].reshape(-1), False).reshape(DEPTH - 1, TREES)
    keys = _mix(_ROOT[:, None] ^ first)
    for level in rest:
        keys = _mix(keys * _STEP + level[:, None])
    least = np.concatenate((first[:, 0], rest.reshape(-1)))[:128]
    return keys.reshape(-1), (least >> np.uint64(20)) & np.uint64(1)


def children(values: np.ndarray, nodes: np.ndarray, trees: np.ndarray, depth: int) -> np.ndarray:
    """The two nodes below each node."""
    chosen = _least(values, _FACTORS[depth], True)[trees]
    return _mix(nodes.astype(np.uint64)[:, None] * _STEP + chosen)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = []
                part = batch.slice(at, 1000)
                for doc_id, version, text in zip(part.column(0), part.column(1), part.column(2).cast(pa.large_binary()), strict=True):
                    values = tokens(words_of(text.as_py() or b""), width)
                    if len(values):
                        keys, bits = paths(values)
                        digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                        s1, s2 = (int(np.int64(np.sum(bits[k : k + 64] * weights, dtype=np.uint64).astype(np.int64))) for k in (0, 64))
                        rows.append((doc_id.as_py(), version.as_py(), len(values), digest, s1, s2, keys.astype(np.int64)))
                    else:
                        rows.append((doc_id.as_py(), version.as_py(), 0, None, 0, 0, None))
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SIGNS_ARROW, strict=True)], _SIGNS_ARROW)
        _HASHES.clear()

    return run


def _branch(width: int, depth: int):
    """Rows id, text, n, s1, s2, nodes, trees to the rows of their children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for at in range(0, len(batch), ROWS) for row in batch.slice(at, ROWS).to_pylist()):
            values = tokens(words_of(row["text"].encode()), width)
            trees = np.array([p["tree"] for p in row["places"]])
            below = children(values, np.array([p["node"] for p in row["places"]], np.int64), trees, depth)
            nodes, at = np.unique(below.reshape(-1).astype(np.int64), return_index=True)
            k = len(nodes)
            same = [pa.array([row[c]] * k, pa.int64()) for c in ("id", "n", "s1", "s2")]
            yield pa.record_batch([pa.array(nodes), pa.array(np.repeat(trees, 2)[at].astype(np.int32)), *same], _ROW_ARROW)
        _HASHES.clear()

    return run


def _tokens(width: int):
    """Rows id, text to id and the sorted halves of token numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                values = np.unique(tokens(words_of(batch.column(1)[row].as_py().encode()), width).astype(np.uint32).view(np.int32))
                yield pa.record_batch([pa.array([batch.column(0)[row].as_py()], pa.int64()), pa.array([values], pa.list_(pa.int32()))], ["id", "tokens"])
        _HASHES.clear()

    return run


def numbered(values: np.ndarray) -> tuple[int, np.ndarray]:
    """How many values differ, and each value's place among them; sorted by parts, as a crowd's tokens are many."""
    among, place = np.unique(values), np.empty(len(values), np.int32)
    for at in range(0, len(values), PLACES):
        place[at : at + PLACES] = np.searchsorted(among, values[at : at + PLACES])
    return len(among), place


def _crowd(least: int, of: int):
    """A node (id, n, part, above, tokens) to its pairs of different parts that reach the threshold.

    Halves of token numbers may agree by chance, which makes an intersection larger and never smaller.
    """

    def run(node: pa.Table) -> pa.Table:
        ids, n = node["id"].to_numpy(), node["n"].to_numpy()
        part, apart = node["part"].to_numpy(), node["part"].to_numpy() != node["above"].to_numpy()
        lists = node["tokens"].combine_chunks()
        ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
        size, flat = numbered(lists.flatten().to_numpy())
        starts, mark = np.concatenate(([0], ends[:-1])), np.zeros(size, np.int32)
        first, second = [], []
        for x in np.flatnonzero(apart):
            own = flat[starts[x] : ends[x]]
            mark[own] = 1
            both = np.add.reduceat(mark[flat], starts)
            mark[own] = 0
            near = np.flatnonzero((of * both >= least * (n[x] + n - both)) & (part != part[x]))
            first.append(np.full(len(near), ids[x]))
            second.append(ids[near])
        a, b = np.concatenate(first), np.concatenate(second)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _confirm(width: int, least: int, of: int):
    """Rows a, b with their texts to those with of * intersection >= least * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for batch in batches:
            found = []
            for row in range(len(batch)):
                a, b = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                if a != last:
                    last, left = a, shingles(words_of(batch.column(2)[row].as_py().encode()), width)
                right = shingles(words_of(batch.column(3)[row].as_py().encode()), width)
                both = len(left & right)
                if of * both >= least * (len(left) + len(right) - both):
                    found.append((a, b))
            yield pa.record_batch([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _fits(x: str, y: str, least: int, of: int) -> Column:
    """Two rows may be linked, as far as sizes and sketches tell."""
    low, high = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    differ = [F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in ("s1", "s2")]
    return (of * low >= least * high) & (differ[0] + differ[1] <= MOST_DIFFERENT)


def _parts(rows: DataFrame, key: str) -> DataFrame:
    """By ``key`` rows, tokens, the part of most rows (``above``) and the comparisons that documents of other parts need."""
    parts = rows.groupBy(key, "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    total, most = F.sum("rows"), F.max("rows")
    return parts.groupBy(key).agg(
        total.alias("c"), F.max_by("part", F.struct("rows", "part")).alias("above"), ((total - most) * total).alias("left"), F.sum("n").alias("tokens")
    )


def _bundled(crowd: DataFrame) -> DataFrame:
    """Rows of crowds, those of one leader put together where they hold the same documents over and over.

    The nodes of a group of near-copies have one leader and nearly the same documents in every tree.
    As one bundle each document is there once, and all pairs of the nodes are still compared.
    """
    members = crowd.groupBy("leader", "id").agg(F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("part").alias("part"))
    times = members.groupBy("leader").agg(F.sum("times").alias("times"))
    fits = (F.col("times") >= BUNDLE * F.col("c")) & (F.col("left") <= NODE_PAIRS) & (F.col("tokens") <= CROWD_TOKENS)
    leaders = _parts(members, "leader").join(times, "leader").where(fits).select("leader", "above")
    rest = ["id", "n", "part", "above"]
    bundles = members.join(leaders, "leader").select(F.lit(True).alias("bundle"), F.col("leader").alias("node"), *rest)
    return bundles.unionByName(crowd.join(leaders, "leader", "left_anti").select(F.lit(False).alias("bundle"), "node", *rest))


class _Join:
    """One similarity join: its texts, its sets (id, doc_id, version, n, s1, s2) and its rule."""

    def __init__(self, docs: DataFrame, sets: DataFrame, width: int, least: int, of: int):
        self.docs, self.sets, self.width, self.least, self.of = docs, sets, width, least, of

    def texts(self, ids: DataFrame) -> DataFrame:
        """One text for each id of a one-column table."""
        wanted = cut_lineage(self.sets.select("id", "doc_id", "version").join(ids, "id", "left_semi"), "near-wanted")
        few = wanted.count() <= BROADCAST_IDS
        found = self.docs.join(F.broadcast(wanted) if few else wanted, ["doc_id", "version"])
        return cut_lineage(found.groupBy("id").agg(F.max("text").alias("text")), "near-texts")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs a, b that are linked."""
        pairs = cut_lineage(pairs.distinct(), "near-pairs")
        texts = self.texts(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        return cut_lineage(both.mapInArrow(_confirm(self.width, self.least, self.of), "a long, b long"), "near-links")

    def descend(self, rows: DataFrame, depth: int, labels: DataFrame | None = None) -> DataFrame:
        """id and component of all that is linked, known before or by pairs that meet in these nodes or below."""
        nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("leader"), F.max("id").alias("second")).where("c > 1")
        met = cut_lineage(rows.join(cut_lineage(nodes, "near-nodes"), "node"), "near-rows")

        facts = self.sets.select("id", "n", "s1", "s2")
        star = met.select(F.explode(F.array("leader", "second")).alias("leader"), "id").where("id <> leader").distinct()
        star = star.join(facts, "id").alias("x").join(facts.withColumnRenamed("id", "other").alias("y"), F.col("leader") == F.col("other"))
        star = star.where(_fits("x", "y", self.least, self.of)).select(F.col("leader").alias("a"), F.col("x.id").alias("b"))
        labels = components(self.confirm(star)) if labels is None else joined(labels, self.confirm(star))
        marked = met.join(labels, "id", "left").select("node", "leader", "tree", "id", "n", "s1", "s2", F.coalesce("component", "id").alias("part"))
        marked = cut_lineage(marked, "near-marked")
        apart = F.col("part") != F.col("above")
        counts = _parts(marked, "node")
        ends = depth >= MAX_DEPTH
        kind = F.when(F.lit(not ends) & (F.col("left") > NODE_PAIRS), "below")
        kind = kind.when((F.col("c") > CROWD) & (F.col("left") <= NODE_PAIRS) & (F.col("tokens") <= CROWD_TOKENS), "crowd").otherwise("few")
        kept = marked.join(counts.where("left > 0").select("node", "above", kind.alias("kind")), "node")
        kept = cut_lineage(kept, "near-kept")  # each row of a node that has pairs left, once
        of_kind = lambda name: kept.where(F.col("kind") == name)

        here = of_kind("few")
        x, y = here.where(apart).alias("x"), here.alias("y")
        across = (F.col("x.node") == F.col("y.node")) & (F.col("x.part") != F.col("y.part")) & _fits("x", "y", self.least, self.of)
        pairs = x.join(y, across).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        crowd = cut_lineage(_bundled(of_kind("crowd")), "near-crowd")
        numbers = self.texts(crowd.select("id")).mapInArrow(_tokens(self.width), "id long, tokens array<int>")
        rows = crowd.join(cut_lineage(numbers, "near-tokens"), "id")
        within = rows.groupBy("bundle", "node").applyInArrow(_crowd(self.least, self.of), "a long, b long")
        labels = joined(labels, self.confirm(pairs.unionByName(within)))
        later = of_kind("below")
        if ends or later.isEmpty():
            return labels
        places = later.groupBy("id", "n", "s1", "s2").agg(F.collect_set(F.struct("node", "tree")).alias("places"))
        texts = self.texts(places.select("id"))
        below = texts.join(places, "id").select("id", "text", "n", "s1", "s2", "places")
        below = cut_lineage(below.mapInArrow(_branch(self.width, depth), _ROW), "near-below")
        return self.descend(below, depth + 1, labels)


def components(links: DataFrame) -> DataFrame:
    """id and component, the smallest id reachable, for every id that has a link."""
    return _spread(_edges(links))


def _edges(links: DataFrame) -> DataFrame:
    """Each link once in both directions."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return cut_lineage(links.select(F.explode(ends).alias("e")).select("e.*").distinct(), "near-edges")


def _spread(both: DataFrame) -> DataFrame:
    """The components of links that stand in both directions."""
    labels = cut_lineage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("c")).withColumnRenamed("a", "id"), "near-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("c").alias("m"))
        spread = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        spread = cut_lineage(spread, "near-spread")
        jump = spread.select(F.col("id").alias("to"), F.col("c").alias("further"))
        jumped = spread.join(jump, F.col("c") == F.col("to")).select("id", "old", F.least("c", "further").alias("c"))
        jumped = cut_lineage(jumped, "near-labels")
        labels = jumped.select("id", "c")
        if jumped.where("c <> old").isEmpty():
            return labels.withColumnRenamed("c", "component")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, component) after further links; only links between components go through the rounds."""
    of = lambda end: labels.select(F.col("id").alias(end), F.col("component").alias(f"{end}_part"))
    moved = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moved = moved.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b")).where("a <> b")
    edges = _edges(moved)
    if edges.isEmpty():
        return labels
    more = _spread(edges)
    single = more.select("id", F.col("id").alias("component")).join(labels.select("id"), "id", "left_anti")
    above = more.select(F.col("id").alias("component"), F.col("component").alias("top"))
    found = labels.unionByName(single).join(above, "component", "left")
    return cut_lineage(found.select("id", F.coalesce("top", "component").alias("component")), "near-labels")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 2, least: int = 80, of: int = 100
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row for each row of the input.

    Sets are linked if ``of`` * intersection >= ``least`` * union. The trees are laid out for
    thresholds of 0.8 and more.
    """
    judged = _judged(docs, id_col, text, width, least, of)
    out = judged.select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _judged(docs: DataFrame, id_col: str, text: str, width: int = 2, least: int = 80, of: int = 100) -> DataFrame:
    """doc_id, version (a hash of the text), n_shingles and component_id of each row."""
    if 10 * least < 8 * of:
        raise ValueError("the number of trees is laid out for a similarity of 0.8 or more")
    doc_id, content = docs[f"`{id_col}`"].cast("long"), docs[f"`{text}`"]
    slim = docs.select(doc_id.alias("doc_id"), F.xxhash64(content).alias("version"), content.alias("text"))
    signs = cut_lineage(slim.mapInArrow(_sign(width), _SIGNS), "near-signs")
    one = ["s1", "s2", "keys"]
    sets = signs.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "version")).alias("row"), F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in one]
    )
    # the numbers of the sets are written with them, so they stay
    sets = cut_lineage(sets.select(F.monotonically_increasing_id().alias("id"), "digest", "row.*", "n", *one), "near-sets")
    rows = sets.select(F.posexplode("keys").alias("place", "node"), "id", "n", "s1", "s2")
    rows = rows.select("node", (F.col("place") / 2).cast("int").alias("tree"), "id", "n", "s1", "s2")
    labels = _Join(slim, sets, width, least, of).descend(rows, DEPTH)
    named = sets.select("digest", "id", F.col("doc_id").alias("own")).join(labels, "id", "left")
    named = cut_lineage(named.select("digest", "own", F.coalesce("component", "id").alias("part")), "near-named")
    smallest = named.groupBy("part").agg(F.min("own").alias("component_id"))
    out = signs.join(named.join(smallest, "part").select("digest", "component_id"), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "version", "n_shingles", component.alias("component_id"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """One document of each component, with the columns it came with; rows without an id stay.

    A row goes by its id and text, so another text under the same id is judged on its own.
    """
    judged = _judged(docs, id_col, text, **rule).where("doc_id <> component_id")
    gone = cut_lineage(judged.select(F.col("doc_id").alias("_gone_id"), F.col("version").alias("_gone_version")).distinct(), "near-gone")
    few = gone.count() <= BROADCAST_IDS
    same = (docs[f"`{id_col}`"].cast("long") == gone["_gone_id"]) & (F.xxhash64(docs[f"`{text}`"]) == gone["_gone_version"])
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
