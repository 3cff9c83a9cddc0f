"""A trie of conversation prefixes by whole-sequence collapse.

Conversations are rebuilt first: every conversation begins with turns of the first one of its
family of five and goes on with its own. A family is one stream of (digest, bytes) per turn,
ordered by turn, and a running digest names every prefix; texts never leave the scan.

Identical rebuilt conversations then collapse to one weighted sequence with the list of those that
end there. Only one conversation of each sequence is expanded to its prefixes. Sequences that are a
proper prefix of another one drop out by an anti-join, which leaves the leaves. Weighted prefixes
are aggregated to nodes, with partial sums before the shuffle, so the root and a frequent first
turn cost no more than others.

Sums over subtrees need no rounds: a node's text belongs to the sequence of the node's smallest
member, and what a sequence owns is the end of its path. So a subtree's members and its different
texts are both sums, over the sequences through the node, of the bytes from some depth on.

Work and memory: one conversation, and the list of those with one rebuilt sequence, is a stream
within a task, since its digest goes over the whole in order; both hold numbers only (64 bytes a
turn, 40 a conversation) and are sorted with spilling. The driver gets nothing.

Defined cases: null roles and texts are empty; a null turn comes first; turns with equal numbers
are ordered by the digest of role and text, and equal rows are repeated turns; rows with a null
conversation have no place to be rebuilt from and are left out; a conversation that is rebuilt to
no turn ends at the root; an empty table gives no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weeksignal.session import cut_lineage

FAMILY, LONGEST_HEAD = 5, 8
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
_BLOCK = 20_000

_STEP = "conv_id long, prefix binary, parent binary, depth long, before long, bytes long, ends boolean"
_STEP_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("prefix", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("before", pa.int64()),
    ("bytes", pa.int64()), ("ends", pa.bool_()),
])
_ENDS = "prefix binary, conv_id long, weight long, depth long, total long, ends_sha256 string"
_ENDS_ARROW = pa.schema([
    ("prefix", pa.binary()), ("conv_id", pa.int64()), ("weight", pa.int64()), ("depth", pa.int64()), ("total", pa.int64()),
    ("ends_sha256", pa.string()),
])


def head_of(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its family."""
    return zlib.crc32(str(conv_id).encode()) % (LONGEST_HEAD + 1)


def turns(rows: DataFrame) -> DataFrame:
    """family, conv_id, turn, digest and bytes of each turn."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    found = rows.select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"),
        F.unhex(F.sha2(named, 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv_id IS NOT NULL")
    return found.select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "*")


class _Path:
    """The prefixes of one conversation; a prefix is told when the next turn, or the end, is known."""

    def __init__(self, conv_id: int, out: list):
        self.conv_id, self.out = conv_id, out
        self.prefix, self.parent, self.depth, self.before, self.bytes = ROOT, None, 0, 0, 0

    def step(self, digest: bytes, size: int) -> None:
        self.out.append((self.conv_id, self.prefix, self.parent, self.depth, self.before, self.bytes, False))
        self.parent, self.prefix = self.prefix, hashlib.blake2b(self.prefix + digest, digest_size=16).digest()
        self.depth, self.before, self.bytes = self.depth + 1, self.before + self.bytes, size

    def end(self) -> None:
        self.out.append((self.conv_id, self.prefix, self.parent, self.depth, self.before, self.bytes, True))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema)


def rebuilt(head: Callable[[int], int]):
    """Rows family, conv_id, digest, bytes in order to the prefixes of rebuilt conversations.

    Of a family at most ``LONGEST_HEAD`` turns are kept, those its first conversation begins with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        family, shared = None, []
        path, own, heads = None, 0, 0
        waiting = False  # the family's first conversation waits for its head

        def start(conv_id: int) -> _Path:
            found = _Path(conv_id, out)
            for digest, size in shared[:heads]:
                found.step(digest, size)
            return found

        for batch in batches:
            for f, c, digest, size in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if f != family or path is None or path.conv_id != c:
                    if path is not None:
                        path.end()
                    if f != family:
                        family, shared = f, []
                    own, heads, waiting = 0, head(c), c == f
                    path = _Path(c, out) if waiting else start(c)
                if waiting:
                    if own < LONGEST_HEAD:
                        shared.append((digest, size))
                    path.step(digest, size)
                elif own >= heads:
                    path.step(digest, size)
                own += 1
                if len(out) >= _BLOCK:
                    yield _batch(out, _STEP_ARROW)
                    out.clear()
        if path is not None:
            path.end()
        if out:
            yield _batch(out, _STEP_ARROW)

    return run


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends in order of prefix and conversation to weighted sequences with the digest of their end list."""
    out: list = []
    now = digest = None

    def close() -> None:
        out.append((*now, digest.hexdigest()))

    for batch in batches:
        for prefix, conv_id, depth, total in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if now is None or now[0] != prefix:
                if now is not None:
                    close()
                now, digest = [prefix, conv_id, 1, depth, total], hashlib.sha256(str(conv_id).encode())
            else:
                now[2] += 1
                digest.update(b",%d" % conv_id)
            if len(out) >= _BLOCK:
                yield _batch(out, _ENDS_ARROW)
                out.clear()
    if now is not None:
        close()
        yield _batch(out, _ENDS_ARROW)


def sequences(steps: DataFrame) -> DataFrame:
    """The weighted sequences: prefix, conv_id (the smallest), weight, depth, total and ends_sha256."""
    ends = steps.where("ends").select("prefix", "conv_id", "depth", (F.col("before") + F.col("bytes")).alias("total"))
    ordered = ends.repartition("prefix").sortWithinPartitions("prefix", "conv_id")
    return cut_lineage(ordered.mapInArrow(_collapse, _ENDS), "trie-sequences")


def prefix_trie(rows: DataFrame, head: Callable[[int], int] = head_of) -> DataFrame:
    """A row per node of the trie of rebuilt conversations.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    ``prefix``, the node's name.
    """
    # the family's first conversation comes first
    ordered = turns(rows).repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "digest"
    )
    steps = cut_lineage(ordered.select("family", "conv_id", "digest", "bytes").mapInArrow(rebuilt(head), _STEP), "trie-steps")
    whole = sequences(steps)

    paths = steps.select("conv_id", "prefix", "parent", "depth", "before").join(
        whole.select("conv_id", "weight", F.col("depth").alias("length"), "total", F.col("prefix").alias("whole")), "conv_id"
    )
    paths = cut_lineage(paths, "trie-paths")
    inner = paths.where("depth < length").select("prefix").distinct()
    leaves = whole.join(inner, "prefix", "left_anti").select("prefix", F.lit(1).alias("leaf"))
    # what each sequence owns: the nodes from this depth on, behind so many bytes
    least = paths.groupBy("prefix").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("before").alias("before"))
    owned = least.groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("first"))
    facts = whole.select("conv_id", "prefix").join(owned, "conv_id", "left").join(leaves, "prefix", "left")
    facts = cut_lineage(facts.select("conv_id", "first.depth", "first.before", F.coalesce("leaf", F.lit(0)).alias("leaf")), "trie-facts")

    p, f = paths.alias("p"), facts.alias("f")
    marked = p.join(f, F.col("p.conv_id") == F.col("f.conv_id"))
    from_here = F.col("p.total") - F.col("p.before")
    different = F.when(F.col("f.depth").isNull(), 0).otherwise(F.col("p.total") - F.greatest("p.before", "f.before"))
    child = (F.col("f.depth") <= F.col("p.depth") + 1) & (F.col("p.depth") < F.col("p.length"))
    nodes = marked.groupBy("p.prefix").agg(
        F.min("p.conv_id").alias("conv_id"), F.first("p.depth").alias("depth"), F.first("p.parent").alias("parent"),
        F.sum("p.weight").alias("n_convs"), F.sum(F.coalesce(child.cast("long"), F.lit(0))).alias("n_children"),
        F.sum("f.leaf").cast("long").alias("n_leaves"),
        F.sum(F.col("p.weight") * from_here - different).cast("long").alias("saved_tokens"),
    )
    nodes = cut_lineage(nodes, "trie-nodes")
    parents = nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    told = nodes.join(parents, "parent", "left").join(whole.select("prefix", "ends_sha256"), "prefix", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"), F.lower(F.hex("prefix")).alias("prefix"),
    )
