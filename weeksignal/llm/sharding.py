"""Shards of near equal bytes by histogram sort.

Documents are ordered by (digest of the text, id, number of the row), so equal texts stand together. Exact
bytes and rows below candidate boundaries are counted across all partitions; only the
intervals that hold a shard boundary, or too many rows for one task, are probed again
with finer boundaries. When every boundary has met a single key, the rows are exchanged
once, by interval, and numbered inside their interval. Probing jumps over the digits that
all keys of an interval share, so a text that fills a third of the table costs one round.

Only histograms reach the driver: at most ``FIRST`` + ``TOP_SHARE`` x 256 intervals a level.

Defined cases: a null text has no bytes, a null id sorts first; rows equal in text and id are
told apart by a number of their own, so boundaries fall between them like between others, and which
of them lies where has no meaning, as they are alike; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weeksignal.session import cut_lineage

#: Leading hexadecimal digits of the first histogram, and digits added when an interval is probed again.
FIRST_DIGITS, NEXT_DIGITS = 3, 2
#: An interval is probed again if it holds more than one part in so many of all rows.
TOP_SHARE = 1024
OVERHEAD = 16


def keyed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the sort key: 16 hexadecimal digits of the text's digest, the id and the row's number each.

    The sign bit of the id is flipped, so negative ids sort before positive ones. The number is
    the row's place in this read, so the result must be written before it is used twice.
    """
    t = F.coalesce(docs[f"`{text}`"], F.lit(""))
    flipped = docs[f"`{id_col}`"].cast("long").bitwiseXOR(F.lit(-(2**63)))
    tail = F.coalesce(F.lower(F.lpad(F.hex(flipped), 16, "0")), F.lit(" " * 16))
    number = F.lower(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    return docs.select(
        docs[f"`{id_col}`"].alias("doc_id"),
        (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
        F.concat(F.substring(F.md5(F.encode(t, "UTF-8")), 1, 16), tail, number).alias("key"),
    )


def _counted(df: DataFrame, prefix: str) -> list:
    return df.groupBy(F.col(prefix).alias("prefix")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
    ).collect()


def _common(a: str, b: str) -> int:
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


def histogram(rows: DataFrame, shards: int) -> tuple[DataFrame, list]:
    """Each row's interval ``leaf``, and the intervals in order with bytes and rows before them.

    An interval is final if it holds one key, or if no shard boundary can fall behind its
    first row and it is small enough for one task.
    """
    found = _counted(rows.withColumn("leaf", F.substring("key", 1, FIRST_DIGITS)), "leaf")
    total, count = sum(r["bytes"] for r in found), sum(r["rows"] for r in found)
    leaves = {r["prefix"]: r for r in found}
    rows = rows.withColumn("leaf", F.substring("key", 1, FIRST_DIGITS))
    while True:
        before, again = 0, []
        for prefix in sorted(leaves):
            leaf = leaves[prefix]
            last = before + leaf["bytes"] - OVERHEAD
            split = before * shards // total != last * shards // total
            if leaf["low"] != leaf["high"] and (split or leaf["rows"] * TOP_SHARE > count + TOP_SHARE):
                again.append((prefix, _common(leaf["low"], leaf["high"]) + NEXT_DIGITS))
            before += leaf["bytes"]
        if not again:
            break
        probes = rows.sparkSession.createDataFrame(again, "probe string, digits int")
        joined = rows.join(F.broadcast(probes), F.col("leaf") == F.col("probe"), "left")
        finer = F.when(F.col("digits").isNull(), F.col("leaf")).otherwise(F.expr("rpad(substring(key, 1, digits), digits, ' ')"))
        open_rows = joined.where(F.col("digits").isNotNull()).withColumn("leaf", finer)
        rows = joined.withColumn("leaf", finer).drop("probe", "digits")
        for prefix, _ in again:
            del leaves[prefix]
        leaves |= {r["prefix"]: r for r in _counted(open_rows, "leaf")}
    out, bytes_before, rows_before = [], 0, 0
    for prefix in sorted(leaves):
        out.append((prefix, bytes_before, rows_before))
        bytes_before += leaves[prefix]["bytes"]
        rows_before += leaves[prefix]["rows"]
    return rows, [(p, min(shards - 1, b * shards // total), n) for p, b, n in out]


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot; the shards' bytes differ by one document at most from their share."""
    slim = cut_lineage(keyed(docs, id_col, text), "shard-keys")
    rows, leaves = histogram(slim, shards)
    first: dict[int, int] = {}
    for _, number, rows_before in leaves:
        first.setdefault(number, rows_before)
    table = docs.sparkSession.createDataFrame(
        [(p, number, rows_before - first[number]) for p, number, rows_before in leaves], "leaf string, shard int, base long"
    )
    numbered = F.expr("row_number() OVER (PARTITION BY leaf ORDER BY key)")
    placed = rows.withColumn("place", numbered).join(F.broadcast(table), "leaf")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place") - 1).cast("long").alias("slot"))
