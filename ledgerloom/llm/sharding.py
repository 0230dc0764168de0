"""Shards under a byte limit by extendible hashing, in DataFrame operations only.

A document's hash bits, read from the left, lead through a directory to its shard.  The directory starts with one shard;
a shard over the limit splits on its next bit, the others stay as they are.  As a shard's bytes only shrink with every bit,
a document's shard is the shortest prefix of its bits whose documents fit, which sums by prefix find for many levels at
once; only prefixes that are still too large at the last level are looked at again, some bits deeper.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import stage

SHARD_BYTES = 64 << 20
WORD_BITS = 60  # bits from the key's digest, and after them as many from the row's number, which part repeated keys
ROUND_BITS = 8  # further bits in each round


def _bits(number: Column) -> Column:
    return F.lpad(F.conv(number.cast("string"), 10, 2), WORD_BITS, "0")


def _prefix(depth: int | Column) -> Column:
    return F.substring(F.col("bits"), F.lit(1), F.lit(depth) if isinstance(depth, int) else depth)


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES, label: str = "shards") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, shard`` (its hash prefix as 0 and 1), ``depth, shard_bytes, shard_docs``.

    No shard exceeds ``limit`` bytes unless it holds one document alone.  Null and empty texts have no bytes.  Rows that
    repeat a key, null ones included, share its bits and are parted, if they must be, by bits of their own.  Only one
    document: the shard is the empty prefix.  An empty table gives no rows.
    """
    key_bits = F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")), 1, WORD_BITS // 4), 16, 10)
    own = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - WORD_BITS)
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    rows = stage(docs.select(F.col(f"`{key}`").alias("doc_id"), size.alias("n_bytes"), key_bits.cast("long").alias("h"), own.alias("own")), label)
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    open_rows = rows.withColumn("bits", F.concat(_bits(F.col("h")), _bits(F.col("own")))).drop("h", "own")
    start, depth, done = 0, min(max(0, ceil(log2(max(total / limit, 1)))) + 3, WORD_BITS), []
    while True:
        sums = stage(open_rows.groupBy(_prefix(depth).alias("bits")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")), f"{label}-sums")
        levels = sums.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(depth))))
        nodes = levels.groupBy("depth", _prefix(F.col("depth")).alias("shard")).agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == 2 * WORD_BITS))
        ways = levels.select("bits", "depth", _prefix(F.col("depth")).alias("shard")).join(fits, ["depth", "shard"])
        first = F.min(F.struct("depth", "shard", "shard_bytes", "shard_docs")).alias("first")
        directory = stage(sums.select("bits").join(ways.groupBy("bits").agg(first), "bits", "left"), f"{label}-directory")
        entry = directory.select(F.col("bits").alias("entry"), "first")
        found = open_rows.join(entry, _prefix(depth) == F.col("entry"))
        done.append(found.where("first IS NOT NULL").select("doc_id", "n_bytes", "first.shard", "first.depth", "first.shard_bytes", "first.shard_docs"))
        if directory.where("first IS NULL").isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_rows = stage(found.where("first IS NULL").drop("entry", "first"), f"{label}-open")
        start, depth = depth + 1, min(depth + ROUND_BITS, 2 * WORD_BITS)


def directory(assigned: DataFrame) -> DataFrame:
    """The directory of ``shards``' result: ``entry`` (a prefix as long as the longest shard's), ``shard``.

    Entries to which no document leads are left out; there may be two to the power of the longest prefix of them, so it is
    for tables of moderate depth.
    """
    leaves = assigned.select("shard", "depth").distinct()
    longest = leaves.agg(F.max("depth")).first()[0] or 0
    spread = leaves.withColumn("free", F.lit(longest) - F.col("depth"))
    tail = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, free)") - 1))
    padded = F.when(F.col("free") > 0, F.lpad(F.conv(F.col("tail").cast("string"), 10, 2), F.col("free"), F.lit("0"))).otherwise(F.lit(""))
    return spread.withColumn("tail", tail).select(F.concat("shard", padded).alias("entry"), "shard")
