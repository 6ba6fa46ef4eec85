"""Sharding by extendible hashing under a byte limit, in DataFrame operations only.

A document's hash is the first 60 bits of the MD5 of its key.  The directory is
indexed by leading hash bits.  A bucket that is over the byte limit is split on
one more bit, and only such buckets are; the others keep their local depth.

All splits down to a depth are decided on one histogram of bytes by hash
prefix: a bucket is a shard if it fits and its parent does not.  The histogram
is as deep as an even spread needs plus ``extra_bits``; buckets still over the
limit there (hot keys, long texts) are split further in another round over
their own documents, until every bit of the hash is used.

Documents that no bit can separate (one key with more bytes than the limit) are
cut by a second hash over key and text, and rows that are equal even there by
their row number in the written table of keys.  A document that is larger than
the limit by itself is a shard of its own, marked ``oversize``.

Edge cases: a null text has 0 bytes; a null key hashes as the word "null";
repeated rows count with their bytes each; an empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.store import written

BITS = 60


def bits_of(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as 60 characters 0 or 1."""
    return F.lpad(F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 2), BITS, "0")


def split_round(docs: DataFrame, limit: int, done: int, depth: int) -> DataFrame:
    """``docs`` (bits, n_bytes) with ``shard`` (a prefix of bits, ``done`` to ``depth`` long, null if still too large), and the shard's bytes and documents."""
    cells = written(docs.groupBy(F.substring(F.col("bits"), 1, depth).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "shard-cells")
    ancestor = cells.select("cell", "b", "n", F.explode(F.sequence(F.lit(done), F.lit(depth))).alias("d")).withColumn("prefix", F.substring(F.col("cell"), F.lit(1), F.col("d")))
    buckets = ancestor.groupBy("d", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")).filter(
        (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    leaf = ancestor.select("cell", "d", "prefix").join(buckets.hint("merge"), ["d", "prefix"]).groupBy("cell").agg(
        F.min(F.struct("d", "prefix", "shard_bytes", "shard_docs")).alias("l"))
    # Merge joins: the exploded prefixes and the directory are larger than the small files they are planned from.
    directory = cells.select("cell").join(leaf.hint("merge"), "cell", "left").select(
        "cell", F.col("l.prefix").alias("shard"), F.col("l.shard_bytes").alias("shard_bytes"), F.col("l.shard_docs").alias("shard_docs"))
    return docs.join(directory.withColumnRenamed("cell", "__cell").hint("merge"), F.substring(F.col("bits"), 1, depth) == F.col("__cell")).drop("__cell")


def shard(docs: DataFrame, *, limit_bytes: int, extra_bits: int = 4, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, shard_id (the shard's hash prefix, one character a bit), depth, shard_bytes, shard_docs and oversize of every row."""
    text = F.coalesce(F.col("_t"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keys = docs.select(docs[key].alias("doc_id"), docs[text_col].alias("_t")).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), bits_of(name).alias("bits"), F.md5(F.concat_ws("\0", name, text)).alias("own"))
    todo = written(keys, "shard-keys")
    total = todo.agg(F.sum("n_bytes")).first()[0] or 0
    out, done, width = [], 0, BITS
    depth = min(BITS, max(1, math.ceil(math.log2(max(2, total / limit_bytes)))) + extra_bits)
    while True:
        got = written(split_round(todo, limit_bytes, done, depth), "shard-round")
        out.append(got.filter("shard is not null"))
        rest = got.filter("shard is null").select("doc_id", "n_bytes", "bits", "own")
        if rest.isEmpty():
            break
        if depth == width:
            # No hash bit is left: first the text's hash, then the row's number in the written table.
            more = bits_of(F.col("own")) if width == BITS else bits_of(F.concat_ws(":", "own", F.monotonically_increasing_id()))
            rest, width = written(rest.withColumn("bits", F.concat("bits", more)), "shard-keys"), width + BITS
            if width > 5 * BITS:
                raise ValueError("rows that no hash separates")
        todo, done, depth = rest, depth, min(width, depth + 8)
    result = out[0]
    for d in out[1:]:
        result = result.unionByName(d)
    return result.select("doc_id", "n_bytes", F.col("shard").alias("shard_id"), F.length("shard").cast("long").alias("depth"), "shard_bytes", "shard_docs",
                         (F.col("shard_bytes") > limit_bytes).alias("oversize"))
