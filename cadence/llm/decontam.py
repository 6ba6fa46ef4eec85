"""Benchmark decontamination over a broadcast hash set of test n-grams, in DataFrame operations only.

Words are maximal runs of ASCII letters, digits and characters outside ASCII,
with A-Z lowered.  A benchmark item gives its windows of ``n`` words; an item
of fewer words (but not none) gives one window, the whole item.

1. Every window is keyed by its anchor, the window's longest word (ties: the
   smallest), and the anchor's place in the window.
2. The training texts are scanned word by word against the broadcast set of
   anchors.  A hit names where a window would start; the document's words from
   there on are hashed and looked up in the broadcast set of window hashes.
3. Each hit is verified by comparing the words themselves.

The set is broadcast only if the benchmark's text is at most
``broadcast_bytes`` long; a larger benchmark is joined by sort-merge joins on
the same keys.  Hits of a document are merged as intervals; nothing else is shuffled.

Edge cases: null and empty texts have no words and no hits; repeated rows get
the same result each; a null doc_id is a document like any other; a null
item_id stands for an item that hits words but is not listed; items with
equal windows are all listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A-Z still stand in the text when words are cut; they are lowered word by word.  The class lists its characters one
#: by one, as Java looks those up in one table, but tests the ranges of a class one after the other.
RAW_WORD = "[^" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RAW_WORD), F.lit(0))


def row_key() -> Column:
    """A key of a row that every evaluation of the table gives alike: its id and a digest of its text.  Repeated rows
    share it, and their result."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def lowered(text: Column) -> Column:
    """A-Z lowered, nothing else."""
    return F.translate(text, UPPER, LOWER)


def windows(benchmark: DataFrame, *, n: int) -> DataFrame:
    """item_id, window (words joined by a space), size, anchor (in full lower case) and place of every window, once each."""
    b = benchmark.select("item_id", F.split(lowered(F.array_join(raw_words(F.col("text")), " ")), " ").alias("w")).filter("w[0] <> ''")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - n + 1))
    w = b.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("w"))
    best = F.array_max(F.transform("w", lambda x, i: F.struct(F.length(x).alias("len"), (-i).alias("at"))))
    return w.select("item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("size"), (-best["at"]).alias("place"),
                    F.lower(F.element_at("w", 1 - best["at"])).alias("anchor")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, *, n: int, broadcast_bytes: int) -> DataFrame:
    """row_key, first and last word and item_id of every occurrence of a window in ``docs`` (row_key, text)."""
    win = windows(benchmark, n=n)
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fits = size <= broadcast_bytes
    side = F.broadcast if fits else lambda d: d.hint("merge")
    anchors = side(win.select("anchor", "place", "size").distinct())
    words = docs.select("row_key", raw_words(F.col("text")).alias("w"))
    # A word with the words around it, which hold every window the word can be in.  Next to a broadcast set, that
    # context is cut for hits only; before a shuffle, it is cut for every word, and the document stays behind.
    around = F.slice("w", F.greatest(F.col("pos") - (n - 2), F.lit(1)), 2 * n - 1).alias("around")
    # The outer form leaves texts without words to the join; the other form has Spark cut all words a second time to drop such texts first.
    at = words.select("row_key", "w", F.posexplode_outer("w").alias("pos", "word"))
    same = F.lower("word") == F.col("anchor")
    at = at.join(anchors, same).select("row_key", "pos", "place", "size", around) if fits else \
        at.select("row_key", "pos", "word", around).join(anchors, same)
    first = F.col("pos") - F.col("place")
    inside = F.slice("around", F.greatest(first - F.greatest(F.col("pos") - (n - 1), F.lit(0)) + 1, F.lit(1)), F.col("size"))
    cand = at.select("row_key", first.cast("long").alias("first"), "size", "place", lowered(F.array_join(inside, " ")).alias("text"), F.size(inside).alias("found")) \
        .filter((F.col("first") >= 0) & (F.col("found") == F.col("size")))
    known = side(win.select("item_id", "window", F.col("place").alias("wplace"), F.xxhash64("window").alias("wh")))
    return cand.withColumn("h", F.xxhash64("text")).join(known, (F.col("h") == F.col("wh")) & (F.col("place") == F.col("wplace")) & (F.col("text") == F.col("window"))).select(
        "row_key", "first", (F.col("first") + F.col("size")).alias("end"), "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside a benchmark window), n_items, items_sha256
    (of the sorted, comma-joined ids; of the empty text if none), contaminated, and ``spans`` (first and end word of every merged hit)."""
    d = docs.select(row_key().alias("row_key"), "doc_id", "text")
    found = hits(d.select("row_key", "text"), benchmark, n=n, broadcast_bytes=broadcast_bytes)
    # Merged intervals: a start that lies inside the span so far extends it.
    per_doc = found.groupBy("row_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "end"))).alias("at"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    spans = F.aggregate("at", none, lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["first"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["first"].alias("first"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["first"].alias("first"), x["end"].alias("end"))))))
    per_doc = per_doc.select("row_key", spans.alias("spans"), "items")
    counted = d.select("row_key", "doc_id", F.size(raw_words(F.col("text"))).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(per_doc, "row_key", "left").select(
        "doc_id", "n_words", F.coalesce("spans", none).alias("spans"), items.alias("items")).select(
        "doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["first"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "spans"
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns kept."""
    d = docs.withColumn("__row", row_key())
    bad = hits(d.select(F.col("__row").alias("row_key"), "text"), benchmark, n=n, broadcast_bytes=broadcast_bytes).select(F.col("row_key").alias("__bad")).distinct()
    return d.join(bad, F.col("__row") == F.col("__bad"), "left_anti").drop("__row")
