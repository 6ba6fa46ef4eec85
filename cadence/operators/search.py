"""Substring search of a catalogue in popularity order, by an inverted index with early termination.

The index is built once and stored, two tables partitioned by ``block``:

* items, dealt to blocks of popularity ranks, each block ``growth`` times the one
  before (the first holds ``first_block`` ranks);
* postings: for every n-gram (0 to 3 characters) of a lower-cased title or artist
  the ranks of the items that hold it, per block, in pieces of bounded length;

and a table of how many items of each block hold each n-gram.

A request is looked up by its rarest n-gram. Its blocks are read from the most
popular on, in rounds: the first round reads blocks until they hold ``per_round``
candidates, each later one eight times as many, and only for requests that lack
hits. Hits come in popularity order, so a request is done with its
``max_results`` hits of the blocks read so far. A request of one letter reads the
first block alone, one with a rare n-gram is answered in the first round, and the
number of rounds grows with the logarithm of the catalogue.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.operators.recommend import top_k_per_group

GRAM = 3
PIECE = 8192
TABLES = {"items": "corpus_idx long, track_uri string, track_name string, artist_name string, _tn string, _an string, block int",
          "postings": "gram string, piece long, ranks array<long>, block int", "counts": "gram string, block int, n long"}


def grams(text: Column, n: int) -> Column:
    """The substrings of length ``n`` of ``text``; none if it is shorter."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, n)), F.array().cast("array<string>"))


def popularity_block(rank: Column, first_block: int, growth: int) -> Column:
    """0 for the first ``first_block`` ranks, then one more each time the rank is ``growth`` times as large."""
    bounds, bound = [], first_block
    while bound < 1 << 62:
        bounds.append(bound)
        bound *= growth
    return sum(((rank >= b).cast("int") for b in bounds), F.lit(0))


@dataclass
class SearchIndex:
    """The stored tables of an index."""

    items: DataFrame
    postings: DataFrame
    counts: DataFrame


def build_index(catalog: DataFrame, path: str, *, first_block: int = 1024, growth: int = 4) -> SearchIndex:
    """Write the index of ``catalog`` (corpus_idx, track_uri, track_name, artist_name) under ``path`` and open it.

    Null names hold no n-gram but the empty one, which every item holds."""
    cat = catalog.select(F.col("corpus_idx").cast("long").alias("corpus_idx"), "track_uri", "track_name", "artist_name", F.lower(F.coalesce("track_name", F.lit(""))).alias("_tn"),
                         F.lower(F.coalesce("artist_name", F.lit(""))).alias("_an"), popularity_block(F.col("corpus_idx"), first_block, growth).alias("block"))
    cat.write.partitionBy("block").parquet(f"{path}/items")
    items = read_table(catalog.sparkSession, path, "items")
    held = F.array(F.lit(""))
    for n in range(1, GRAM + 1):
        held = F.concat(held, F.array_union(grams(F.col("_tn"), n), grams(F.col("_an"), n)))
    each = items.select("block", "corpus_idx", F.explode(held).alias("gram"))
    lists = each.groupBy("block", "gram", F.floor(F.col("corpus_idx") / PIECE).alias("piece")).agg(F.sort_array(F.collect_list("corpus_idx")).alias("ranks"))
    lists.write.partitionBy("block").parquet(f"{path}/postings")
    postings = read_table(catalog.sparkSession, path, "postings")
    postings.groupBy("gram", "block").agg(F.sum(F.size("ranks")).cast("long").alias("n")).write.parquet(f"{path}/counts")
    return open_index(catalog.sparkSession, path)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}")


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    return SearchIndex(*(read_table(spark, path, t) for t in TABLES))


def plan_requests(index: SearchIndex, requests: DataFrame) -> DataFrame:
    """(request_id, q, gram, block, n, before) of ``requests`` (request_id, query): the blocks that hold the request's rarest
    n-gram, with the number of candidates in them and in the blocks before. A request with an n-gram that no item holds has no rows."""
    req = requests.select("request_id", F.lower(F.trim(F.coalesce("query", F.lit("")))).alias("q"))
    size = F.least(F.length("q"), F.lit(GRAM))
    asked = req.select("request_id", "q", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("q") - size + 1), lambda i: F.substring(F.col("q"), i, size)))).alias("gram"))
    total = index.counts.groupBy("gram").agg(F.sum("n").alias("_all"))
    rarest = top_k_per_group(asked.join(total, "gram", "left").fillna(0, ["_all"]), "request_id", [F.col("_all"), F.col("gram")], 1, "_r")
    order = Window.partitionBy("request_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    return rarest.select("request_id", "q", "gram").join(index.counts, "gram").withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))


def search(index: SearchIndex, requests: DataFrame, max_results: int = 10, per_round: int = 64, stage=lambda df, name: df) -> DataFrame:
    """(request_id, rank, corpus_idx, track_uri, track_name, artist_name): the ``max_results`` most popular items that hold
    each request (``request_id`` unique), case-insensitive, in their title or artist. An empty request matches every item."""
    plan = stage(plan_requests(index, requests), "search_plan")
    blocks = [r["block"] for r in plan.select("block").distinct().orderBy("block").collect()]  # as many as the catalogue has powers of growth
    found, low, high = None, 0, per_round
    while blocks:
        todo = plan.where((F.col("before") >= low) & (F.col("before") < high))
        if found is not None:
            done = found.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= max_results)
            todo = todo.join(done, "request_id", "left_anti")
        now = [r["block"] for r in todo.select("block").distinct().collect()]
        if now:
            at = F.col("block").isin(now)  # partitions of other blocks are not read
            cand = todo.select("request_id", "q", "gram", "block").join(index.postings.where(at).select("block", "gram", "ranks"), ["block", "gram"])
            cand = cand.select("request_id", "q", "block", F.explode("ranks").alias("corpus_idx"))
            cand = cand.join(index.items.where(at).select("block", "corpus_idx", "_tn", "_an"), ["block", "corpus_idx"])
            hits = cand.where(F.col("_tn").contains(F.col("q")) | F.col("_an").contains(F.col("q"))).select("request_id", "corpus_idx", "block")
            hits = hits if found is None else hits.unionByName(found)
            found = stage(top_k_per_group(hits, "request_id", [F.col("corpus_idx")], max_results), f"search_hits_{high}").drop("rank")
        if plan.where(F.col("before") >= high).isEmpty():
            break
        low, high = high, high * 8
    if found is None:
        found = plan.select("request_id", F.lit(0).cast("long").alias("corpus_idx"), "block").limit(0)
    top = top_k_per_group(found, "request_id", [F.col("corpus_idx")], max_results)
    return top.join(index.items, ["block", "corpus_idx"]).select("request_id", "rank", "corpus_idx", "track_uri", "track_name", "artist_name")
