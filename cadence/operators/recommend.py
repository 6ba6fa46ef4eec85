"""Recommenders: popularity, item-item co-occurrence, label popularity.

Recommendations are long tables ``(pid, rank, item, score)``; every ranking
has a total order (score desc, then item asc) and top-k per group is a
``row_number() <= k`` filter, which Catalyst plans as a window group limit
(a per-partition top-k before the shuffle).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIRS_PER_TASK = 2_000_000  # pairs of items, or candidates, that a task counts in its table


def tasks_for(rows, per_task: int = PAIRS_PER_TASK) -> int:
    """Number of tasks that take about ``per_task`` of ``rows`` each."""
    return max(1, math.ceil((rows or 0) / per_task))


def top_k_per_group(df: DataFrame, group: str, order, k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def first_per_key(df: DataFrame, key, order_cols: list[str], value_cols: list[str]) -> DataFrame:
    """First row per key under ``order_cols`` (deterministic drop-duplicates):
    ``min_by(struct(values), struct(order))``, a partial aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    picked = F.min_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_v")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def track_meta(tracks: DataFrame) -> DataFrame:
    """Catalogue: the first-seen (pid, pos) row per track_uri."""
    cols = ["track_name", "artist_uri", "artist_name", "album_uri", "album_name", "track_dur_ms"]
    return first_per_key(tracks, "track_uri", ["pid", "pos"], cols)


def top_popular(vocab: DataFrame, meta: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent catalogue items with names; ``vocab_rank`` = idx + 1."""
    j = vocab.join(meta.select("track_uri", "track_name", "artist_name"), "track_uri", "inner")
    top = j.orderBy(F.col("corpus_freq").desc(), F.col("corpus_idx")).limit(n)
    return top.select((F.col("corpus_idx") + 1).alias("vocab_rank"), "track_uri", "track_name",
                      "artist_name", "corpus_idx", "corpus_freq")


def cooccurrence(seqs: DataFrame, max_len: int | None = 50, min_count: int = 3, item: str = "track_idx",
                 group: str = "pid", block_items: int = 256, stage=lambda df, name: df) -> DataFrame:
    """Symmetric item pair counts over the first ``max_len`` positions of each
    group (None: the whole group), each pair counted once per group; pairs below
    ``min_count`` dropped.

    With ``max_len`` the self-join sees at most max_len distinct items per group
    (at most max_len*(max_len-1)/2 half pairs), however large the group; whole
    groups are joined by blocks, see ``whole_group_pairs``. Only half pairs
    (a < b) are counted, combined before their shuffle; the mirror is added after
    pruning. Groups are dealt to as many tasks as their pairs need, so the table
    in which a task combines pairs does not grow with the input.
    """
    from cadence.operators.profile import fit_scalars
    if max_len is None:
        half = whole_group_pairs(seqs, min_count, item, group, block_items, stage)
    else:
        u = seqs.where(F.col("pos") < max_len).select(group, item).distinct()
        n = fit_scalars(seqs.where(F.col("pos") < max_len).select(group), F.count(F.lit(1)).alias("n"))["n"] or 0
        u = u.repartition(tasks_for(n * max_len / 2), group)
        a, b = u.alias("a"), u.alias("b")
        half = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col(f"a.{item}") < F.col(f"b.{item}"))) \
            .select(F.col(f"a.{item}").alias("item"), F.col(f"b.{item}").alias("neighbour"))
    half = half.groupBy("item", "neighbour").agg(F.count(F.lit(1)).cast("long").alias("cnt")) \
        .where(F.col("cnt") >= min_count)
    # both directions from one pass over the pruned half pairs
    both = F.array(F.struct(F.col("item").alias("a"), F.col("neighbour").alias("b")),
                   F.struct(F.col("neighbour").alias("a"), F.col("item").alias("b")))
    return half.select(F.explode(both).alias("_p"), "cnt").select(
        F.col("_p.a").alias("item"), F.col("_p.b").alias("neighbour"), "cnt")


def whole_group_pairs(seqs: DataFrame, min_count: int, item: str, group: str, block_items: int, stage=lambda df, name: df) -> DataFrame:
    """(item, neighbour) for every pair of distinct items a < b of a group that can reach ``min_count``, once per group.

    Items of fewer than ``min_count`` groups are dropped first: no pair of theirs
    is in more. What is left of a group is cut into blocks of about
    ``block_items`` items by hash, and its pairs form a triangle of block pairs:
    (group, block, block) is the join key, so a group of any size is dealt to many
    tasks, each key holding a bounded number of rows. An item goes to as many keys
    as its group has blocks.
    """
    from cadence.operators.profile import fit_scalars
    u = stage(seqs.select(group, item).distinct(), "group_items")
    often = u.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count).select(item)
    u = stage(u.join(often, item, "left_semi"), "group_items_often")
    large = u.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_items)
    u = u.join(large, group, "left").withColumn("_blocks", F.coalesce(F.ceil(F.col("_n") / block_items), F.lit(1)).cast("int"))
    u = u.withColumn("_b", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    zero, last = F.lit(0), F.col("_blocks") - 1
    a = u.select(F.col(group).alias("_g"), F.col("_b").alias("_x"), F.explode(F.sequence(F.col("_b"), last)).alias("_y"), F.col(item).alias("_l"))
    b = u.select(F.col(group).alias("_g"), F.explode(F.sequence(zero, F.col("_b"))).alias("_x"), F.col("_b").alias("_y"), F.col(item).alias("_r"))
    # a row meets at most a block of others in each of its keys, and half of its own block
    pairs = u.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("_n")).agg(F.sum(F.col("_n") * F.col("_n") / 2).alias("n"))
    n = tasks_for(fit_scalars(pairs, F.max("n").alias("n"))["n"])
    a, b = (x.repartition(n, "_g", "_x", "_y") for x in (a, b))
    both = a.join(b, ["_g", "_x", "_y"]).where((F.col("_x") < F.col("_y")) | (F.col("_l") < F.col("_r")))
    return both.select(F.least("_l", "_r").alias("item"), F.greatest("_l", "_r").alias("neighbour"))


def neighbours(pairs: DataFrame, top_n: int = 100) -> DataFrame:
    """(item, neighbour, cnt, rnk): the top_n neighbours per item by (cnt desc, neighbour)."""
    return top_k_per_group(pairs, "item", [F.col("cnt").desc(), F.col("neighbour")], top_n, "rnk")


def rec_itemcf(seeds: DataFrame, nbrs: DataFrame, k: int = 20, item: str = "track_idx") -> DataFrame:
    """score(c) = number of seed positions whose neighbour list holds c; seen
    items removed; top-k per group. Hot seed items are split by AQE skew-join
    handling (the neighbour side holds at most top_n rows per key). Candidates are
    dealt to as many tasks as their number needs before they are counted."""
    from cadence.operators.profile import fit_scalars
    s = seeds.select("pid", F.col(item).alias("_seed"))
    n = nbrs.select(F.col("item").alias("_seed"), F.col("neighbour").alias("item"))
    met = s.groupBy("_seed").agg(F.count(F.lit(1)).alias("_s")).join(n.groupBy("_seed").agg(F.count(F.lit(1)).alias("_n")), "_seed")
    tasks = tasks_for(fit_scalars(met, F.sum(F.col("_s") * F.col("_n")).alias("n"))["n"])
    sc = s.join(n, "_seed", "inner").repartition(tasks, "pid", "item").groupBy("pid", "item").agg(F.count(F.lit(1)).cast("long").alias("score"))
    seen = seeds.select("pid", F.col(item).alias("item")).distinct()
    cand = sc.join(seen, ["pid", "item"], "left_anti")
    return top_k_per_group(cand, "pid", [F.col("score").desc(), F.col("item")], k)


# ---- label (genre) path -----------------------------------------------------
def filter_labelled(playlists: DataFrame, labels: DataFrame, min_tracks: int = 50) -> DataFrame:
    """(pid, genre): labelled groups with at least ``min_tracks`` entries."""
    return playlists.select("pid", "num_tracks").join(labels.select("pid", "genre"), "pid", "inner") \
        .where(F.col("num_tracks") >= min_tracks).select("pid", "genre")


def track_label_counts(entries: DataFrame, labels: DataFrame, item: str = "track_uri") -> DataFrame:
    """(item, genre, cnt): entries per (item, label of its group), with multiplicity."""
    return entries.select("pid", item).join(labels.select("pid", "genre"), "pid", "inner") \
        .groupBy(item, "genre").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


def majority_label(counts: DataFrame, item: str = "track_uri") -> DataFrame:
    """(item, genre, genre_count): most frequent label per item (ties: label asc)."""
    r = top_k_per_group(counts, item, [F.col("cnt").desc(), F.col("genre")], 1, "_r")
    return r.select(item, "genre", F.col("cnt").alias("genre_count"))


def label_popularity(counts: DataFrame, item: str = "track_uri") -> DataFrame:
    """(genre, rank, item, cnt): rank of every (item, label) pair inside its label.

    The window is partitioned by label (few values); the rank is built with
    the bucketed ordered index so a large label is ranked by many tasks."""
    from cadence.operators.ranking import key_prefix, magnitude, ordered_index
    skip = len("spotify:track:") if item == "track_uri" else 0
    d = counts.withColumn("_p", key_prefix(item, skip, 2)).withColumn("_mag", magnitude("cnt"))
    r = ordered_index(d, partition_by=["genre"], bucket=["_mag", "cnt", "_p"],
                      bucket_order=[F.col("_mag").desc(), F.col("cnt").desc(), F.col("_p")],
                      row_order=[F.col(item)], index_col="_i")
    return r.select("genre", (F.col("_i") + 1).alias("rank"), item, "cnt")


def seed_sample(seeds: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` seed rows of each group, in the order of a hash of (seed, pid, pos).

    The limit is applied in every partition before the shuffle, so a group of any
    size sends at most n rows from each."""
    text = F.concat_ws("|", F.lit(str(seed)), F.col("pid").cast("string"), F.col("pos").cast("string"))
    return top_k_per_group(seeds.withColumn("_h", F.md5(text)), "pid", [F.col("_h"), F.col("pos")], n, "_r").drop("_h", "_r")


def infer_label(seeds: DataFrame, item_labels: DataFrame, groups: DataFrame,
                item: str = "track_uri", sample_n: int | None = None) -> DataFrame:
    """(pid, inferred): majority label of the known seed items (with
    multiplicity, ties: label asc); 'unknown' when no seed item is known. With
    ``sample_n`` only so many seed entries of a group vote (see ``seed_sample``)."""
    seeds = seeds if sample_n is None else seed_sample(seeds, sample_n)
    votes = seeds.select("pid", item).join(item_labels.select(item, "genre"), item, "inner") \
        .groupBy("pid", "genre").agg(F.count(F.lit(1)).alias("_c"))
    top = top_k_per_group(votes, "pid", [F.col("_c").desc(), F.col("genre")], 1, "_r")
    return groups.select("pid").join(top.select("pid", "genre"), "pid", "left").select(
        "pid", F.coalesce(F.col("genre"), F.lit("unknown")).alias("inferred"))


def rec_by_label(seeds: DataFrame, inferred: DataFrame, popularity: DataFrame, k: int = 20,
                 item: str = "track_uri", block: int = 64) -> DataFrame:
    """Walk the inferred label's ranking, skip seen items, stop at k.

    A group needs ranks up to k + |seen|, as at most |seen| of them are
    skipped. Rankings are cut into blocks of ``block`` ranks; a group is sent to
    the blocks it needs and meets them by an equi-join on (label, block), so a
    group with a large seed makes no other group probe deeper, and the keys of a
    frequent label are spread over its blocks."""
    seen = seeds.select("pid", F.col(item).alias("item")).distinct()
    nseen = seen.groupBy("pid").agg(F.count(F.lit(1)).alias("_ns"))
    q = inferred.where(F.col("inferred") != "unknown").join(nseen, "pid", "inner")
    q = q.select("pid", "inferred", (F.col("_ns") + k).alias("_need"),
                 F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_ns") + k - 1) / block))).alias("_blk"))
    pop = popularity.select(F.col("genre").alias("inferred"), F.floor((F.col("rank") - 1) / block).alias("_blk"),
                            F.col("rank").alias("_gr"), F.col(item).alias("item"), "cnt")
    cand = q.join(pop, ["inferred", "_blk"]).where(F.col("_gr") <= F.col("_need")) \
        .select("pid", "_gr", "item", F.col("cnt").alias("score"))
    cand = cand.join(seen, ["pid", "item"], "left_anti")
    return top_k_per_group(cand, "pid", [F.col("_gr")], k).drop("_gr")


# ---- next item from the ordered seed ---------------------------------------
def adjacent_pairs(seqs: DataFrame, lags: int = 1, vocab_limit: int | None = None, item: str = "track_idx",
                   inputs: DataFrame | None = None, stretch: int = 1024) -> DataFrame:
    """(lag, input, target): the items of whole sequences that stand ``lag`` (1..lags) positions apart.

    A row is shuffled once, to its stretch of ``stretch`` positions, where a window
    finds its successors; the first rows of a stretch are also sent to the end of the
    one before, as targets only. So a hot group is spread over many tasks. A
    position that is held twice counts with each of its rows. ``inputs`` (input, no
    value twice) names the inputs whose pairs are wanted, all by default."""
    from cadence.operators.profile import measured
    from cadence.operators.sequences import map_unknown
    stretch = max(stretch, lags)
    s = seqs.where(F.col("pid").isNotNull() & F.col("pos").isNotNull()).select("pid", "pos", map_unknown(item, vocab_limit).alias("x"))
    if inputs is None:
        s = s.withColumn("_own", F.lit(True))
    else:
        wanted = inputs.select(F.col("input").alias("x"), F.lit(True).alias("_own"))
        s = s.join(measured(wanted, 40), "x", "left").select("pid", "pos", "x", F.coalesce("_own", F.lit(False)).alias("_own"))
    own = F.floor(F.col("pos") / stretch)
    places = F.array(F.struct(own.alias("at"), F.col("_own").alias("own")), F.struct((own - 1).alias("at"), F.lit(False).alias("own")))
    s = s.select("pid", "pos", "x", F.explode(F.slice(places, 1, F.when(F.pmod(F.col("pos"), F.lit(stretch)) < lags, 2).otherwise(1))).alias("_p"))
    s = s.select("pid", "pos", "x", F.col("_p.at").alias("_at"), F.col("_p.own").alias("_own"))
    after = Window.partitionBy("pid", "_at").orderBy("pos").rangeBetween(1, lags)
    met = s.withColumn("_next", F.collect_list(F.struct("pos", "x")).over(after)).where("_own")
    return met.select("pos", F.col("x").alias("input"), F.explode("_next").alias("_n")).select(
        (F.col("_n.pos") - F.col("pos")).cast("int").alias("lag"), "input", F.col("_n.x").alias("target"))


def transitions(pairs: DataFrame) -> DataFrame:
    """(input, target, cnt, prob): counts of adjacent (input, target) pairs and
    their share among the input's successors."""
    t = pairs.groupBy("input", "target").agg(F.count(F.lit(1)).cast("long").alias("cnt"))
    tot = t.groupBy("input").agg(F.sum("cnt").alias("_tot"))
    return t.join(tot, "input").withColumn("prob", F.col("cnt") / F.col("_tot")).drop("_tot")


def _known(trans: DataFrame, vocab_limit: int | None) -> DataFrame:
    return trans if vocab_limit is None else trans.where(F.col("target") < vocab_limit)


def rec_next_item(seeds: DataFrame, trans: DataFrame, n_items: int, k: int = 20, vocab_limit: int | None = None,
                  item: str = "track_idx", exclude_seen: bool = False, block: int = 64) -> DataFrame:
    """Top-k successors of the last seed item by (prob desc, item asc); with a
    ``vocab_limit`` only items below it (PAD / UNK never returned). Fewer than
    k are filled from the popularity order (idx 0, 1, ... of ``n_items``); with
    ``exclude_seen`` the fill goes on past the group's seen items, so it ends
    short of k only where the vocabulary does. Empty seeds get no rows.
    """
    last = seeds.groupBy("pid").agg(F.max_by(item, "pos").alias("_last"))
    # successors are cut to the top per input *before* the join, so a popular
    # last item never multiplies into all of its successors per group
    keep = k
    if exclude_seen:
        from cadence.operators.profile import fit_scalars
        ns = seeds.select("pid", item).distinct().groupBy("pid").agg(F.count(F.lit(1)).alias("_n"))
        keep = k + int(fit_scalars(ns, F.max("_n").alias("m"))["m"] or 0)
    t = top_k_per_group(_known(trans, vocab_limit), "input",
                        [F.col("prob").desc(), F.col("target")], keep, "_r").select(
        F.col("input").alias("_last"), F.col("target").alias("item"), F.col("prob").alias("score"), "_r")
    if exclude_seen:
        # a group needs its own k + |seen| ranks: it goes to the blocks of ranks that hold them
        seen = seeds.select("pid", F.col(item).alias("item")).distinct()
        need = last.join(ns, "pid").select("pid", "_last", (F.col("_n") + k).alias("_need"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") + k - 1) / block))).alias("_blk"))
        t = t.withColumn("_blk", F.floor((F.col("_r") - 1) / block))
        cand = need.join(t, ["_last", "_blk"]).where(F.col("_r") <= F.col("_need")).join(seen, ["pid", "item"], "left_anti")
    else:
        cand = last.join(t, "_last", "inner")
    cand = cand.select("pid", "item", "score", F.lit(0).alias("_prio"))
    cand = top_k_per_group(cand, "pid", [F.col("score").desc(), F.col("item")], k, "_r").drop("_r")
    # popularity fill: the first idx values are the most frequent items
    # (one more for each seen item, of which at most that many can be skipped)
    top = n_items if vocab_limit is None else min(n_items, vocab_limit)
    f = last.join(ns, "pid") if exclude_seen else last.withColumn("_n", F.lit(0))
    fill = f.select("pid", F.explode(F.sequence(F.lit(0), F.least(F.lit(top), F.col("_n") + k).cast("int") - 1)).alias("item")) \
        .select("pid", F.col("item").cast("int").alias("item"), F.lit(0.0).alias("score"), F.lit(1).alias("_prio"))
    if exclude_seen:
        fill = fill.join(seen, ["pid", "item"], "left_anti")
    fill = fill.join(cand.select("pid", "item"), ["pid", "item"], "left_anti")
    allc = cand.select("pid", F.col("item").cast("int").alias("item"), "score", "_prio").unionByName(fill)
    return top_k_per_group(allc, "pid", [F.col("_prio"), F.col("score").desc(), F.col("item")], k).drop("_prio")


def token_accuracy(pairs: DataFrame, trans: DataFrame, vocab_limit: int | None = None) -> DataFrame:
    """Next-position accuracy over adjacent (input, target) pairs: prediction =
    most likely successor (< vocab_limit) of the input, else the most popular
    item (0)."""
    best = top_k_per_group(_known(trans, vocab_limit), "input",
                           [F.col("cnt").desc(), F.col("target")], 1, "_r") \
        .select("input", F.col("target").alias("pred"))
    f = pairs.join(best, "input", "left") \
        .withColumn("pred", F.coalesce(F.col("pred"), F.lit(0)))
    return f.agg(F.count(F.lit(1)).cast("long").alias("n_tokens"),
                 F.round(F.avg((F.col("pred") == F.col("target")).cast("double")), 9).alias("accuracy"))


# ---- catalogue search ------------------------------------------------------
def decode_recs(recs: DataFrame, catalog: DataFrame, holdout: DataFrame | None = None,
                item: str = "track_idx") -> DataFrame:
    """Names for recommended indexes ('<unknown>' / 0 when absent) and a hit flag."""
    cat = catalog.select(F.col("corpus_idx").cast("int").alias("item"), "track_uri", "track_name",
                         "artist_name", "corpus_freq")
    out = recs.join(cat, "item", "left").select(
        "pid", "rank", "item", F.coalesce("track_name", F.lit("<unknown>")).alias("track_name"),
        F.coalesce("artist_name", F.lit("<unknown>")).alias("artist_name"),
        F.coalesce("corpus_freq", F.lit(0)).cast("long").alias("corpus_freq"))
    if holdout is not None:
        h = holdout.select("pid", F.col(item).alias("item"), F.lit(True).alias("hit"))
        out = out.join(h, ["pid", "item"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return out


def lag_transitions(seqs: DataFrame, lags: int = 3, vocab_limit: int | None = None, item: str = "track_idx", inputs: DataFrame | None = None) -> DataFrame:
    """(lag, input, target, cnt, prob): pairs (s[t], s[t+lag]) of whole training sequences.

    ``inputs``: see ``adjacent_pairs``; a list is whole or left out. A list holds an item once, so the window that adds it up
    is bounded by the vocabulary, however often its input occurs."""
    c = adjacent_pairs(seqs, lags, vocab_limit, item, inputs).where(F.col("input").isNotNull()) \
        .groupBy("lag", "input", "target").agg(F.count(F.lit(1)).cast("long").alias("cnt"))
    tot = F.sum("cnt").over(Window.partitionBy("lag", "input"))
    return c.withColumn("prob", F.col("cnt") / tot)


def lag_context(seeds: DataFrame, lags: int = 3, item: str = "track_idx", stage=lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """((pid, last position), (pid, lag, input)) of the seeds: the items at the last ``lags`` positions."""
    mx = stage(seeds.groupBy("pid").agg(F.max("pos").alias("_mx")), "lag_mx")
    return mx, stage(seeds.join(mx, "pid").where(F.col("pos") > F.col("_mx") - lags).select(
        "pid", (F.col("_mx") - F.col("pos") + 1).cast("int").alias("lag"), F.col(item).alias("input")), "lag_ctx")


def rec_next_item_lags(seeds: DataFrame, lt: DataFrame, n_items: int, k: int = 20, lags: int = 3, vocab_limit: int | None = None,
                       cut: int | None = None, item: str = "track_idx", digits: int = 12, stage=lambda df, name: df) -> DataFrame:
    """score(c) = sum over lag l of P_l(c | seed[-l]) / l, top-k by
    (round(score, 12) desc, item asc), popularity fill, seen items allowed.

    Exact without joining every group with every successor: each (lag, input)
    list is cut to its top ``cut`` targets; candidates are scored exactly by
    equi-join lookups; an item outside all cut lists scores at most
    tau = sum_l (cut-th prob of list l) / l. Groups whose k-th score is not
    above tau are recomputed from the full lists (only those groups).
    ``stage`` may keep the small inputs that are read several times as tables.
    """
    cut = cut or 2 * k
    mx, ctx = lag_context(seeds, lags, item, stage)
    known = _known(lt, vocab_limit)
    # rank inside each (lag, input) list; rows beyond cut + 1 are not needed
    ranked = stage(known.withColumn("_r", F.row_number().over(
        Window.partitionBy("lag", "input").orderBy(F.col("prob").desc(), F.col("target"))))
        .where(F.col("_r") <= cut + 1), "lag_ranked")
    short = ranked.where(F.col("_r") <= cut)
    # bound term per list: prob at rank `cut` when the list is longer, else 0
    thr = ranked.where(F.col("_r") == cut + 1).select("lag", "input", F.col("prob").alias("_thr"))
    w = F.lit(1.0) / F.col("lag")

    def score(cands):
        # exact score of each (pid, candidate) from every lag's full list
        j = cands.join(ctx, "pid").join(known.select("lag", "input", F.col("target").alias("item"), "prob"),
                                        ["lag", "input", "item"], "inner")
        return j.groupBy("pid", "item").agg(F.sum(F.col("prob") / F.col("lag")).alias("score"))

    cand = ctx.join(short.select("lag", "input", F.col("target").alias("item")), ["lag", "input"]) \
        .select("pid", "item").distinct()
    sc = score(cand)
    topk = top_k_per_group(sc, "pid", [F.round("score", digits).desc(), F.col("item")], k, "_rk")
    kth = topk.groupBy("pid").agg(F.min("score").alias("_kth"), F.count(F.lit(1)).alias("_n"))
    tau = ctx.join(thr, ["lag", "input"], "left").groupBy("pid").agg(
        F.sum(F.coalesce(F.col("_thr"), F.lit(0.0)) * w).alias("_tau"))
    chk = mx.select("pid").join(kth, "pid", "left").join(tau, "pid", "left").fillna(0.0, ["_tau"])
    ok = (F.col("_tau") == 0) | ((F.col("_n") >= k) & (F.col("_kth") > F.col("_tau")))
    good = chk.where(ok).select("pid")
    redo = chk.where(~ok).select("pid")
    full = score(ctx.join(redo, "pid", "left_semi").join(
        known.select("lag", "input", F.col("target").alias("item")), ["lag", "input"]).select("pid", "item").distinct())
    full_top = top_k_per_group(full, "pid", [F.round("score", digits).desc(), F.col("item")], k, "_rk")
    got = topk.join(good, "pid", "left_semi").unionByName(full_top).select(
        "pid", F.col("item").cast("int").alias("item"), "score", F.lit(0).alias("_prio"))
    top = min(k, n_items if vocab_limit is None else min(n_items, vocab_limit))
    fill = mx.select("pid", F.explode(F.sequence(F.lit(0), F.lit(top - 1))).alias("item")) \
        .select("pid", F.col("item").cast("int").alias("item"), F.lit(0.0).alias("score"), F.lit(1).alias("_prio"))
    fill = fill.join(got.select("pid", "item"), ["pid", "item"], "left_anti")
    allc = got.unionByName(fill)
    out = top_k_per_group(allc, "pid", [F.col("_prio"), F.round("score", digits).desc(), F.col("item")], k)
    return out.drop("_prio").withColumn("score", F.round("score", digits))
