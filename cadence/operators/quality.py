"""Data-quality rules as set-based queries.

Each rule yields violation rows ``(rule, pid, pos, detail)``; a report is the
union of the rules and ``groupBy(rule).count()``. Rules compare every row with
aggregates of its group or key, so they run as joins and aggregates over the
whole table instead of a sequential scan with Python sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import has_prefix

# Fixed values of the raw-data contract.
PLAYLIST_FIELDS = ["name", "collaborative", "pid", "modified_at", "num_albums", "num_tracks",
                   "num_followers", "num_edits", "duration_ms", "num_artists", "tracks"]
OPTIONAL_PLAYLIST_FIELDS = ["description"]
TRACK_FIELDS = ["pos", "artist_name", "artist_uri", "album_uri", "album_name", "track_uri",
                "track_name", "duration_ms"]
INFO_FIELDS = ["generated_on", "slice", "version"]
MIN_TRACKS, MIN_ARTISTS, MIN_ALBUMS = 5, 3, 2
CUTOFF_EPOCH_S = 1509494400  # 2017-11-01 00:00:00 UTC

SCHEMA_COLS = ["rule", "pid", "pos", "detail"]


def _v(df: DataFrame, cond: Column, rule: str, detail: Column, pos: Column | None = None) -> DataFrame:
    return df.where(cond).select(F.lit(rule).alias("rule"), F.col("pid").cast("long").alias("pid"),
                                 (pos if pos is not None else F.lit(None)).cast("long").alias("pos"),
                                 detail.cast("string").alias("detail"))


def _rules(df: DataFrame, rules, pos: Column | None = None) -> DataFrame:
    """Evaluate several (rule, condition, detail) triples in one pass over df:
    each row yields the array of its violations, which is exploded."""
    arr = F.array(*[F.when(cond, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
                    for rule, cond, detail in rules])
    v = df.select(F.col("pid").cast("long").alias("pid"),
                  (pos if pos is not None else F.lit(None)).cast("long").alias("pos"),
                  F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_v"))
    return v.select(F.col("_v.rule").alias("rule"), "pid", "pos", F.col("_v.detail").alias("detail"))


def playlist_rules(playlists: DataFrame, tracks: DataFrame, cutoff: int = CUTOFF_EPOCH_S) -> DataFrame:
    """I1 duplicate pid, I2 empty or null name, I3 < 5 tracks, I5 followers/edits,
    I6 modified after the cut-off (seconds, UTC), I11 too few artists/albums.
    One aggregate of the entries per group, one pass over the groups."""
    dup = playlists.groupBy("pid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    out = _v(dup, F.lit(True), "duplicate_pid", F.format_string("%d copies", F.col("_n")))
    per = tracks.groupBy("pid").agg(F.count(F.lit(1)).alias("_t"), F.countDistinct("artist_uri").alias("_ar"),
                                    F.countDistinct("album_uri").alias("_al"))
    j = playlists.select("pid", "name", "num_followers", "num_edits", "modified_at") \
        .join(per, "pid", "left").fillna(0, ["_t", "_ar", "_al"])
    return out.unionByName(_rules(j, [
        ("empty_name", F.coalesce(F.length("name"), F.lit(0)) == 0, F.lit("")),
        ("too_few_tracks", F.col("_t") < MIN_TRACKS, F.col("_t")),
        ("too_few_artists", F.col("_ar") < MIN_ARTISTS, F.col("_ar")),
        ("too_few_albums", F.col("_al") < MIN_ALBUMS, F.col("_al")),
        ("too_few_followers", F.col("num_followers") < 1, F.col("num_followers")),
        ("too_few_edits", F.col("num_edits") <= 0, F.col("num_edits")),
        ("modified_too_late", F.col("modified_at") > cutoff, F.col("modified_at"))]))


def track_rules(tracks: DataFrame, index_col: str | None = None) -> DataFrame:
    """I8 position differs from the array index, I10 URI prefixes (one pass).
    A null position or URI is a violation."""
    rules = []
    if index_col:
        rules.append(("out_of_order", ~F.col("pos").eqNullSafe(F.col(index_col)),
                      F.format_string("%d %d", F.col(index_col), F.col("pos"))))
    for kind in ("track", "album", "artist"):
        c = f"{kind}_uri"
        rules.append((f"invalid_{kind}_uri", ~F.coalesce(has_prefix(c, kind), F.lit(False)), F.coalesce(F.col(c), F.lit("null"))))
    return _rules(tracks, rules, F.col(index_col) if index_col else F.col("pos"))


def name_consistency(tracks: DataFrame) -> DataFrame:
    """I9: rows whose name differs from the first name seen (order pid, pos, then
    name) for the same URI; a null name is a name like any other.

    One pass stacks the three kinds and leaves the distinct (kind, uri, name) with
    their first position, combined before the shuffle. Only URIs with two names go
    back to the entries, by a join; where there is none, nothing is read again."""
    kinds = ("artist", "album", "track")
    stack = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_uri").alias("uri"), F.col(f"{k}_name").alias("name")) for k in kinds])
    entries = tracks.select("pid", "pos", F.explode(stack).alias("e")).select("pid", "pos", "e.kind", "e.uri", "e.name").where(F.col("uri").isNotNull())
    names = entries.groupBy("kind", "uri", "name").agg(F.min(F.struct("pid", "pos")).alias("at"))
    two = names.groupBy("kind", "uri").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("at", "name")).alias("_f")).where(F.col("_n") > 1)
    bad = entries.join(two.select("kind", "uri", F.col("_f.name").alias("_first")), ["kind", "uri"]).where(~F.col("name").eqNullSafe(F.col("_first")))
    return bad.select(F.concat(F.lit("mismatch_"), "kind", F.lit("_name")).alias("rule"), F.col("pid").cast("long").alias("pid"),
                      F.col("pos").cast("long").alias("pos"), F.concat_ws(" | ", "name", "_first").alias("detail"))


def reconcile(playlists: DataFrame, tracks: DataFrame) -> DataFrame:
    """I12: stored counts / duration differ from the values recomputed from entries."""
    per = tracks.groupBy("pid").agg(
        F.count(F.lit(1)).alias("num_tracks"), F.countDistinct("artist_uri").alias("num_artists"),
        F.countDistinct("album_uri").alias("num_albums"), F.sum("track_dur_ms").alias("duration_ms"))
    per = per.select("pid", *[F.col(c).alias(f"_{c}") for c in per.columns if c != "pid"])
    j = playlists.join(per, "pid", "left")
    rules = []
    for c in ("num_tracks", "num_artists", "num_albums", "duration_ms"):
        got = F.coalesce(F.col(f"_{c}"), F.lit(0))
        rules.append((f"{c}_mismatch", F.col(c) != got, F.format_string("%d %d", got, F.col(c))))
    return _rules(j, rules)


def key_rules(objects: DataFrame, json_col: str, required: list[str], optional: list[str],
              rule_prefix: str, pos: Column | None = None) -> DataFrame:
    """I4 / I7 / I13: unknown keys and missing required keys of JSON objects
    (a fixed schema cannot tell a missing key from a null, so keys are read
    from the text)."""
    keys = F.json_object_keys(F.col(json_col))
    allowed = F.array(*[F.lit(k) for k in required + optional])
    req = F.array(*[F.lit(k) for k in required])
    d = objects.withColumn("_k", keys)
    extra = d.select("*", F.explode(F.array_except("_k", allowed)).alias("_f"))
    missing = d.select("*", F.explode(F.array_except(req, "_k")).alias("_f"))
    return _v(extra, F.lit(True), f"extra_{rule_prefix}field", F.col("_f"), pos).unionByName(
        _v(missing, F.lit(True), f"missing_{rule_prefix}field", F.col("_f"), pos))


def missing_ids(df: DataFrame, col: str = "pid", n: int | None = None) -> DataFrame:
    """I14 / C12: ids in 0..n-1 absent from ``df`` (n defaults to max + 1)."""
    if n is None:
        n = int(df.agg(F.max(col)).first()[0]) + 1
    ids = df.sparkSession.range(0, n).withColumnRenamed("id", col)
    return ids.join(df.select(col), col, "left_anti")


def summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count(F.lit(1)).cast("long").alias("n"))


def validate_counts(got: DataFrame, expected: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(check_name, got, expected, status): joins measured values with expected ones
    on the check name; PASS when |got - expected| <= tolerance."""
    j = got.join(expected, "check_name", "full")
    ok = F.abs(F.col("got") - F.col("expected")) <= F.lit(float(tolerance))
    return j.select("check_name", "got", "expected",
                    F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))
