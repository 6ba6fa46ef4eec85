"""A defective variant of the canonical tables, so that every data-quality rule has rows to report.

Which rows are defective follows from ``pid`` (and the position in the group)
modulo small numbers; ``DIRTY_CTE`` says the same in SQL over the prelude's
tables. ``tracks`` carries ``idx``, the place in the stored array, beside ``pos``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.quality import CUTOFF_EPOCH_S


def _at(mod: int, rest: int):
    return F.col("pid") % mod == rest


def dirty_playlists(playlists: DataFrame) -> DataFrame:
    """Gaps in the ids, duplicate ids, null and empty names, wrong stored numbers, late dates."""
    p = playlists.where(~_at(29, 3)).withColumns({
        "name": F.when(_at(37, 5), F.lit(None)).when(_at(37, 6), F.lit("")).otherwise(F.col("name")),
        "num_followers": F.when(_at(41, 7), F.lit(0)).otherwise(F.col("num_followers")).cast("long"),
        "num_edits": F.when(_at(41, 8), F.lit(0)).otherwise(F.col("num_edits")).cast("long"),
        "num_tracks": F.when(_at(43, 9), F.col("num_tracks") + 1).otherwise(F.col("num_tracks")),
        "num_artists": F.when(_at(43, 10), F.col("num_artists") + 1).otherwise(F.col("num_artists")),
        "num_albums": F.when(_at(43, 11), F.col("num_albums") + 2).otherwise(F.col("num_albums")),
        "duration_ms": F.when(_at(43, 12), F.col("duration_ms") - 1000).otherwise(F.col("duration_ms")),
        "modified_at": F.when(_at(47, 13), F.lit(CUTOFF_EPOCH_S + 1)).otherwise(F.col("modified_at")).cast("long")})
    return p.withColumn("_copies", F.explode(F.when(_at(31, 4), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copies")


def swapped(tracks: DataFrame) -> DataFrame:
    """``idx`` (place in the array) and ``pos``, exchanged for the first two entries of some groups."""
    return tracks.withColumn("idx", F.col("pos")).withColumn(
        "pos", F.when(_at(19, 2) & (F.col("idx") < 2), 1 - F.col("idx")).otherwise(F.col("idx")))


def dirty_tracks(tracks: DataFrame) -> DataFrame:
    """Short groups, exchanged places, wrong and null URIs, names that differ from the first one of their URI."""
    t = swapped(tracks.where(~_at(29, 3) & (~_at(53, 14) | (F.col("pos") < 3))))
    here = F.col("idx") == 2
    live = F.col("idx") == 3
    t = t.withColumn("track_uri", F.when(_at(23, 1) & here, F.concat(F.lit("x:"), "track_uri")).when(_at(23, 2) & here, F.lit(None)).otherwise(F.col("track_uri")))
    for kind, rest in (("album", 3), ("artist", 4)):
        c = f"{kind}_uri"
        t = t.withColumn(c, F.when(_at(23, rest) & here, F.concat(F.lit("x:"), c)).otherwise(F.col(c)))
    for kind, rest in (("artist", 5), ("album", 6), ("track", 7)):
        c = f"{kind}_name"
        t = t.withColumn(c, F.when(_at(17, rest) & live, F.concat(F.col(c), F.lit(" (live)"))).otherwise(F.col(c)))
    return t


def with_key_defects(playlists: DataFrame, tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Objects for JSON whose keys are wrong: a null field is a missing key, ``zz_note`` and ``zz_flag`` are unknown keys."""
    p = playlists.withColumn("num_albums", F.when(~_at(13, 2), F.col("num_albums"))).withColumn("zz_note", F.when(_at(13, 3), F.lit(1)))
    t = swapped(tracks).withColumn("album_name", F.when(~(_at(11, 4) & (F.col("idx") == 0)), F.col("album_name"))).withColumn(
        "zz_flag", F.when(_at(11, 5) & (F.col("idx") == 1), F.lit(1)))
    return p, t


DIRTY_CTE = f"""
, _dp AS (SELECT pid, CASE WHEN pid % 37 = 5 THEN NULL WHEN pid % 37 = 6 THEN '' ELSE name END AS name,
                 CASE WHEN pid % 41 = 7 THEN 0 ELSE num_followers END AS num_followers,
                 CASE WHEN pid % 41 = 8 THEN 0 ELSE num_edits END AS num_edits,
                 num_tracks + CASE WHEN pid % 43 = 9 THEN 1 ELSE 0 END AS num_tracks,
                 num_artists + CASE WHEN pid % 43 = 10 THEN 1 ELSE 0 END AS num_artists,
                 num_albums + CASE WHEN pid % 43 = 11 THEN 2 ELSE 0 END AS num_albums,
                 duration_ms - CASE WHEN pid % 43 = 12 THEN 1000 ELSE 0 END AS duration_ms,
                 CASE WHEN pid % 47 = 13 THEN {CUTOFF_EPOCH_S + 1} ELSE modified_at END AS modified_at
          FROM playlists WHERE pid % 29 <> 3)
, dplaylists AS (SELECT * FROM _dp UNION ALL SELECT * FROM _dp WHERE pid % 31 = 4)
, dtracks AS (SELECT pid, pos AS idx, CASE WHEN pid % 19 = 2 AND pos < 2 THEN 1 - pos ELSE pos END AS pos,
                     CASE WHEN pid % 23 = 1 AND pos = 2 THEN 'x:' || track_uri WHEN pid % 23 = 2 AND pos = 2 THEN NULL ELSE track_uri END AS track_uri,
                     CASE WHEN pid % 23 = 3 AND pos = 2 THEN 'x:' || album_uri ELSE album_uri END AS album_uri,
                     CASE WHEN pid % 23 = 4 AND pos = 2 THEN 'x:' || artist_uri ELSE artist_uri END AS artist_uri,
                     CASE WHEN pid % 17 = 5 AND pos = 3 THEN artist_name || ' (live)' ELSE artist_name END AS artist_name,
                     CASE WHEN pid % 17 = 6 AND pos = 3 THEN album_name || ' (live)' ELSE album_name END AS album_name,
                     CASE WHEN pid % 17 = 7 AND pos = 3 THEN track_name || ' (live)' ELSE track_name END AS track_name, track_dur_ms
              FROM tracks WHERE pid % 29 <> 3 AND (pid % 53 <> 14 OR pos < 3))
"""
