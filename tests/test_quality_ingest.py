import json
import os
import tempfile

from pyspark.sql import functions as F

from cadence.operators import quality as Q
from cadence.sources import slices as SL


def _track(pos, uri="spotify:track:1", artist="spotify:artist:a", album="spotify:album:x", name="n"):
    return {"pos": pos, "artist_name": "A" + artist[-1], "track_uri": uri, "artist_uri": artist,
            "track_name": name, "album_uri": album, "duration_ms": 1000, "album_name": "Al" + album[-1]}


def _playlist(pid, n=5, **over):
    tr = [_track(i, uri=f"spotify:track:{pid}{i}", artist=f"spotify:artist:{i % 3}", album=f"spotify:album:{i % 2}")
          for i in range(n)]
    p = {"name": f"p{pid}", "collaborative": "false", "pid": pid, "modified_at": 1500000000,
         "num_tracks": n, "num_albums": 2, "num_followers": 1, "num_edits": 2, "duration_ms": 1000 * n,
         "num_artists": 3, "tracks": tr}
    p.update(over)
    return p


def _write(d, name, playlists, info=None):
    doc = {"info": info or {"generated_on": "x", "slice": "0-1", "version": "v1"}, "playlists": playlists}
    with open(os.path.join(d, name), "w") as f:
        json.dump(doc, f)


def test_rules_fire_once_each(spark):
    d = tempfile.mkdtemp(prefix="cadence-test-slices-")
    _write(d, "mpd.slice.0-9.json", [_playlist(0), _playlist(1)])  # clean
    bad = _playlist(3, num_followers=0)
    bad2 = _playlist(4)
    bad2["tracks"][2]["pos"] = 9
    bad3 = _playlist(5, extra_key=1)
    _write(d, "mpd.slice.10-19.json", [bad, bad2, bad3, _playlist(6, n=4, num_tracks=4, duration_ms=4000)],
           info={"generated_on": "x", "slice": "1", "version": "v1", "extra": 1})
    s = SL.read_slices(spark, d)
    pls, trs = SL.slice_playlists(s), SL.slice_tracks(s)
    rules = {r["rule"]: r["n"] for r in Q.summary(Q.playlist_rules(pls, trs)).collect()}
    assert rules == {"too_few_followers": 1, "too_few_tracks": 1}
    assert {r["rule"] for r in Q.track_rules(SL.slice_tracks(s, with_index=True), "idx").collect()} == {"out_of_order"}
    assert Q.reconcile(pls, trs).count() == 0
    p_txt, t_txt, i_txt = SL.read_slice_text(spark, d)
    v = Q.key_rules(p_txt, "_json", Q.PLAYLIST_FIELDS, Q.OPTIONAL_PLAYLIST_FIELDS, "").collect()
    assert [(r["rule"], r["detail"]) for r in v] == [("extra_field", "extra_key")]
    vi = Q.key_rules(i_txt, "_json", Q.INFO_FIELDS, [], "info_").collect()
    assert [(r["rule"], r["detail"]) for r in vi] == [("extra_info_field", "extra")]
    assert sorted(r["pid"] for r in Q.missing_ids(pls, "pid").collect()) == [2]
    assert pls.where("pid = 0").first()["has_desc"] is False


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="cadence-test-stream-")
    shared = _track(0, uri="spotify:track:shared")
    for k in range(3):
        p = _playlist(k)
        p["tracks"][0] = dict(shared)
        _write(d, f"mpd.slice.{k}-{k}.json", [p])
    from cadence.streaming.catalog import read_appended, read_catalog, running_totals, stream_ingest
    out = tempfile.mkdtemp(prefix="cadence-test-out-")
    q = stream_ingest(spark, d, out + "/o", out + "/ck", files_per_trigger=1)
    q.awaitTermination()
    batch = SL.slice_catalog(SL.read_slices(spark, d))
    got = read_catalog(spark, out + "/o")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(got.columns).collect()))
    assert read_appended(spark, out + "/o", "playlists").count() == 3 and read_appended(spark, out + "/o", "tracks").count() == 15
    last = running_totals(spark, out + "/o").orderBy(F.col("batch_id").desc()).first()
    assert (last["playlists"], last["entries"], last["unique_tracks"]) == (3, 15, batch.count())


def test_exchanged_entries_and_nulls_are_reported(spark):
    d = tempfile.mkdtemp(prefix="cadence-test-order-")
    p = _playlist(0)
    p["tracks"][0], p["tracks"][1] = p["tracks"][1], p["tracks"][0]  # stored with positions 1, 0, 2, ...
    p["tracks"][3]["track_uri"] = None
    p["name"] = None
    _write(d, "mpd.slice.0-9.json", [p])
    s = SL.read_slices(spark, d)
    got = sorted((r["rule"], r["pos"]) for r in Q.track_rules(SL.slice_tracks(s, with_index=True), "idx").collect())
    assert got == [("invalid_track_uri", 3), ("out_of_order", 0), ("out_of_order", 1)]
    assert [r["rule"] for r in Q.playlist_rules(SL.slice_playlists(s), SL.slice_tracks(s)).collect()] == ["empty_name"]


def test_two_data_folders_in_one_session(spark):
    """Files written for one folder are not read for another, and earlier handles stay good."""
    import duckdb

    import __spark_entry__ as E
    qs, ors, kept = E.queries(), E.oracle_sql(), {}
    for sf in ("sf0.001", "sf0.01", "sf0.001"):
        con = duckdb.connect()
        for t in ("lineitem", "orders", "part", "customer", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
        for n in ("ingest_playlists", "csv_features", "stream_catalog"):
            df = qs[n](spark, f"/root/testdata/{sf}")
            want = con.execute(f"SELECT count(*) FROM ({ors[n]})").fetchone()[0]
            assert df.count() == want
            for old, rows in kept.get(n, []):
                assert old.count() == rows
            kept.setdefault(n, []).append((df, want))


def test_slices_are_shuffled_once_and_gzipped(spark):
    """Playlists that come twice, entries without a playlist, playlists without entries."""
    import glob
    import gzip
    import json
    d = tempfile.mkdtemp(prefix="cadence-test-once-") + "/s"
    pl = spark.createDataFrame([(p, f"n{p}", "false", 0, 1, 1, 1, 1, 1, 1, p % 2 == 0, "d") for p in (1, 1, 2, 251, 600)],
                               "pid long, name string, collaborative string, modified_at long, num_tracks long, num_albums long, num_followers long, num_edits long, duration_ms long, num_artists long, has_desc boolean, description string")
    tr = spark.createDataFrame([(p, i, "a", f"u{i}", "x", "t", "y", 5, "b") for p in (1, 2, 251, 300) for i in (1, 0)],
                               "pid long, pos long, artist_name string, track_uri string, artist_uri string, track_name string, album_uri string, track_dur_ms long, album_name string")
    SL.write_slices(pl, tr, d, 250)
    files = glob.glob(f"{d}/slice=*/part-*")
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    with gzip.open(next(f for f in files if "slice=0-249" in f), "rt") as f:
        doc = json.loads(f.read())
    assert doc["info"]["slice"] == "0-249" and [p["pid"] for p in doc["playlists"]] == [1, 1, 2]
    assert [[t["pos"] for t in p["tracks"]] for p in doc["playlists"]] == [[0, 1]] * 3
    assert ["description" in p for p in doc["playlists"]] == [False, False, True]
    s = SL.read_slices(spark, d, pattern=SL.WRITTEN_PATTERN)
    assert sorted((r["pid"], r["pos"]) for r in SL.slice_tracks(s).collect()) == sorted([(p, i) for p in (1, 1, 2, 251) for i in (0, 1)])
    assert sorted(r["pid"] for r in SL.slice_playlists(s).collect()) == [1, 1, 2, 251, 600]
    assert sum(p.count() for p in SL.read_slice_text(spark, d, pattern=SL.WRITTEN_PATTERN)) == 5 + 8 + 3
