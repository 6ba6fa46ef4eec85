"""Incremental ingest: keyed state, restarts and replayed batches."""

import json
import os
import tempfile

import pytest

from cadence.sources import slices as SL
from cadence.streaming.catalog import STATE_PROVIDER, read_appended, read_catalog, running_totals, stream_ingest


def entry(pos, uri, name="n"):
    return {"pos": pos, "artist_name": "a", "track_uri": uri, "artist_uri": "spotify:artist:1", "track_name": name,
            "album_uri": "spotify:album:1", "duration_ms": 1000, "album_name": "b"}


def write(folder, k, uris):
    p = {"name": f"p{k}", "collaborative": "false", "pid": k, "modified_at": 0, "num_tracks": len(uris), "num_albums": 1, "num_followers": 1,
         "num_edits": 1, "duration_ms": 1, "num_artists": 1, "tracks": [entry(i, u, f"{k}.{i}") for i, u in enumerate(uris)]}
    bare = {**p, "pid": 1000 + k, "tracks": None}
    path = os.path.join(folder, f"mpd.slice.{k}-{k}.json")
    with open(path, "w") as f:
        json.dump({"info": {"slice": f"{k}-{k}", "version": "v1", "generated_on": "x"}, "playlists": [bare, p]}, f)
    os.utime(path, (1_000_000 + k, 1_000_000 + k))


FILES = [["u1", "u2", "u1"], ["u2", "u3", None], ["u1", "u4", "u3"], ["u5", None, "u1"], ["u6", "u2"]]


@pytest.fixture
def folders():
    return [tempfile.mkdtemp(prefix=f"cadence-stream-{n}-") for n in ("src", "out", "ck")]


def run(spark, src, out, ck):
    q = stream_ingest(spark, src, out, ck, files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    return q


def catalog(spark, out):
    return sorted(((r["track_uri"], r["track_name"]) for r in read_catalog(spark, out).collect()), key=repr)


WHOLE = sorted([("u1", "0.0"), ("u2", "0.1"), ("u3", "1.1"), (None, "1.2"), ("u4", "2.1"), ("u5", "3.0"), ("u6", "4.0")], key=repr)


def test_each_uri_once_from_its_first_batch(spark, folders):
    src, out, ck = folders
    for k, uris in enumerate(FILES):
        write(src, k, uris)
    before = spark.conf.get(STATE_PROVIDER, None)
    q = run(spark, src, out, ck)
    assert catalog(spark, out) == WHOLE
    assert spark.conf.get(STATE_PROVIDER, None) == before
    state = [p.stateOperators[0] for p in q.recentProgress if p.stateOperators]
    assert state[-1].numRowsTotal == 7 and any("rocksdb" in k.lower() for k in state[-1].customMetrics)
    assert read_appended(spark, out, "tracks").count() == sum(map(len, FILES))
    assert read_appended(spark, out, "playlists").count() == 2 * len(FILES)
    totals = [tuple(r) for r in running_totals(spark, out).orderBy("batch_id").collect()]
    # unique_tracks counts catalogue rows, the null URI among them
    assert totals == [(0, 2, 3, 2), (1, 4, 6, 4), (2, 6, 9, 5), (3, 8, 12, 6), (4, 10, 14, 7)]


def test_restart_reads_no_earlier_catalogue(spark, folders):
    src, out, ck = folders
    for k, uris in enumerate(FILES[:3]):
        write(src, k, uris)
    run(spark, src, out, ck)
    for k, uris in enumerate(FILES[3:], 3):
        write(src, k, uris)
    elsewhere = out + "-later"  # the earlier output is not there
    run(spark, src, elsewhere, ck)
    assert catalog(spark, elsewhere) == sorted([("u5", "3.0"), ("u6", "4.0")], key=repr)
    assert sorted(catalog(spark, out) + catalog(spark, elsewhere), key=repr) == WHOLE


def test_a_replayed_batch_writes_the_same_output(spark, folders):
    src, out, ck = folders
    for k, uris in enumerate(FILES[:3]):
        write(src, k, uris)
    run(spark, src, out, ck)
    first = catalog(spark, out)
    for name in ("2", ".2.crc"):  # batch 2 was written, but its commit is lost
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    write(src, 3, FILES[3])
    run(spark, src, out, ck)
    assert [r for r in catalog(spark, out) if r[0] not in ("u5",)] == first
    assert sorted(int(p.split("=")[1]) for p in os.listdir(f"{out}/catalog")) == [0, 1, 2, 3]
    write(src, 4, FILES[4])
    run(spark, src, out, ck)
    assert catalog(spark, out) == WHOLE
    batch = SL.slice_catalog(SL.read_slices(spark, src))
    assert batch.count() == len(WHOLE)


def test_state_has_a_partition_for_each_core(spark, folders):
    src, out, ck = folders
    for k, uris in enumerate(FILES[:2]):
        write(src, k, uris)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        q = run(spark, src, out, ck)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {p.stateOperators[0].numShufflePartitions for p in q.recentProgress if p.stateOperators} == {4}
    assert read_appended(spark, out, "tracks").count() == 6


def test_many_files_take_few_batches(spark, monkeypatch):
    from cadence.plans import common as C
    from cadence.plans import q_ingest as QI
    src = tempfile.mkdtemp(prefix="cadence-stream-many-")
    for k in range(9):
        os.makedirs(f"{src}/slice={k}-{k}")
        write(src, k, [f"u{k}", "u0"])
        os.rename(f"{src}/mpd.slice.{k}-{k}.json", f"{src}/slice={k}-{k}/part-{k}")
    monkeypatch.setattr(QI, "slices_dir", lambda s, d: src)
    monkeypatch.setattr(QI, "MOST_BATCHES", 3)
    out = QI.stream_out(spark, src)
    assert len(os.listdir(f"{out}/totals")) == 3
    assert read_appended(spark, out, "tracks").count() == 18
    assert read_catalog(spark, out).count() == 9
    C._MEMO.clear()


def test_batches_keep_the_cores_busy():
    """A few large batches on a small input, MOST_BATCHES at most on a large one."""
    from cadence.plans import q_ingest as QI
    for files, cores, batches in ((2, 12, 1), (60, 12, 4), (360, 12, 8), (3600, 12, 32), (360, 4, 23), (36000, 12, 32)):
        assert -(-files // QI.batch_files(files, cores)) == batches
