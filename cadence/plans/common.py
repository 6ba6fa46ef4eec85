"""Shared Spark pipelines and their SQL mirrors used by several queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import sequences as S
from cadence.sources.fixtures import stage, tables
from cadence.session import MEMOS, session_key

_MEMO: dict = {}
MEMOS.append(_MEMO)


def memo(spark, sf_dir, name, build, staged=False):
    """One stage table per (session, data dir, stage name); ``staged``: ``build`` writes it."""
    key = (session_key(spark), sf_dir, name)
    if key not in _MEMO:
        _MEMO[key] = build() if staged else stage(build(), name)
    return _MEMO[key]


MIN_LEN = 5
VOCAB_LIMIT = 1000       # vocabulary cut-off of the training frames (next_item_frames); no model uses one
SEED = 42
KS = (1, 5, 10, 20)
URI_SKIP = len("spotify:track:")


def corpus(spark, sf_dir):
    t = tables(spark, sf_dir)
    return memo(spark, sf_dir, "corpus", lambda: S.build_corpus(
        t.tracks().select("pid", "pos", "track_uri"), MIN_LEN))


def vocab(spark, sf_dir):
    return memo(spark, sf_dir, "vocab", lambda: S.vocabulary(
        corpus(spark, sf_dir), "track_uri", skip_prefix=URI_SKIP, stage=lambda df: stage(df, "item_counts")))


def encoded(spark, sf_dir):
    return memo(spark, sf_dir, "encoded", lambda: S.encode(corpus(spark, sf_dir), vocab(spark, sf_dir)))


def groups_split(spark, sf_dir):
    def build():
        g = S.group_sizes(corpus(spark, sf_dir))
        b = S.length_bins(g, "seq_len", 10)
        return S.stratified_split(b, "length_bin", 0.1, 0.1, SEED)
    return memo(spark, sf_dir, "groups_split", build)


def split_seqs(spark, sf_dir, which: str):
    e = encoded(spark, sf_dir)
    g = groups_split(spark, sf_dir).where(F.col("split") == which).select("pid")
    return e.join(g, "pid", "left_semi")


def split_groups(spark, sf_dir, which: str):
    return groups_split(spark, sf_dir).where(F.col("split") == which).select("pid", "seq_len")


#: The ingest and preprocess job, stage by stage; each output is a written table that later plans start from.
STAGES = {"tracks": lambda s, d: tables(s, d).tracks(), "playlists": lambda s, d: tables(s, d).playlists(),
          "corpus": corpus, "vocabulary": vocab, "encoded": encoded, "split": groups_split}


# ---- SQL mirrors ------------------------------------------------------------
CORPUS_CTE = """
, _sz AS (SELECT pid, CAST(count(*) AS BIGINT) AS seq_len FROM tracks GROUP BY pid)
, corpus AS (SELECT t.pid, t.pos, t.track_uri, s.seq_len FROM tracks t JOIN _sz s USING (pid)
             WHERE s.seq_len >= 5)
"""
VOCAB_CTE = CORPUS_CTE + """
, _freq AS (SELECT track_uri, CAST(count(*) AS BIGINT) AS corpus_freq FROM corpus GROUP BY track_uri)
, vocab AS (SELECT track_uri,
                   CAST(row_number() OVER (ORDER BY corpus_freq DESC, track_uri) - 1 AS BIGINT) AS corpus_idx,
                   corpus_freq FROM _freq)
"""
ENC_CTE = VOCAB_CTE + """
, enc AS (SELECT c.pid, c.pos, CAST(v.corpus_idx AS INTEGER) AS track_idx, c.seq_len
          FROM corpus c JOIN vocab v USING (track_uri))
"""
SPLIT_CTE = ENC_CTE + """
, _groups AS (SELECT DISTINCT pid, seq_len FROM corpus)
, _edges AS (SELECT DISTINCT unnest(quantile_cont(CAST(seq_len AS DOUBLE),
               [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM _groups)
, bins AS (SELECT g.pid, g.seq_len,
                  CAST(greatest((SELECT count(*) FROM _edges WHERE e < g.seq_len) - 1, 0) AS INTEGER)
                    AS length_bin FROM _groups g)
, _ranked AS (SELECT b.*, row_number() OVER (PARTITION BY length_bin
                  ORDER BY md5('42|' || CAST(pid AS VARCHAR)), pid) - 1 AS _rk,
                  count(*) OVER (PARTITION BY length_bin) AS _n FROM bins b)
, gsplit AS (SELECT pid, seq_len, length_bin,
               CASE WHEN _rk < greatest(1, round_even(_n * 0.1::DOUBLE, 0)) THEN 'test'
                    WHEN _rk < greatest(1, round_even(_n * 0.1::DOUBLE, 0))
                             + greatest(1, round_even(_n * 0.1::DOUBLE, 0)) THEN 'val'
                    ELSE 'train' END AS split FROM _ranked)
, train AS (SELECT e.* FROM enc e JOIN gsplit s USING (pid) WHERE s.split = 'train')
, test AS (SELECT e.* FROM enc e JOIN gsplit s USING (pid) WHERE s.split = 'test')
, test_groups AS (SELECT pid, seq_len FROM gsplit WHERE split = 'test')
"""


def seed_holdout_cte(src: str = "test", groups: str = "test_groups", rule: str = "sequence",
                     vocab_limit: int | None = None, max_seed: int | None = None,
                     item: str = "track_idx") -> str:
    """SQL for seeds / holdout / evaluated groups (names: seeds, holdout, evaluated)."""
    sp = "greatest(1, CAST(floor(seq_len * 0.8::DOUBLE) AS BIGINT))"
    skip = f"{sp} >= seq_len - 1" if rule == "sequence" else "seq_len < 5"
    mapped = (f"CAST(CASE WHEN {item} < {vocab_limit} THEN {item} ELSE {vocab_limit + 1} END AS INTEGER)"
              if vocab_limit is not None else item)
    hold_filter = f"AND {item} <> {vocab_limit + 1}" if vocab_limit is not None else ""
    seed_filter = f"AND s.pos >= g.sp - {max_seed}" if max_seed is not None else ""
    return f"""
, _g AS (SELECT pid, seq_len, {sp} AS sp FROM {groups} WHERE NOT ({skip}))
, _s AS (SELECT x.pid, x.pos, {mapped} AS {item}, g.sp
         FROM {src} x JOIN _g g USING (pid))
, holdout AS (SELECT DISTINCT pid, {item} FROM _s WHERE pos >= sp {hold_filter})
, _nh AS (SELECT pid, CAST(count(*) AS BIGINT) AS n_holdout FROM holdout GROUP BY pid)
, _nx AS (SELECT pid, {item} AS next_item FROM _s WHERE pos = sp)
, evaluated AS (SELECT g.pid, g.seq_len, g.sp, h.n_holdout, x.next_item
                FROM _g g JOIN _nh h USING (pid) LEFT JOIN _nx x USING (pid))
, seeds AS (SELECT s.pid, s.pos, s.{item} FROM _s s JOIN evaluated g USING (pid)
            WHERE s.pos < g.sp {seed_filter})
"""


def staged_split(spark, sf_dir, name, build):
    """Memoize a tuple of DataFrames (e.g. seeds, holdout, evaluated) as stages."""
    key = (session_key(spark), sf_dir, name + "#tuple")
    if key not in _MEMO:
        parts = build()
        _MEMO[key] = tuple(stage(df, f"{name}.{i}") for i, df in enumerate(parts))
    return _MEMO[key]
