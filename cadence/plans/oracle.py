"""DuckDB SQL mirror of the canonical tables (see cadence.sources.fixtures).

Every oracle query is ``PRELUDE`` followed by its own CTEs and SELECT; the
driver's views (lineitem, orders, part, customer, embeddings, ...) are the
only inputs.
"""

from cadence.sources.fixtures import N_FEATURES, TITLES

_titles = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TITLES))
_feat = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(N_FEATURES))

PRELUDE = f"""
WITH
_titles(t_idx, title) AS (VALUES {_titles}),
entries_wide AS (
  SELECT o.o_custkey AS pid,
         CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, l.l_orderkey,
              l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) - 1 AS BIGINT) AS pos,
         l.l_partkey AS item, l.l_orderkey AS order_key, o.o_orderdate AS order_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
entries AS (SELECT pid, pos, item FROM entries_wide),
tracks AS (
  SELECT e.pid, e.pos, 'spotify:track:' || CAST(e.item AS VARCHAR) AS track_uri,
         p.p_name AS track_name, 'spotify:artist:' || p.p_brand AS artist_uri,
         p.p_brand AS artist_name, 'spotify:album:' || p.p_brand || ' ' || p.p_type AS album_uri,
         p.p_brand || ' ' || p.p_type AS album_name,
         CAST(120000 + 1000 * p.p_size AS BIGINT) AS track_dur_ms
  FROM entries e JOIN part p ON e.item = p.p_partkey),
playlists AS (
  SELECT c.c_custkey AS pid, t.title AS name, a.num_tracks, a.num_artists, a.num_albums,
         CAST(c.c_nationkey + 1 AS BIGINT) AS num_followers, b.num_edits, a.duration_ms,
         CAST(epoch(b.last_ts) AS BIGINT) AS modified_at,
         CASE WHEN c.c_custkey % 50 = 0 THEN 'true' ELSE 'false' END AS collaborative,
         (c.c_custkey % 53 = 0) AS has_desc,
         CASE WHEN c.c_custkey % 53 = 0 THEN 'songs for ' || c.c_name ELSE '' END AS description
  FROM customer c
  JOIN (SELECT pid, CAST(count(*) AS BIGINT) AS num_tracks,
               CAST(count(DISTINCT artist_uri) AS BIGINT) AS num_artists,
               CAST(count(DISTINCT album_uri) AS BIGINT) AS num_albums,
               CAST(sum(track_dur_ms) AS BIGINT) AS duration_ms
        FROM tracks GROUP BY pid) a ON a.pid = c.c_custkey
  JOIN (SELECT pid, CAST(count(DISTINCT order_key) AS BIGINT) AS num_edits, max(order_ts) AS last_ts
        FROM entries_wide GROUP BY pid) b ON b.pid = c.c_custkey
  JOIN _titles t ON t.t_idx = c.c_custkey % {len(TITLES)}),
playlist_genres AS (SELECT c_custkey AS pid, c_mktsegment AS genre FROM customer),
features AS (SELECT vec_id AS item, {_feat} FROM embeddings),
external_features AS (
  SELECT e.vec_id AS row_id,
         CASE WHEN e.vec_id % 7 = 3 THEN 'Various Artists'
              ELSE upper(p.p_brand) || CASE WHEN e.vec_id % 4 = 1 THEN ' (feat. X)' ELSE '' END END
           AS artist_name,
         CASE WHEN e.vec_id % 11 = 5 THEN NULL
              WHEN e.vec_id % 3 = 0 THEN upper(p.p_name)
              WHEN e.vec_id % 3 = 1 THEN p.p_name || ' [Remix]'
              ELSE p.p_name || '!!' END AS track_name,
         {", ".join(f"CAST(e.embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(N_FEATURES))}
  FROM embeddings e JOIN part p ON e.vec_id = p.p_partkey)
"""


def sql(body: str) -> str:
    """``body`` is either ', name AS (...) ... SELECT ...' or 'SELECT ...'."""
    body = body.strip()
    sep = "\n" if body.startswith(",") else "\n"
    return PRELUDE.rstrip() + sep + body
