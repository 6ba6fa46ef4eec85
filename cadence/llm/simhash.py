"""SimHash fingerprints and near-duplicate groups by tiled exact comparison.

1. Every text gets a 64-bit fingerprint: the majority, bit by bit, of the
   XXH64 values (seed 42) of its word shingles.
2. Equal fingerprints are one class; only distinct fingerprints are compared.
3. The classes are dealt to tasks by blocks of bits.  The 64 bits are cut into
   ``radius`` + 1 blocks; two fingerprints that differ in at most ``radius``
   bits agree in at least one block, so classes that agree in a block meet
   there, and no link is lost.
4. Inside a block value, classes stand in the order of their population counts
   and are compared tile by tile with numpy (exclusive or, bit count).  A pair
   of tiles is skipped when their population counts differ beyond the radius.
   A block value with more classes than ``tile_rows`` is cut into tiles by
   population count and hash, and its tile pairs go to different tasks.
5. A task hands on a spanning forest of the links it finds (at most one link a
   class), which keeps every class reachable that the links reach; connected
   components of the forests are found by alternating star contractions.

Edge cases: a null or empty text, or one of white space only, has fingerprint
zero and is linked like any other; fewer words than a shingle make one shingle;
repeated rows stay, each with the group of its fingerprint; a row with a null
id is kept, links others, and is never the smallest id of a group (its
``component_id`` is null only if no row of the group has an id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.store import delete, written

SEED = 42


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """The fingerprint of a text as a signed 64-bit integer."""
    import xxhash

    line = b" ".join((text or "").encode().lower().split())
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    if len(gaps) < words_per_shingle:
        starts, ends = [0], [len(line)]
    else:
        starts, ends = [0, *(g + 1 for g in gaps)], [*gaps[words_per_shingle - 1:], len(line)]
    digest, set_bits = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(ends), 1 << 16):
        h = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[i: i + (1 << 16)], ends[i: i + (1 << 16)], strict=False)])
        set_bits += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(ends)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, words_per_shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp`` (long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words_per_shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, fp long")


def forest(fps: np.ndarray, radius: int, tile: int = 1024, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``fps`` (or between ``fps`` and ``other``)."""
    def ordered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pc = np.bitwise_count(x.view(np.uint64)).astype(np.int16)
        o = np.argsort(pc, kind="stable")
        return x[o], pc[o]

    a, pa_ = ordered(fps)
    b, pb = (a, pa_) if other is None else ordered(other)
    n = len(a)
    root = np.arange(n + (0 if other is None else len(b)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def roots(i: np.ndarray) -> np.ndarray:
        while True:
            up = root[i]
            if (up == i).all():
                return i
            i = up

    out, ua, ub = [], a.view(np.uint64), b.view(np.uint64)
    for i in range(0, n, tile):
        last_a = pa_[min(i + tile, n) - 1]
        for j in range(i if other is None else 0, len(b), tile):
            if pb[j] - last_a > radius:
                break
            if pa_[i] - pb[min(j + tile, len(b)) - 1] > radius:
                continue
            near = np.bitwise_count(ua[i: i + tile, None] ^ ub[None, j: j + tile]) <= radius
            if other is None and i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            p, q = i + x, j + y
            at = q if other is None else n + q
            while len(p):  # one link of each tree at a time; links inside a tree are dropped together
                r, s = roots(p), roots(at)
                apart = r != s
                p, q, at, r = p[apart], q[apart], at[apart], r[apart]
                for k in np.unique(r, return_index=True)[1].tolist():
                    u, v = find(p[k]), find(at[k])
                    if u != v:
                        root[v] = u
                        out.append((int(a[p[k]]), int(b[q[k]])))
    return out


def links(classes: DataFrame, *, radius: int, tile_rows: int) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` of ``classes``."""
    bounds = [64 * k // (radius + 1) for k in range(radius + 2)]
    block = F.array(*[F.struct(F.lit(k).alias("blk"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << hi - lo) - 1)).alias("val"))
                      for k, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False))])
    rows = classes.select("fp", F.bit_count("fp").alias("pc"), F.explode(block).alias("k")).select("k.blk", "k.val", "pc", "fp")
    sizes = written(rows.groupBy("blk", "val", "pc").agg(F.count("*").alias("n")), "simhash-sizes")
    hot = sizes.groupBy("blk", "val").agg(F.sum("n").alias("n")).filter(F.col("n") > tile_rows).select("blk", "val")

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, held = None, []

        def close() -> list:
            fps = np.concatenate(held) if held else np.empty(0, np.int64)
            return forest(fps, radius) if len(fps) > 1 else []

        for pdf in batches:
            out = []
            key, fp = pdf[["blk", "val"]].to_numpy(), pdf["fp"].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(fp)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if keys != tuple(key[s]):
                    out += close()
                    keys, held = tuple(key[s]), []
                held.append(fp[s:e])
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(close(), columns=["a", "b"], dtype="int64")

    found = rows.join(hot, ["blk", "val"], "left_anti").repartition("blk", "val").sortWithinPartitions("blk", "val").mapInPandas(inside, "a long, b long")
    if hot.isEmpty():
        return found

    # Hot block values: tiles by population count and hash; each pair of tiles within the radius is a task's work.
    parts = sizes.join(hot, ["blk", "val"]).withColumn("m", F.ceil(F.col("n") / tile_rows).cast("int"))
    tiles = parts.select("blk", "val", "pc", "m", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("s"))
    left, right = tiles.select("blk", "val", F.col("pc").alias("p1"), F.col("s").alias("s1")), tiles.select("blk", "val", F.col("pc").alias("p2"), F.col("s").alias("s2"))
    order = F.struct("p1", "s1") <= F.struct("p2", "s2")
    pairs = written(left.join(right, ["blk", "val"]).filter(order & (F.col("p2") - F.col("p1") <= radius)).withColumn(
        "pair", F.concat_ws(":", "blk", "val", "p1", "s1", "p2", "s2")), "simhash-tile-pairs")
    dealt = rows.join(parts.select("blk", "val", "pc", "m"), ["blk", "val", "pc"]).withColumn("s", F.pmod(F.hash("fp"), F.col("m")))
    sides = [dealt.join(pairs.select("blk", "val", F.col(p).alias("pc"), F.col(s).alias("s"), "pair", F.lit(k).alias("side")), ["blk", "val", "pc", "s"])
             for k, p, s in ((0, "p1", "s1"), (1, "p2", "s2"))]
    sides[1] = sides[1].filter(~F.col("pair").rlike(r"^\d+:\d+:(\d+:\d+):\1$"))  # a tile against itself is read once

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = (pdf["fp"].to_numpy()[pdf["side"].to_numpy() == k] for k in (0, 1))
        return pd.DataFrame(forest(a, radius) if not len(b) else forest(a, radius, other=b), columns=["a", "b"], dtype="int64")

    return found.unionByName(sides[0].unionByName(sides[1]).select("pair", "side", "fp").groupBy("pair").applyInPandas(across, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges`` (a, b: long), by alternating star contractions.

    Each round keeps at most as many edges as before; the state between rounds
    is a written table, and only its row count and a checksum reach the driver."""
    cur = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "components")
    seen = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b") \
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        new = written(small, "components")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        delete(cur.sparkSession, cur)
        cur = new
        if state == seen:
            break
        seen = state
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, *, words_per_shingle: int = 4, radius: int = 4, tile_rows: int = 16_384,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id reachable over links) of every row."""
    fps = written(fingerprints(docs, words_per_shingle=words_per_shingle, id_col=id_col, text_col=text_col), "simhash-fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = components(links(classes, radius=radius, tile_rows=tile_rows))
    member = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = member.join(least, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, *, words_per_shingle: int = 4, radius: int = 4, tile_rows: int = 16_384) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with the columns it came with: the row with the smallest id; of several
    rows of that id in the group, the one first by a hash of its columns.  Rows without an id come last, so one of them stays
    only where no row of the group has an id.  Rows of one id that lie in different groups are judged with their groups."""
    # The rows are numbered once and for all in a written table: a row is chosen by its number, whatever else repeats.
    numbered = written(docs.withColumn("__fp", _fp_udf(words_per_shingle)("text")).withColumn("__row", F.monotonically_increasing_id()), "simhash-documents")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(*docs.columns).alias("hash"), F.col("__row").alias("row"))
    classes = written(numbered.select(F.col("__fp").alias("fp"), order.alias("o")).groupBy("fp").agg(F.min("o").alias("best")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius=radius, tile_rows=tile_rows))
    member = classes.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "best")
    chosen = member.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("__chosen"))
    return numbered.join(chosen, F.col("__row") == F.col("__chosen"), "left_semi").select(*docs.columns)


def _fp_udf(words_per_shingle: int):
    return F.pandas_udf(lambda s: s.map(lambda t: fingerprint(t, words_per_shingle)).astype("int64"), "long")
