"""Ranked lexical search by Block-Max MaxScore over a segmented inverted index.

Index (``build_index``, one narrow pass, a written table): every task cuts its
documents into segments of bounded size and writes, per segment, one row with
the ids and lengths of its documents and one row per term.  A term's postings
(place of the document in the segment, occurrences) lie in blocks of ``BLOCK``,
coded as gaps in the fewest whole bytes.  Each block carries its first and last
place and its undominated (occurrences, length) pairs, from which the largest
score it can add follows exactly for any corpus totals.  So the index does not
depend on the totals, and a segment never changes once written.

Search (``search``): items are dealt to blocks of about ``items_per_block``; the
index rows of the terms of a block meet its header rows in one group per
(segment, block of items), and there each item is evaluated:

* lists in descending order of their bound; while the bounds from here on reach
  the k-th best score so far, a list is essential and its postings are added up;
* the lists left cannot lift a document that no essential list holds.  For the
  documents found, the block maxima of those lists bound the score; only blocks
  with a document whose bound still reaches the k-th best are decompressed.

Each group yields the k best of an item in its segment; these heaps are merged by
a top-k per item, which Spark cuts per partition before its shuffle.

Scores are integers: term weight floor(1000 ln((2N+2)/(2df+1))) times
(1000000000 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L.

Edge cases: null and empty texts have no terms and are never found; an item
without terms, or with none that a document holds, has no rows; rows of one
item_id (null is one) are one item with the union of their terms; repeated
documents are ranked one by one, null ids last among equal scores; empty tables
give no rows; a text of any length lies in one segment whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.store import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes outside terms become spaces, A-Z become a-z; bytes of characters beyond ASCII stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
BLOCK = 128
#: A header row has no term; its df counts the documents, size their terms; missing marks null ids.
INDEX = "segment long, term string, df long, size long, doc_ids binary, missing binary, lengths binary, meta binary, pairs binary, data binary"
#: Columns of a block's meta row: first and last place, postings, bytes a gap, bytes a count, first byte in data, first pair in pairs.
FIRST, LAST, COUNT, GAP_BYTES, TF_BYTES, OFFSET, PAIR, META = range(8)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _spans(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for each count, end to end."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _bytes_of(values: np.ndarray, widths: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Write each value little-endian in its width from byte ``at`` of ``out``."""
    for b in range(4):
        some = widths > b
        out[at[some] + b] = (values[some] >> (8 * b)) & 255


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """Slices of ``data`` that end at ``ends`` as a binary column."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _segment(number: int, names: list[bytes], codes: np.ndarray, places: np.ndarray, doc_ids: list, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The header row of a segment and the rows of its terms."""
    order, tf = np.unique((codes.astype(np.int64) << 32) | places, return_counts=True)
    code, place = order >> 32, order & 0xFFFFFFFF
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])  # of each term
    df = np.diff(np.r_[start, len(code)])
    rank = _spans(df)
    first = np.flatnonzero(rank % BLOCK == 0)  # of each block
    count = np.diff(np.r_[first, len(code)])
    block = np.repeat(np.arange(len(first)), count)
    gap = np.diff(place, prepend=0)
    gap[first] = 0

    def width(x: np.ndarray) -> np.ndarray:
        top = np.maximum.reduceat(x, first)
        return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))

    gap_bytes, tf_bytes = width(gap), width(tf)
    size = count * (gap_bytes + tf_bytes)
    offset = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    within = _spans(count)
    _bytes_of(gap, gap_bytes[block], offset[block] + within * gap_bytes[block], data)
    _bytes_of(tf, tf_bytes[block], (offset + count * gap_bytes)[block] + within * tf_bytes[block], data)
    # Undominated pairs: more occurrences than all postings of the block in documents of that length or shorter.
    n = lengths[place]
    by = np.lexsort((n, -tf, block))
    low = n[by] - block[by] * (int(lengths.max()) + 1)  # falls from block to block, so the running minimum starts anew in each
    best = np.minimum.accumulate(low)
    keep = by[np.r_[True, low[1:] < best[:-1]]]
    pairs = np.stack([tf[keep], n[keep]], 1).astype("<i8")
    in_block = np.bincount(block[keep], minlength=len(first))

    term_of_block = np.repeat(np.arange(len(start)), -(-df // BLOCK))
    first_block = np.flatnonzero(np.r_[True, term_of_block[1:] != term_of_block[:-1]])
    bytes_of_term, pairs_of_term = np.add.reduceat(size, first_block), np.add.reduceat(in_block, first_block)
    pair = np.cumsum(in_block) - in_block
    meta = np.stack([place[first], place[first + count - 1], count, gap_bytes, tf_bytes, offset - offset[first_block][term_of_block],
                     pair - pair[first_block][term_of_block]], 1).astype("<i4")
    blocks = -(-df // BLOCK)
    columns = [c.split()[0] for c in INDEX.split(", ")]
    missing = np.array([i is None for i in doc_ids])
    ids = np.array([i or 0 for i in doc_ids], "<i8")
    yield pa.RecordBatch.from_arrays([
        pa.array([number]), pa.nulls(1, pa.string()), pa.array([len(ids)]), pa.array([int(lengths.sum())]), pa.array([ids.tobytes()]),
        pa.array([missing.tobytes()]), pa.array([lengths.astype("<i8").tobytes()]), *[pa.nulls(1, pa.binary())] * 3], names=columns)
    k = len(start)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(k, number)), pa.array([names[c] for c in code[start]], pa.binary()).cast(pa.string()), pa.array(df.astype(np.int64)),
        pa.nulls(k, pa.int64()), *[pa.nulls(k, pa.binary())] * 3, _binary(meta.tobytes(), np.cumsum(blocks) * 4 * META),
        _binary(pairs.tobytes(), np.cumsum(pairs_of_term) * 16), _binary(data.tobytes(), np.cumsum(bytes_of_term))], names=columns)


class _Codes(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def build_index(docs: DataFrame, *, segment_terms: int = 3_000_000, segment_docs: int = 50_000) -> DataFrame:
    """Rows INDEX of ``docs`` (doc_id, text); a segment closes when it holds ``segment_terms`` terms or ``segment_docs`` documents."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 24, 0
        codes, parts, ids, lengths = _Codes(), [], [], []

        def close():
            n = np.array(lengths, np.int64)
            return _segment(base + made, list(codes), np.concatenate(parts), np.repeat(np.arange(len(n)), n), ids, n)

        held = 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").translate(_FOLD).split()
                if not words:
                    continue
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id)
                lengths.append(len(words))
                held += len(words)
                if held >= segment_terms or len(ids) >= segment_docs:
                    yield from close()
                    made, held, codes, parts, ids, lengths = made + 1, 0, _Codes(), [], [], []
        if ids:
            yield from close()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(index, INDEX)


class Postings:
    """One term's list in a segment; blocks are decompressed when asked for and kept."""

    def __init__(self, weight: int, meta: bytes, pairs: bytes, data: bytes, norms: np.ndarray, norm_of) -> None:
        self.weight, self.data, self.norms = weight, np.frombuffer(data, np.uint8), norms
        self.meta = np.frombuffer(meta, "<i4").reshape(-1, META)
        p = np.frombuffer(pairs, "<i8").reshape(-1, 2)
        self.maxima = weight * np.maximum.reduceat(impact(p[:, 0], norm_of(p[:, 1])), self.meta[:, PAIR])
        self.bound = int(self.maxima.max())
        self.blocks: dict[int, tuple] = {}
        self.whole: tuple | None = None

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of block ``b``."""
        got = self.blocks.get(b)
        if got is None:
            first, _, count, gw, tw, at, _ = self.meta[b].tolist()
            gap = self.data[at: at + count * gw].view(f"<u{gw}").astype(np.int64)
            tf = self.data[at + count * gw: at + count * (gw + tw)].view(f"<u{tw}").astype(np.int64)
            place = first + np.cumsum(gap)
            got = self.blocks[b] = place, self.weight * impact(tf, self.norms[place])
        return got

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            each = [self.block(b) for b in range(len(self.meta))]
            self.whole = each[0] if len(each) == 1 else tuple(np.concatenate(x) for x in zip(*each, strict=True))
        return self.whole


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def max_score(lists: list[Postings], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of all documents of the segment that can be among the ``k`` best; a tie with the k-th best stays in."""
    lists = sorted(lists, key=lambda x: -x.bound)
    left = np.cumsum([0, *[x.bound for x in reversed(lists)]])[::-1]  # left[i]: the most that lists i.. add
    acc, floor, i = np.zeros(n_docs, np.int64), 0, 0
    while i < len(lists) and left[i] >= floor:  # essential lists
        place, score = lists[i].all()
        acc[place] += score
        floor = _kth(acc, k)
        i += 1
    place = np.flatnonzero((acc > 0) & (acc + left[i] >= floor))
    score = acc[place]
    rest = lists[i:]
    if not rest or not len(place):
        return place, score
    # The most that each list left may add to each document: the maximum of the block it would lie in.
    at = np.stack([np.minimum(np.searchsorted(x.meta[:, LAST], place), len(x.meta) - 1) for x in rest])
    most = np.stack([np.where((x.meta[a, FIRST] <= place) & (place <= x.meta[a, LAST]), x.maxima[a], 0) for x, a in zip(rest, at, strict=True)])
    upto = np.cumsum(most[::-1], 0)[::-1]
    for j, x in enumerate(rest):
        alive = score + upto[j] >= floor
        if not alive.all():
            place, score, at, most, upto = place[alive], score[alive], at[:, alive], most[:, alive], upto[:, alive]
        for b in np.unique(at[j][most[j] > 0]):
            mine = np.flatnonzero((at[j] == b) & (most[j] > 0))
            where, what = x.block(int(b))
            hit = np.minimum(np.searchsorted(where, place[mine]), len(where) - 1)
            score[mine] += np.where(where[hit] == place[mine], what[hit], 0)
        floor = max(floor, _kth(score, k))
    return place, score


def search(index: DataFrame, items: DataFrame, *, k: int = 10, items_per_block: int = 64) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of ``index`` for each item of ``items`` (item_id, text)."""
    words = items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
    words = written(words, "ranked-item-terms")
    heads, lists = index.filter("term is null"), index.filter("term is not null")
    total = heads.agg(F.sum("df").alias("n"), F.sum("size").alias("l")).first()
    n_docs, n_terms = int(total["n"] or 0), int(total["l"] or 0)
    blocks = max(1, math.ceil(words.select("item_id").distinct().count() / items_per_block))
    df = lists.join(words.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    asked = words.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")).groupBy("block", "term").agg(F.collect_list(F.struct("item_id")).alias("items"))
    asked = asked.join(df, "term").select("term", "block", "items", weight.alias("weight"))
    schema = f"item_id {words.schema['item_id'].dataType.simpleString()}, doc_id long, score long"
    rows = lists.select("segment", "term", "meta", "pairs", "data").join(asked, "term").unionByName(
        heads.select("segment", "doc_ids", "missing", "lengths", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")), allowMissingColumns=True)

    def evaluate(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["term"].isna()].iloc[0]
        ids, missing, lengths = (np.frombuffer(head[c], t) for c, t in (("doc_ids", "<i8"), ("missing", bool), ("lengths", "<i8")))

        def norm_of(n: np.ndarray) -> np.ndarray:
            return 10 + (90 * n * n_docs) // n_terms

        norms = norm_of(lengths)
        mine: dict = {}
        rows = pdf[pdf["term"].notna()]
        for w, held_by, meta, pairs, data in zip(rows["weight"], rows["items"], rows["meta"], rows["pairs"], rows["data"], strict=True):
            p = Postings(int(w), meta, pairs, data, norms, norm_of)
            for i in held_by:
                mine.setdefault(i["item_id"], []).append(p)
        out = [pd.DataFrame({"item_id": pd.Series([], dtype=object), "doc_id": pd.array([], dtype="Int64"), "score": pd.Series([], dtype="int64")})]
        for item, own in mine.items():
            place, score = max_score(own, len(lengths), k)
            top = np.lexsort((ids[place], missing[place], -score))[:k]
            found = pd.arrays.IntegerArray(ids[place[top]].astype(np.int64), missing[place[top]])
            out.append(pd.DataFrame({"item_id": pd.Series([item] * len(top), dtype=object), "doc_id": found, "score": score[top]}))
        return pd.concat(out)

    heaps = rows.groupBy("segment", "block").applyInPandas(evaluate, schema)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, *, k: int = 10, **bounds) -> DataFrame:
    """Index ``docs`` and rank them for ``items``."""
    return search(written(build_index(docs, **bounds), "ranked-index"), items, k=k)
