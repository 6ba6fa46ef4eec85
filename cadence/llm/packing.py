"""Sequence packing by non-negative least squares over a length histogram.

Every document becomes token ids plus an end id.  A document's full windows
are sequences of their own; what is left of it (shorter than a window) joins a
pool.  A pool is packed when it holds ``pool_tokens`` ids:

1. its pieces are put into ``bins`` length classes (a piece takes the room of
   its class's upper bound);
2. all combinations of at most ``depth`` classes that fill a window exactly are
   the columns of a matrix; the repeat counts solve
   ``min || W (A x - histogram) ||, x >= 0``, where misses in classes of long
   pieces weigh more, as their leftovers are harder to place;
3. the counts are rounded down and the combinations filled with pieces;
4. pieces left over are packed greedily, longest first: they fill the gaps of
   the sequences made in step 3, then sequences of their own, and are cut
   wherever a gap ends.

The last sequence of a partition is cut into lengths that are powers of two,
which need no padding.

The work is one narrow pass: a partition of documents is packed by the task
that reads it, in bounded memory (one pool, one document), with no shuffle.
A rerun of a task gives the same rows, since pools follow the input's order.

Edge cases: a null or empty text is the end id alone (one piece of length 1);
repeated rows are packed each on its own; a null id is carried through.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.tokens import encoder


def combinations_filling(bins: int, depth: int) -> np.ndarray:
    """One row per multiset of at most ``depth`` classes 1..bins that adds up to ``bins``: its counts by class."""
    rows = []
    for k in range(1, depth + 1):
        for c in itertools.combinations_with_replacement(range(1, bins + 1), k - 1):
            last = bins - sum(c)
            if last >= (c[-1] if c else 1):
                rows.append(np.bincount([*c, last], minlength=bins + 1)[1:])
    return np.array(rows)


def nnls(a: np.ndarray, b: np.ndarray, max_steps: int = 400) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    gram, atb = a.T @ a, a.T @ b
    tol = 1e-9 * max(1.0, float(np.abs(atb).max(initial=0)))
    for _ in range(max_steps):
        gain = np.where(free, -np.inf, atb - gram @ x)
        j = int(gain.argmax())
        if gain[j] <= tol:
            break
        free[j] = True
        while True:
            idx = np.flatnonzero(free)
            z = np.linalg.lstsq(gram[np.ix_(idx, idx)], atb[idx], rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[idx] = z
                break
            low = z <= 0
            step = (x[idx][low] / np.maximum(x[idx][low] - z[low], 1e-300)).min()
            x[idx] += step * (z - x[idx])
            drop = idx[(x[idx] <= 1e-12) & low]
            if not len(drop):
                drop = idx[low][:1]
            x[drop], free[drop] = 0, False
            if not free.any():
                return x
    return x


def pack_lengths(lengths: np.ndarray, window: int, combos: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, to) that hold every unit of pieces of ``lengths`` (each 1..window-1) once."""
    bins = combos.shape[1]
    quantum = window // bins
    classes = -(-lengths // quantum)
    hist = np.bincount(classes, minlength=bins + 1)[1:]
    weight = np.sqrt(np.arange(1, bins + 1) / bins)
    repeats = np.floor(nnls((combos * weight).T.astype(float), hist * weight) + 1e-6).astype(int)
    stock = [list(np.flatnonzero(classes == c)[::-1]) for c in range(bins + 1)]
    out, room = [], []
    for k in np.argsort(-repeats, kind="stable")[: int((repeats > 0).sum())]:
        need = [(c + 1, int(m)) for c, m in enumerate(combos[k]) if m]
        for _ in range(min(int(repeats[k]), *(len(stock[c]) // m for c, m in need))):
            seq = [(int(p), 0, int(lengths[p])) for c, m in need for p in (stock[c].pop() for _ in range(m))]
            out.append(seq)
            room.append(window - sum(t for _, _, t in seq))
    left = [int(p) for s in stock for p in s]
    # Enough units must be left to fill every gap: the sequences with the widest gaps are taken apart.
    order, rest = sorted(range(len(out)), key=lambda g: (room[g], g)), int(lengths[left].sum())
    gap = sum(room)
    while order and rest < gap:
        g = order.pop()
        left += [p for p, _, _ in out[g]]
        rest, gap, room[g], out[g] = rest + window - room[g], gap - room[g], 0, []
    out, room = [s for s in out if s], [r for s, r in zip(out, room, strict=True) if s]
    left.sort(key=lambda p: (-lengths[p], p))
    gaps = iter(sorted((g for g in range(len(out)) if room[g]), key=lambda g: (-room[g], g)))
    at = next(gaps, None)
    for p in left:
        done = 0
        while done < lengths[p]:
            if at is None:
                out.append([])
                room.append(window)
                at = len(out) - 1
            take = min(int(lengths[p]) - done, room[at])
            out[at].append((p, done, done + take))
            done, room[at] = done + take, room[at] - take
            if not room[at]:
                at = next(gaps, None)
    return out


def powers_of_two(seq: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut one sequence into sequences whose lengths are the powers of two in its length."""
    total, out = sum(b - a for _, a, b in seq), []
    todo = seq[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        need, part = total & 1 << bit, []
        while need:
            p, a, b = todo.pop()
            take = min(need, b - a)
            part.append((p, a, a + take))
            need -= take
            if a + take < b:
                todo.append((p, a + take, b))
        if part:
            out.append(part)
    return out


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, *, tokenizer: str, end_id: int, window: int = 4096, bins: int = 64, depth: int = 3,
                   pool_tokens: int = 6_000_000, partition_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` into sequences of at most ``window`` ids.

    One row per piece: the document's id, ``start`` (its ids before the piece),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (ids of
    the document with its end id), ``sequence_id`` and ``offset`` in the
    sequence.  ``sequence_id`` is the partition's number times 2**32 plus a count.

    A partition ends in at most 12 short sequences, so partitions that hold less
    than about ``partition_bytes`` of text are merged first (without a shuffle).
    """
    if window % bins:
        raise ValueError("bins must divide window")
    end, kind = int(end_id).to_bytes(4, "little"), docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, combos = encoder(tokenizer), combinations_filling(bins, depth)
        base = TaskContext.get().partitionId() << 32
        made, pool, pooled, rows, size = 0, [], 0, [], 0

        def emit(seq: list[tuple]) -> None:
            nonlocal made, size
            at = 0
            for doc, start, ids, total in seq:
                n = len(ids) // 4
                rows.append((doc, start, n, ids, total, base + made, at))
                at += n
                size += 4 * n
            made += 1

        def drain(last: bool) -> None:
            nonlocal pool, pooled
            if not pool:
                return
            seqs = pack_lengths(np.array([len(ids) // 4 for _, _, ids, _ in pool]), window, combos)
            cut = lambda seq: [(pool[p][0], pool[p][1] + a, pool[p][2][4 * a: 4 * b], pool[p][3]) for p, a, b in seq]
            held = []
            for seq in seqs:
                if sum(b - a for _, a, b in seq) == window:
                    emit(cut(seq))
                elif last:
                    for part in powers_of_two(seq):
                        emit(cut(part))
                else:
                    held += cut(seq)
            pool, pooled = held, sum(len(x[2]) // 4 for x in held)

        def flush() -> pa.RecordBatch:
            nonlocal rows, size
            cols = list(zip(*rows, strict=True))
            rows, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                              names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(text.as_py() or "") + end
                total = len(ids) // 4
                full = total // window * window
                for start in range(0, full, window):
                    emit([(doc, start, ids[4 * start: 4 * (start + window)], total)])
                    if size >= 16_000_000:
                        yield flush()
                if full < total:
                    pool.append((doc, full, ids[4 * full:], total))
                    pooled += total - full
                if pooled >= pool_tokens:
                    drain(last=False)
                if size >= 16_000_000:
                    yield flush()
        drain(last=True)
        if rows:
            yield flush()

    if not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"{id_col} must be an integer")
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    size = d.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return d.coalesce(max(1, math.ceil(size / partition_bytes))).mapInArrow(run, SCHEMA)

