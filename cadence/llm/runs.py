"""Periodic runs of words, found on a grammar made by Re-Pair.

A run is a stretch of consecutive words with smallest period q, at least
max(``least``, ``power`` * q) words long, that no neighbouring word extends.

Texts are taken in groups of bounded size, each text whole and within one task:

1. Words become ids; Re-Pair replaces pairs of neighbouring symbols by
   nonterminals.  A round counts all pairs and replaces each pair that occurs
   twice or more and is not outranked by the more frequent pair it overlaps, so
   pairs go in the order of their frequency wherever they compete.  One grammar
   serves the whole group; no pair spans two texts.  When no pair repeats, what
   is left of a text is paired up level by level, so every text has one root.
2. For each nonterminal X -> A B, once: the runs inside X that hold the last word
   of A and the first of B.  Such a run holds 2q words on one side, so period q
   shows at the boundary: a few words are compared for each q up to a quarter of
   X, and the stretch of those left is measured with prefix hashes by bisection.
3. The runs are carried to every place where X is derived, level by level.  A run
   of the text crosses the boundary of the smallest nonterminal around it, where
   it is found whole; pieces found in smaller ones lie inside it and are merged
   into the maximal intervals.  Intervals with several periods keep the smallest.

Every run is compared word by word before it is returned; were a hash to
mislead, the group is searched again with another base.

Edge cases: null and empty texts have no words and no run; a null doc_id is
never rotated by ``with_planted_repeats``; repeated rows are judged one by one;
empty tables give no rows; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Moduli under 2**31 and bases of the prefix hashes.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = ((1_103_515_245, 1_664_525), (69_069, 1_566_083_941), (48_271, 1_812_433_253))


def spans(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for each count, end to end."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _scatter(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _replaced(at: np.ndarray, names: np.ndarray, symbol: np.ndarray, *beside: np.ndarray) -> tuple[np.ndarray, ...]:
    """``symbol`` with the pairs that begin at ``at`` replaced by ``names``; what stands beside a pair is kept for its first symbol."""
    symbol = symbol.copy()
    symbol[at] = names
    keep = np.ones(len(symbol), bool)
    keep[at + 1] = False
    return tuple(x[keep] for x in (symbol, *beside))


class Codes(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Grammar:
    """Re-Pair rules over the concatenated words of several texts.

    Symbols under ``terminals`` are words; rule r is symbol ``terminals`` + r with children ``left[r]`` and ``right[r]``.
    ``roots`` and ``root_starts``: the symbol of each text that is not empty and where the text begins."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.terminals = int(ids.max()) + 1 if len(ids) else 0
        self.size = [np.ones(self.terminals, np.int64)]
        self.rules: list[np.ndarray] = []  # rows (left, right)
        self.known = np.zeros((0, 2), np.int64)  # (pair key, symbol), by key
        self.next = self.terminals
        symbol, text = self._repair(ids.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths))
        symbol, text = self._balance(symbol, text)
        self.roots, self.root_starts = symbol, (np.cumsum(lengths) - lengths)[text]
        rules = np.concatenate(self.rules) if self.rules else np.zeros((0, 2), np.int64)
        self.left, self.right, self.length = rules[:, 0], rules[:, 1], np.concatenate(self.size)

    def _name(self, keys: np.ndarray) -> np.ndarray:
        """The symbols of pair ``keys`` (distinct, sorted); new ones get a rule."""
        at = np.searchsorted(self.known[:, 0], keys)
        old = np.zeros(len(keys), bool)
        if len(self.known):
            inside = np.minimum(at, len(self.known) - 1)
            old = self.known[inside, 0] == keys
        out = np.empty(len(keys), np.int64)
        if old.any():
            out[old] = self.known[at[old], 1]
        new = keys[~old]
        if len(new):
            out[~old] = self.next + np.arange(len(new))
            rules = np.stack([new >> 32, new & 0xFFFFFFFF], 1)
            self.rules.append(rules)
            sizes = np.concatenate(self.size) if len(self.size) > 1 else self.size[0]
            self.size = [np.concatenate([sizes, sizes[rules[:, 0]] + sizes[rules[:, 1]]])]
            self.next += len(new)
            self.known = np.insert(self.known, np.searchsorted(self.known[:, 0], new), np.stack([new, out[~old]], 1), axis=0)
        return out

    def _repair(self, symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of the texts when no pair of neighbours repeats.

        A pair that occurs once is dead for good: what later stands on its two sides derives it, so it is as rare.
        Dead places cut the sequence, and symbols between two of them leave the search."""
        start, done, stretch = np.arange(len(symbol)), [], text
        while True:
            gap = np.flatnonzero(stretch[1:] == stretch[:-1])
            key = (symbol[gap] << 32) | symbol[gap + 1]
            distinct, which, count = np.unique(key, return_inverse=True, return_counts=True)
            often = np.flatnonzero(count > 1)
            if not len(often):
                break
            # Rank of each pair by frequency, ties in scattered order (else a repeated text would give one pair a round).
            order = (np.minimum(count[often], (1 << 23) - 1).astype(np.uint64) << np.uint64(40)) | (_scatter(distinct[often]) >> np.uint64(24))
            rank_of = np.zeros(len(distinct), np.int64)
            rank_of[often[np.argsort(order, kind="stable")]] = np.arange(1, len(often) + 1)
            rank = np.zeros(len(symbol), np.int64)  # of the pair that begins here; 0: dead, or the end of a text
            rank[gap] = rank_of[which]
            joined = rank > 0
            keep = joined.copy()
            keep[1:] |= joined[:-1]
            done.append((symbol[~keep], start[~keep]))
            stretch = np.cumsum(np.r_[True, ~joined[:-1]])[keep]
            symbol, start, rank = symbol[keep], start[keep], rank[keep]
            # In a stretch of one symbol the same pair overlaps itself: every other place counts, from the left.
            same = np.r_[False, (rank[1:] == rank[:-1]) & (rank[1:] > 0)]
            even = np.ones(len(rank), bool)
            if same.any():
                place = np.arange(len(rank))
                even = (place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 0
            best = (rank > 0) & even
            best[1:] &= rank[1:] >= rank[:-1]
            best[:-1] &= rank[:-1] >= rank[1:]
            at = np.flatnonzero(best)
            names, index = np.unique((symbol[at] << 32) | symbol[at + 1], return_inverse=True)
            symbol, start, stretch = _replaced(at, self._name(names)[index], symbol, start, stretch)
        symbol, start = (np.concatenate(x) for x in zip(*done, (symbol, start), strict=True))
        by = np.argsort(start, kind="stable")
        return symbol[by], text[start[by]]

    def _balance(self, symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        while len(symbol) > 1:
            start = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            size = np.diff(np.r_[start, len(text)])
            if size.max() < 2:
                break
            place = spans(size)
            at = np.flatnonzero((place % 2 == 0) & (place + 1 < np.repeat(size, size)))
            keys, index = np.unique((symbol[at] << 32) | symbol[at + 1], return_inverse=True)
            symbol, text = _replaced(at, self._name(keys)[index], symbol, text)
        return symbol, text

    def places(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rules, where they begin) for all places where a rule is derived, level by level from the roots."""
        symbol, start = self.roots, self.root_starts
        while True:
            inner = symbol >= self.terminals
            rule, start = symbol[inner] - self.terminals, start[inner]
            if not len(rule):
                return
            yield rule, start
            a, b = self.left[rule], self.right[rule]
            symbol, start = np.concatenate([a, b]), np.concatenate([start, start + self.length[a]])


class Hashes:
    """Prefix hashes of a sequence of ids."""

    def __init__(self, ids: np.ndarray, bases: tuple[int, int]) -> None:
        self.parts = []
        for p, base in zip(PRIMES, bases, strict=True):
            power = np.ones(1, np.uint64)
            while len(power) < len(ids) + 1:
                step = np.uint64(pow(base, len(power), p))
                power = np.concatenate([power, power * step % np.uint64(p)])
            term = (ids.astype(np.uint64) + np.uint64(1)) * power[: len(ids)] % np.uint64(p)
            self.parts.append((np.uint64(p), power, np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)])))

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` ids from ``i`` equal those from ``j`` (i <= j)."""
        out = np.ones(len(i), bool)
        for p, power, total in self.parts:
            out &= (total[i + n] - total[i]) % p * power[j - i] % p == (total[j + n] - total[j]) % p
        return out

    def common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many ids from ``i`` on (or before it) equal those at ``j``, ``most`` at most."""
        low, high = np.zeros(len(i), np.int64), most.astype(np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.equal(i, j, mid) if forward else self.equal(i - mid, j - mid, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def boundary_runs(t: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, *, least: int, power: int, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """(k, first, last, period): for each nonterminal k, derived at [start, end) with its boundary at ``middle``, the runs in it
    that hold the words on both sides of the boundary; the smallest period of each."""
    out = []
    most = (end - start) // power
    chunk = 4_000_000
    for side in ("left", "right"):
        room = np.minimum(most, (middle - start) // 2 if side == "left" else (end - middle) // 2)
        each = np.flatnonzero(room > 0)
        ends = np.cumsum(room[each])
        lo = 0
        while lo < len(each):  # some nonterminals at a time: memory stays bounded
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + chunk, side="right")))
            some = each[lo:hi]
            lo = hi
            k = np.repeat(some, room[some])
            q = spans(room[some]) + 1
            for part in (0, 1, 2):  # of the q places that must equal those q later: the one at the boundary, the farthest, one between
                away = (np.zeros(len(q), np.int64), q - 1, q // 2)[part]
                at = middle[k] - q - 1 - away if side == "left" else middle[k] + away
                ok = t[at] == t[at + q]
                k, q = k[ok], q[ok]
            at = middle[k] - q if side == "left" else middle[k]  # equal places before and from here on
            back = hashes.common(at, at + q, at - start[k], False)
            on = hashes.common(at, at + q, end[k] - at - q, True)
            first, last = at - back, at + on + q
            ok = (last - first >= np.maximum(least, power * q)) & (first < middle[k]) & (last > middle[k])
            out.append((k[ok], first[ok], last[ok], q[ok]))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    k, first, last, q = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((q, last, first, k))
    k, first, last, q = k[order], first[order], last[order], q[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (first[1:] != first[:-1]) | (last[1:] != last[:-1])][: len(k)]
    return k[new], first[new], last[new], q[new]


def find_runs(ids: np.ndarray, lengths: np.ndarray, *, least: int = 6, power: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, period) of all runs of texts laid end to end (``ids``, each of ``lengths`` words), by first, then period."""
    nothing = (np.zeros(0, np.int64),) * 3
    if not len(ids):
        return nothing
    grammar = Grammar(ids, lengths)
    rules = len(grammar.left)
    if not rules:
        return nothing
    start = np.full(rules, -1)
    for rule, at in grammar.places():  # one place of each nonterminal stands for all
        start[rule] = at
    size = grammar.length[grammar.terminals:]
    middle = start + grammar.length[grammar.left]
    for bases in BASES:
        k, first, last, q = boundary_runs(ids, start, middle, start + size, least=least, power=power, hashes=Hashes(ids, bases))
        held = last - first - q
        at = np.repeat(first, held) + spans(held)
        if (ids[at] == ids[at + np.repeat(q, held)]).all():
            break
    else:
        raise ArithmeticError("prefix hashes misled with every base")
    offset, span = first - start[k], last - first
    count = np.bincount(k, minlength=rules)
    base = np.cumsum(count) - count
    parts = []
    for rule, at in grammar.places():
        c = count[rule]
        if c.any():
            which = np.repeat(base[rule], c) + spans(c)
            parts.append(np.stack([np.repeat(at, c) + offset[which], span[which], q[which]]))
    if not parts:
        return nothing
    a, n, p = np.concatenate(parts, 1)
    # Merge: of the intervals of one period, those inside another go; two runs of one period overlap in less than a period.
    order = np.lexsort((-n, a, p))
    a, n, p = a[order], n[order], p[order]
    ends = a + n + p * (len(ids) + 1)  # rises from period to period, so the running maximum starts anew
    keep = np.r_[True, ends[1:] > np.maximum.accumulate(ends)[:-1]]
    a, n, p = a[keep], n[keep], p[keep]
    # Of equal intervals, the smallest period stays.
    order = np.lexsort((p, n, a))
    a, n, p = a[order], n[order], p[order]
    keep = np.r_[True, (a[1:] != a[:-1]) | (n[1:] != n[:-1])]
    a, n, p = a[keep], n[keep], p[keep]
    order = np.lexsort((p, a))
    return a[order], (a + n)[order], p[order]


def with_planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a checksum of their id, end in a repeated stretch of their own words."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


REPORT = (("n_runs", "long"), ("start", "long"), ("length", "long"), ("period", "long"), ("exponent_milli", "long"), ("runs_sha256", "string"), ("collapsed_sha256", "string"))


def periodic_runs(docs: DataFrame, *, planted: bool = False, least: int = 6, power: int = 4, group_words: int = 400_000) -> DataFrame:
    """doc_id, REPORT and ``runs`` (start, length, period of each) of every row of ``docs`` (doc_id, text).

    Words are numbered from 0.  The columns start to exponent_milli tell of the longest run (ties: smallest start, then
    period), null without runs; runs_sha256 is over lines ``start,length,period``; collapsed_sha256 is over the words
    that stay, joined by one space, when of each run only the first period does.  Texts are searched in groups of about
    ``group_words`` words."""
    def report(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(w) for w in texts], np.int64)
        flat = np.fromiter(map(Codes().__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
        first, last, period = find_runs(flat, lengths, least=least, power=power)
        begins = np.cumsum(lengths) - lengths
        owner = np.searchsorted(begins + lengths, first, side="right")
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        gone = np.zeros(len(flat) + 1, np.int64)
        np.add.at(gone, first + period, 1)
        np.add.at(gone, last, -1)
        stays = np.cumsum(gone)[:-1] == 0
        rows = []
        for d, words in enumerate(texts):
            lo, hi, at = cut[d], cut[d + 1], begins[d]
            own = np.stack([first[lo:hi] - at, last[lo:hi] - first[lo:hi], period[lo:hi]], 1).tolist()
            listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest()
            kept = [w for w, k in zip(words, stays[at: at + len(words)].tolist(), strict=True) if k] if own else words
            best = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else [None] * 3
            rows.append((len(own), *best, 1000 * best[1] // best[2] if own else None, listed, hashlib.sha256(b" ".join(kept)).hexdigest(),
                         [dict(zip(("start", "length", "period"), r, strict=True)) for r in own]))
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                          names=["doc_id", *[n for n, _ in REPORT], "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").split()
                words = with_planted_repeats(doc_id, words) if planted else words
                if held and held + len(words) > group_words:
                    yield report(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
        if ids:
            yield report(ids, texts)

    schema = ", ".join(["doc_id long", *[f"{n} {t}" for n, t in REPORT], "runs array<struct<start:long,length:long,period:long>>"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
