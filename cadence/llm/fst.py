"""Token counts by a finite-state compilation of a BPE tokenizer.

Two machines count the tokens of a text without building them:

* ``Transducer`` reads one pre-token symbol by symbol.  A state holds, for
  every position from which a vocabulary entry may still be in progress, the
  entry's node in the prefix trie, the last token before that position and the
  token count up to it, relative to the state's own.  A transition on a symbol
  is deterministic: among the entries that end there, exactly one follows its
  predecessor without a merge across the border.  The transition carries the
  change of the count of emitted tokens (it may be negative, where a longer
  entry takes over).  States and transitions are determinised when first met,
  kept by number, and dropped together when ``max_states`` is reached, also
  inside a pre-token, whose state is then made anew.
* Texts are cut into chunks.  A chunk's state map says what it does to any
  entering state: white space and digits (each a pre-token of its own) reset the
  machine, so the map is the text before the first of them (it completes an open
  pre-token), the count between, and the text after the last one (left open).
  Maps compose
  associatively; they are reduced by a prefix scan, first inside the task that
  cut the chunks, then across tasks.

The counts equal those of the ``tokenizers`` library for lower-casing word BPE
files.  A special string in a text counts one token and cuts the text, as the
library does by default.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted one by one; a null id is carried through; a stretch without white space
or digits is carried as text and read by one task, in memory of its own size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tokens import byte_alphabet, family

#: White space as the tokenizer's pattern knows it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Transducer:
    """Counts of one word-BPE tokenizer; see the module's text."""

    def __init__(self, path: str, max_states: int = 80_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if family(spec) != "word":
            raise ValueError("not a lower-casing word BPE tokenizer")
        import regex

        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.ranks = {(a, b): i for i, (a, b) in enumerate(map(tuple, spec["model"]["merges"]))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.pretokens = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", SPACE)).findall
        self.alphabet = str.maketrans(byte_alphabet())
        self.max_states, self.max_words = max_states, 4 * max_states
        border = SPACE + ("" if any(c.isdigit() for t in self.special for c in t) else "0-9")
        self.first_border, self.last_border = re.compile(f"[{border}]").search, re.compile(f"[{border}](?=[^{border}]*\\Z)").search
        # The trie of the vocabulary; node 0 is the root.
        self.child: list[dict[str, int]] = [{}]
        self.token: list[tuple[str, ...] | None] = [None]
        for t in spec["model"]["vocab"]:
            node, symbols = 0, self._symbols(t)
            for s in symbols:
                if s not in self.child[node]:
                    self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = self.child[node][s]
            self.token[node] = symbols
        self.good: dict = {}
        self.words: dict[str, int] = {}
        self._reset()

    def _symbols(self, token: str) -> tuple[str, ...]:
        end = self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix)
        body = token[: -len(self.suffix)] if end else token
        return (*body[:-1], body[-1] + self.suffix) if end else tuple(body)

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self._state(((0, -1, 0),))

    def _state(self, key: tuple) -> int:
        got = self.ids.get(key)
        if got is None:
            got = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return got

    def merged(self, symbols: tuple[str, ...]) -> list[str]:
        """The merges of the tokenizer applied to ``symbols``, lowest rank first."""
        parts = list(symbols)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, last: int, node: int) -> bool:
        """May the token at ``node`` stand after the one at ``last`` (-1: first)?"""
        key = (last, node)
        got = self.good.get(key)
        if got is None:
            if len(self.good) > 5 * self.max_states:
                self.good.clear()
            own = self.token[node]
            if last < 0:
                got = len(self.merged(own)) == 1
            else:
                got = self.follows(-1, node) and self.merged(self.token[last] + own) == ["".join(self.token[last]), "".join(own)]
            self.good[key] = got
        return got

    def move(self, state: int, symbol: str) -> tuple[int, int]:
        """The transition of ``state`` on ``symbol``: next state and change of the count."""
        live, end, count = [], None, 0
        for node, last, so_far in self.states[state]:
            to = self.child[node].get(symbol)
            if to is None:
                continue
            if self.child[to]:
                live.append((to, last, so_far))
            if end is None and self.token[to] is not None and self.follows(last, to):
                end, count = to, so_far + 1
        if end is None:
            raise ValueError(f"symbol {symbol!r} is not in the vocabulary")
        got = self._state((*((n, t, c - count) for n, t, c in live), (0, end, 0))), count
        self.moves[state][symbol] = got
        return got

    def pretoken(self, word: str) -> int:
        """Tokens of one pre-token (letters in lower case)."""
        got = self.words.get(word)
        if got is not None:
            return got
        if len(self.states) > self.max_states:
            self._reset()
        if len(self.words) > self.max_words:
            self.words.clear()
        symbols = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.alphabet)
        state = count = 0
        for s in (*symbols[:-1], symbols[-1] + self.suffix):
            step = self.moves[state].get(s)
            if step is None:
                if len(self.states) > 2 * self.max_states:
                    key = self.states[state]
                    self._reset()
                    state = self._state(key)
                step = self.move(state, s)
            state, count = step[0], count + step[1]
        if len(word) <= 64:
            self.words[word] = count
        return count

    def closed(self, text: str) -> int:
        """Tokens of a text that is not continued on either side."""
        if self.cut_special and any(s in text for s in self.special):
            return sum(1 if x in self.special else self.closed(x) for x in self.cut_special(text) if x)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Letters are lowered one by one: no rule looks at a letter's neighbours.
        text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
        return sum(map(self.pretoken, self.pretokens(text)))

    def state_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(text up to the first white space or digit, count, text after the last one); the last is None if there is none.

        A special string holds none of them, so no chunk's cut hides one."""
        first = self.first_border(chunk)
        if not first:
            return chunk, 0, None
        last = self.last_border(chunk).end()
        return chunk[: first.start()], self.closed(chunk[first.start(): last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple[str, int, str | None]:
        """The state map of a chunk with map ``a`` followed by one with map ``b``."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        if b[2] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.closed(a[2] + b[0]) + b[1], b[2]

    def total(self, m: tuple) -> int:
        """The count of a whole text with state map ``m``."""
        return m[1] + self.closed(m[0]) + (self.closed(m[2]) if m[2] else 0)

    def scan(self, maps: list[tuple]) -> tuple:
        """Composition of consecutive maps, pairwise in a tree."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i: i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]


_MACHINES: dict[str, Transducer] = {}


def machine(path: str) -> Transducer:
    """One transducer per file and Python worker."""
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(path)
    return _MACHINES[path]


MAPS = "row_key long, doc_id string, n_bytes long, chunk_no long, head string, count long, tail string"


def token_counts(docs: DataFrame, *, tokenizer: str, limit: int, chunk_chars: int = 16_384,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of ``docs``."""
    text = F.coalesce(F.col("_t"), F.lit(""))
    rows = docs.select(docs[id_col].cast("string").alias("doc_id"), docs[text_col].alias("_t")).select(
        F.monotonically_increasing_id().alias("row_key"), "doc_id", text.alias("_t"), F.octet_length(text).cast("long").alias("n_bytes"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("_t") - 1) / chunk_chars).cast("int")))
    chunks = rows.select("row_key", "doc_id", "n_bytes", F.when(F.length("_t") <= chunk_chars, F.array("_t")).otherwise(
        F.transform(starts, lambda i: F.substring(F.col("_t"), i * chunk_chars + 1, F.lit(chunk_chars)))).alias("_c")
    ).select("row_key", "doc_id", "n_bytes", F.posexplode("_c").alias("chunk_no", "chunk"))

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fst = machine(tokenizer)
        for pdf in batches:
            out, maps = [], []
            rows = list(pdf.itertuples(index=False, name=None))
            for k, (key, doc, n, no, chunk) in enumerate(rows):
                maps.append(fst.state_map(chunk))
                if k + 1 == len(rows) or rows[k + 1][0] != key:
                    out.append((key, doc, n, no, *fst.scan(maps)))
                    maps = []
            yield pd.DataFrame(out, columns=["row_key", "doc_id", "n_bytes", "chunk_no", "head", "count", "tail"])

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fst, pending = machine(tokenizer), None

        def done(p: tuple) -> tuple:
            return p[1], p[2], fst.total(p[3])

        for pdf in batches:
            out = []
            for key, doc, n, _, head, count, tail in pdf.itertuples(index=False, name=None):
                m = (head, count, None if tail is None or tail is pd.NA else tail)
                if pending and pending[0] == key:
                    pending = (*pending[:3], fst.compose(pending[3], m))
                    continue
                if pending:
                    out.append(done(pending))
                pending = (key, doc, n, m)
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_tokens"])
        if pending:
            yield pd.DataFrame([done(pending)], columns=["doc_id", "n_bytes", "n_tokens"])

    maps = chunks.mapInPandas(local, MAPS)
    counted = maps.repartition("row_key").sortWithinPartitions("row_key", "chunk_no").mapInPandas(across, "doc_id string, n_bytes long, n_tokens long")
    return counted.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("over_limit", F.col("n_tokens") > limit)
