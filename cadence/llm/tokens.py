"""Token ids of whole texts inside Python workers.

``IdEncoder`` gives the ids the ``tokenizers`` library gives for a tokenizer
file, with special tokens neither added nor stripped.  Two families of files
allow a text to be cut into units whose ids are independent of each other; the
ids of a unit are then looked up in a memo of bounded size, and the library's
BPE model runs once per new unit:

* lower-casing word BPE (white space only separates words): units are the
  pieces between ASCII white space;
* byte-level BPE with the usual word pattern: units start at a single space
  that stands between two other characters.

A text of plain Latin characters is cut into its pre-tokens at once; byte-level
BPE can cut many such texts together, in Arrow, and asks the memo once for each
different pre-token of theirs (``encode_all``).

Any other file, and any text that holds a special string, white space outside
ASCII or runs of white space, goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

LATIN = "a-zA-ZÀ-ÖØ-öø-ÿ"
#: Units made of these characters only are cut by the patterns below; the character classes of
#: Python's and the library's patterns agree on them.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*").fullmatch
_WORD_UNITS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^\s0-9{LATIN}]+").findall
_BYTE_UNITS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s0-9{LATIN}]+|\s+(?!\S)|\s+").findall
#: Class of every byte of a plain text in UTF-8: blank, other white space, letter (bytes beyond ASCII too), digit, other.
_BLANK, _SPACE, _LETTER, _DIGIT, _OTHER = range(5)
_BYTE_CLASS = np.array([_BLANK if c == 32 else _SPACE if c in b"\t\n\r" else _LETTER if c >= 128 or chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER
                        for c in range(256)], np.uint8)
#: The patterns of the two families, as they stand in tokenizer files (fixed values).
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_RUNS = tuple(a + b for a, b in [("  ", ""), *((" ", c) for c in "\t\n\r"), *((c, " ") for c in "\t\n\r")])


def byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies: the printable
    Latin-1 characters stand for themselves, the other bytes for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def family(spec: dict) -> str:
    """'word', 'byte' or 'other': which cutting rule a tokenizer file allows."""
    pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    if not plain or spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
        return "other"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and norm is None:
        return "byte"
    parts = pre.get("pretokenizers") or []
    kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in parts] == ["Split", "ByteLevel"] \
            and parts[0]["pattern"].get("Regex") == WORD_PATTERN and parts[0]["invert"] and not parts[1]["use_regex"]:
        return "word"
    return "other"


def byte_unit_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the matches of ``_BYTE_UNITS`` start in plain texts that lie one behind the other in ``data`` (UTF-8);
    ``texts``: the starts of the texts, none of them empty."""
    kind = _BYTE_CLASS[data]
    first, last = np.zeros(len(data), bool), np.ones(len(data), bool)
    first[texts], last[:-1] = True, first[1:]
    space = kind <= _SPACE
    before = np.concatenate([[_OTHER + 1], kind[:-1]])
    before[first] = _OTHER + 1  # no text goes on into the next one
    after = np.concatenate([space[1:], [True]]) | last
    # A word starts with its class, or with one blank before it. Of other white space, what stands before a word's last one is one unit.
    word = ~space & (kind != before) & (before != _BLANK)
    start = word | space & ((before > _SPACE) | ~after)
    # 's, 't, 'm, 'd, 're, 've, 'll: a unit where the apostrophe starts one without a blank.
    at = np.flatnonzero(word & (data == ord("'")) & ~last)
    one = data[at + 1]
    two = np.where(last[at + 1], 0, data[np.minimum(at + 2, len(data) - 1)])
    short = np.isin(one, list(b"stmd"))
    long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    start[at[short | long] + 1] = False
    end = np.concatenate([at[short] + 2, at[long] + 3])
    start[end[end < len(data)]] = True
    return np.flatnonzero(start)


class _Whole(Exception):
    """A unit shows that its text has to go through the library as a whole."""


class Memo(dict):
    """Values made when first asked for, in two generations: when the younger one is full it becomes the older one,
    whose entries come back when they are asked for again, so frequent keys stay and memory is bounded.  A key of more
    than ``longest`` characters is not kept."""

    def __init__(self, make, size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


class IdEncoder:
    """``encode(text)`` -> the ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, max_memo: int = 350_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = family(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.units = Memo(self._word_unit if self.kind == "word" else self._byte_unit, max_memo)
        self.words = Memo(self._word, max_memo)
        self.model, self.to_alphabet = self.tok.model, str.maketrans(byte_alphabet())

    def library(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token."""
        if word.isascii() and word.isprintable():  # only the blank has a stand-in
            word = word.replace(" ", self.to_alphabet[32])
        else:
            word = word.encode().decode("latin-1").translate(self.to_alphabet)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _word_unit(self, unit: bytes) -> bytes:
        text = unit.decode()
        if not _PLAIN(text):
            return self.library(text)
        return b"".join(map(self.words.__getitem__, _WORD_UNITS(text.lower())))

    def _byte_unit(self, unit: str, lead: str = " ") -> bytes:
        text = lead + unit
        if not _PLAIN(text):
            if any(c.isspace() and c not in " \t\n\r" for c in text):
                raise _Whole
            return self.library(text)
        return b"".join(map(self.words.__getitem__, _BYTE_UNITS(text)))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.kind == "other" or any(s in text for s in self.special):
            return self.library(text)
        if self.kind == "word":
            if _PLAIN(text):
                return b"".join(map(self.words.__getitem__, _WORD_UNITS(text.lower())))
            return b"".join(map(self.units.__getitem__, text.encode().split()))
        if _PLAIN(text):
            return b"".join(map(self.words.__getitem__, _BYTE_UNITS(text)))
        if text[0] in " \t\n\r" or text[-1] in " \t\n\r" or any(r in text for r in _RUNS):
            return self.library(text)
        first, *rest = text.split(" ")
        try:
            return self._byte_unit(first, "") + b"".join(map(self.units.__getitem__, rest))
        except _Whole:
            return self.library(text)

    def encode_all(self, texts: list[str], together: int = 8 << 20) -> list[bytes]:
        """``encode`` of every text. Plain texts are cut ``together``, so many characters at a time."""
        if self.kind != "byte":
            return [self.encode(t) for t in texts]
        out, plain, size = [b""] * len(texts), [], 0
        for i, t in enumerate(texts):
            if not t or not _PLAIN(t) or any(s in t for s in self.special):
                out[i] = self.encode(t)
                continue
            plain.append((i, t.encode()))
            size += len(t)
            if size >= together:
                self._plain_units(plain, out)
                plain, size = [], 0
        if plain:
            self._plain_units(plain, out)
        return out

    def _plain_units(self, texts: list[tuple[int, bytes]], out: list[bytes]) -> None:
        data = b"".join(b for _, b in texts)
        ends = np.cumsum([len(b) for _, b in texts])
        starts = byte_unit_starts(np.frombuffer(data, np.uint8), np.concatenate([[0], ends[:-1]]))
        cuts = np.append(starts, len(data))
        units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        different = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(list(map(self.words.__getitem__, different)), pa.large_binary()).take(units.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[np.searchsorted(cuts, np.append(0, ends))].tolist()
        values = memoryview(ids.buffers()[2])
        for (i, _), a, b in zip(texts, at, at[1:], strict=False):
            out[i] = bytes(values[a:b])


_ENCODERS: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]
