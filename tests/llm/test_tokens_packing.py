"""Token ids, packing, transducer counts and token files against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cadence.llm import fst, packing, queries, token_files
from cadence.llm.tokens import IdEncoder

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


TOKENIZERS = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


def library(path, text):
    return TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library(path, odd_texts):
    enc, tok = IdEncoder(path, max_memo=50), Tokenizer.from_file(path)
    for t in odd_texts:
        assert np.frombuffer(enc.encode(t or ""), "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library_on_mixed_texts(path):
    import random
    rnd, enc = random.Random(3), IdEncoder(path, max_memo=200)
    parts = ["word", "Word's", " I'll", "  ", " ", "\t", "\n", "\n\n", "42", " 7", "é", " Ünï", ",", "!?", " --", "x" * 90, "<|endoftext|>", "日本", "\x7f", "\x01", "ß", "À "]
    for _ in range(300):
        t = "".join(rnd.choices(parts, k=rnd.randint(0, 25)))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == library(path, t), repr(t)
    assert all(len(k) <= 64 for memo in (enc.words, enc.units, enc.words.old, enc.units.old) for k in memo)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoding_texts_together_equals_library(path, odd_texts):
    import random
    rnd = random.Random(4)
    parts = ["ab", "S", "s", "'", "'s", "'re", "'ll", "'l", "'r", "'d", " ", "  ", "\n", "\t", "\r", "7", "42", "é", "À", "!", "-", "x" * 90, "日本", "\x7f", "<|endoftext|>"]
    texts = [t or "" for t in odd_texts] + ["", "'", "s", "'s", " ", "\n"] + ["".join(rnd.choices(parts[:-3], k=rnd.randint(0, 12))) for _ in range(1500)] \
        + ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(300)]
    want = [library(path, t) for t in texts]
    for together in (1, 100, 8 << 20):
        got = IdEncoder(path, max_memo=100).encode_all(texts, together)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert IdEncoder(path).encode_all([]) == []


def test_token_files_ask_once_for_each_different_word(spark, documents, tmp_path, monkeypatch):
    """The texts of a task are cut together: a word that all of them hold is looked up once, not once a text."""
    enc, asked = IdEncoder(BYTE), []
    monkeypatch.setattr(enc, "words", type("Words", (dict,), {"__getitem__": lambda self, w: asked.append(w) or enc._word(w)})())
    texts = [f"The same words, n{i}é" for i in range(50)]
    got = enc.encode_all(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(BYTE, t) for t in texts]
    assert sorted(asked) == sorted({"The", " same", " words", ",", " n", "é", *(str(i) for i in range(50))})
    token_files.write_token_files(documents(list(enumerate(texts))), f"{tmp_path}/f", tokenizer=BYTE, end_id=0, partitions=2)
    rows = token_files.read_token_files(spark, f"{tmp_path}/f").collect()
    assert {r.doc_id: r.ids for r in rows} == {i: [*library(BYTE, t), 0] for i, t in enumerate(texts)}


def check_pieces(rows, lengths, window=4096):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == lengths[r.doc_id]
    for doc, n in lengths.items():
        at = 0
        for s, k in sorted(by_doc[doc]):
            assert s == at and k > 0
            at += k
        assert at == n
    waste = 0
    for pieces in by_seq.values():
        at = 0
        for o, k in sorted(pieces):
            assert o == at
            at += k
        assert 0 < at <= window
        waste += 0 if at & (at - 1) == 0 else window - at
    return waste


def test_packing_documents(documents, odd_texts):
    rows = list(enumerate(odd_texts))
    out = queries.packed(documents(rows, extra=True)).collect()
    ids = {i: [*library(WORD, t), 2] for i, t in rows}
    assert check_pieces(out, {i: len(x) for i, x in ids.items()}) == 0
    for r in out:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4").tobytes())


def test_packing_query_on_whole_table(spark, sf):
    out = queries.op1_packing(spark, sf).collect()
    lengths = {r.doc_id: len(library(WORD, r.text)) + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert check_pieces(out, lengths) == 0


def test_packing_empty_table_repeated_rows_and_null_id(documents):
    assert queries.packed(documents([])).count() == 0
    out = queries.packed(documents([(1, "same text"), (1, "same text"), (None, "x")])).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 2 * out[0].doc_tokens or len(out) == 3
    assert any(r.doc_id is None for r in out)


def test_small_pools_lose_nothing(documents):
    rows = [(i, " ".join(["abc"] * (37 * i % 900))) for i in range(120)]
    out = packing.pack_documents(documents(rows), tokenizer=WORD, end_id=2, window=512, bins=32, pool_tokens=3000)
    assert check_pieces(out.collect(), {i: len(library(WORD, t)) + 1 for i, t in rows}, 512) == 0


def test_many_small_partitions_make_few_short_sequences(documents):
    rows = [(i, " ".join(["abc"] * (37 * i % 900))) for i in range(400)]
    out = packing.pack_documents(documents(rows, partitions=64), tokenizer=WORD, end_id=2, window=512, bins=32).collect()
    lengths = {i: len(library(WORD, t)) + 1 for i, t in rows}
    assert check_pieces(out, lengths, 512) == 0
    size = defaultdict(int)
    for r in out:
        size[r.sequence_id] += r.length
    assert sum(n < 512 for n in size.values()) <= 9 and len(size) <= sum(lengths.values()) // 512 + 10


def test_combinations_and_nnls():
    c = packing.combinations_filling(8, 3)
    assert sorted(map(tuple, c)) == sorted({tuple(np.bincount(p, minlength=9)[1:]) for a in range(1, 9) for b in range(9) for d in range(9)
                                            if a + b + d == 8 for p in [[x for x in (a, b, d) if x]]})
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 20)), rng.random(12)
    x = packing.nnls(a, b)
    grad = a.T @ (a @ x - b)
    assert (x >= 0).all() and (grad > -1e-6).all() and np.abs(grad[x > 1e-9]).max() < 1e-6


@pytest.mark.parametrize("lengths", [[5], [4095] * 7, [64] * 400, list(range(1, 2000, 7)), [2500] * 50])
def test_pack_lengths_places_every_unit_once(lengths):
    seqs = packing.pack_lengths(np.array(lengths), 4096, packing.combinations_filling(64, 3))
    spans = defaultdict(list)
    for s in seqs:
        assert 0 < sum(b - a for _, a, b in s) <= 4096
        for p, a, b in s:
            spans[p].append((a, b))
    for p, n in enumerate(lengths):
        at = 0
        for a, b in sorted(spans[p]):
            assert a == at
            at = b
        assert at == n
    assert sum(sum(b - a for _, a, b in s) < 4096 for s in seqs) <= 1


def test_transducer_counts_equal_library(odd_texts):
    m = fst.Transducer(WORD, max_states=500)
    for t in odd_texts:
        t = t or ""
        n = len(library(WORD, t))
        assert m.total(m.state_map(t)) == n
        chunks = [t[i: i + 5] for i in range(0, len(t), 5)] or [""]
        assert m.total(m.scan([m.state_map(c) for c in chunks])) == n


@pytest.mark.parametrize("text", ["".join(chr(97 + (i * i + i // 7) % 26) for i in range(60_000)), "".join("abcdef0123456789"[(i * 7 + i // 3) % 16] for i in range(60_000)),
                                  "日本語テキスト" * 8_000, "+/" * 30_000])
def test_unbroken_texts_in_bounded_memory(text):
    """Long texts without white space: as many states as allowed, whatever the length, and the library's count."""
    m = fst.Transducer(WORD, max_states=2_000)
    chunks = [text[i: i + 4096] for i in range(0, len(text), 4096)]
    assert m.total(m.scan([m.state_map(c) for c in chunks])) == len(library(WORD, text))
    assert len(m.states) <= 2 * m.max_states + 1 and all(len(w) <= 64 for w in m.words)
    if "0" in text:  # digits are borders, so chunks are counted where they are cut
        assert all(len(m.state_map(c)[0]) < 100 for c in chunks)


def test_state_maps_compose_associatively():
    m = fst.Transducer(WORD)
    a, b, c = (m.state_map(x) for x in ("ab cd", "ef", "gh ij k"))
    assert m.compose(m.compose(a, b), c) == m.compose(a, m.compose(b, c)) == m.state_map("ab cdefgh ij k")


def test_token_counts_operator(documents, odd_texts):
    rows = [*enumerate(odd_texts), (None, "no id"), (3, "a")]
    want = sorted((-1 if i is None else i, len((t or "").encode()), len(library(WORD, t))) for i, t in rows)
    for chunk in (16_384, 11):
        got = fst.token_counts(documents(rows, extra=True), tokenizer=WORD, limit=2048, chunk_chars=chunk).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert fst.token_counts(documents([]), tokenizer=WORD, limit=1).count() == 0


def test_token_counts_query_on_whole_table(spark, sf):
    got = {r.doc_id: r.n_tokens for r in queries.op3_token_counts(spark, sf).collect()}
    assert got == {r.doc_id: len(library(WORD, r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def token_rows(rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(BYTE, t), 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_query_on_whole_table(spark, sf):
    got = sorted(map(tuple, queries.op7_token_files(spark, sf).collect()))
    assert got == token_rows([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_token_files_round_trip_and_pruning(spark, documents, odd_texts, tmp_path):
    import glob

    import pyarrow.orc as po

    path = str(tmp_path / "tokens")
    rows = [(7 * i, t) for i, t in enumerate(odd_texts * 40)]
    token_files.write_token_files(documents(rows, extra=True), path, tokenizer=BYTE, end_id=0, partitions=3)
    files = token_files.read_token_files(spark, path)
    got = [tuple(r) for r in token_files.with_starts(token_files.digests(files)).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()]
    assert got == token_rows(rows)
    one = files.filter("doc_id = 49").select("ids").collect()
    assert [r.ids for r in one] == [[*library(BYTE, odd_texts[7]), 0]]
    plan = files.filter("doc_id = 49")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,49)" in plan
    order = [po.ORCFile(f).read(columns=["doc_id"]).column(0).to_pylist() for f in sorted(glob.glob(path + "/*.orc"))]
    flat = [x for part in order for x in part]
    assert flat == sorted(flat) and len(flat) == len(rows)


def test_a_lookup_of_an_absent_id_reads_no_row(spark, documents, tmp_path):
    """Within the range of the ids, so that only the Bloom filters can tell; and the row index narrows a lookup that hits."""
    path = str(tmp_path / "t")
    token_files.write_token_files(documents([(2 * i, f"text {i}") for i in range(6000)]), path, tokenizer=BYTE, end_id=0, partitions=2, index_rows=1000)

    def read(condition):
        df = token_files.read_token_files(spark, path).filter(condition)
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return len(rows), leaves.apply(0).metrics().get("numOutputRows").get().value()

    absent = [read(f"doc_id = {i}") for i in (4001, 5003, 777, 9999)]
    assert all(n == 0 for n, _ in absent) and sum(seen == 0 for _, seen in absent) >= 3  # a Bloom filter may err
    hits, seen = read("doc_id = 4000")
    assert hits == 1 and 1 <= seen <= 1000


def test_an_id_with_a_third_of_the_rows_is_dealt_to_many_files(spark, documents, tmp_path):
    rows = [(50, f"hot {i % 40} text") for i in range(400)] + [(i, f"cold {i}") for i in range(800)] + [(50, "same")] * 100
    path = str(tmp_path / "t")
    token_files.write_token_files(documents(rows, partitions=6), path, tokenizer=BYTE, end_id=0, partitions=8)
    files = token_files.read_token_files(spark, path)
    per = {r["part"]: r["count"] for r in files.filter("doc_id = 50").groupBy("part").count().collect()}
    assert sum(per.values()) == 501 and len(per) >= 3 and max(per.values()) < 350
    got = token_files.with_starts(token_files.digests(files)).orderBy("start").collect()
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    assert sorted((r.doc_id, r.ids_crc32) for r in got) == sorted((i, zlib.crc32(np.array([*library(BYTE, t), 0], "<u4").tobytes())) for i, t in rows)


def test_token_files_empty_repeated_and_null_ids(spark, documents, tmp_path):
    token_files.write_token_files(documents([]), str(tmp_path / "none"), tokenizer=BYTE, end_id=0, partitions=2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    rows = [(2, "b c"), (2, "b c"), (None, None)]
    token_files.write_token_files(documents(rows), str(tmp_path / "some"), tokenizer=BYTE, end_id=0, partitions=2)
    got = token_files.with_starts(token_files.digests(token_files.read_token_files(spark, str(tmp_path / "some"))))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens) for r in got.collect()) == [(-1, 0, 1), (2, 1, 3), (2, 4, 3)]
