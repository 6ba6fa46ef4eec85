"""Toxicity, WARC archives and the pipeline."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from cadence.llm import queries, toxicity, warc_zip


# ---- toxicity ------------------------------------------------------------------------------------

def labelled(spark, documents, rows):
    docs = documents([(i, t) for i, t, _ in rows], extra=True)
    return docs, spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def corpus(n=400, bias=True, insults=1.0):
    rng, rows = random.Random(1), []
    plain = [f"word{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    for i in range(n):
        y = int(i % 3 == 0)
        words = [rng.choice(plain) for _ in range(40)]
        if y and rng.random() < insults:
            words += rng.sample(["idiotic", "vilest", "scummy", "trashy"], 2)
        if bias and rng.random() < (0.8 if y else 0.1):
            words.append("muslims")  # a group mention that goes with the label in this sample
        rng.shuffle(words)
        rows.append((i, " ".join(words), y))
    return rows


def test_held_out_accuracy(spark, documents):
    rows = corpus()
    docs, labels = labelled(spark, documents, rows)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i].held_out == held(i) for i, _, _ in rows)
    own = [(got[i].score, y) for i, _, y in rows if held(i)]
    assert auc(np.array([s for s, _ in own]), np.array([y for _, y in own])) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_query_on_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    assert got.keys() == docs.keys() and all(r.held_out == held(i) and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    lab = [(r.doc_id, r.toxic) for r in queries.table(spark, sf, "labels").collect() if r.doc_id in docs and held(r.doc_id)]
    score, y = np.array([got[i].score for i, _ in lab]), np.array([t for _, t in lab])
    assert auc(score, y) > 0.97
    # A seventh of the toxic labels here stand by junk without a toxic word, which no feature of a text can tell.
    assert (score[y == 1] >= 0.7).mean() > 0.8 and (score[y == 0] >= 0.7).mean() < 0.01


def test_the_fit_is_bounded_in_rows(spark, documents, monkeypatch):
    """One labelled id has 3,000 rows; the matrix on the driver stays within twice the bound."""
    rows = [(1, f"idiotic text {i}", 1) for i in range(3000)] + [(i, f"plain word{i % 40} and word{i % 7}" + (" vilest" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(2, 400)]
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, y in {i: y for i, _, y in rows}.items()], "doc_id long, quality int, toxic int")
    seen, solve = [], toxicity.solve
    monkeypatch.setattr(toxicity, "solve", lambda x, *a, **k: seen.append(x.shape[0]) or solve(x, *a, **k))
    toxicity.fit(docs, labels, fit_rows=100)
    assert seen and seen[0] <= 200


def test_each_term_meets_its_whole_group():
    got = toxicity.counterfactuals("the muslims and the word")
    line = next(x.split() for x in toxicity.IDENTITY if "muslims" in x.split())
    assert len(got) == len(line) - 1 and {f for _, gained in got for f in gained if f.endswith("=")} == {t + "=" for t in line if t != "muslims"}


def test_counterfactual_penalty_takes_weight_off_group_mentions(spark, documents):
    docs, labels = labelled(spark, documents, corpus(insults=0.5))
    plain, fair = (toxicity.fit(docs, labels, cf=c) for c in (0.0, 5.0))
    neutral, other = "worda of wordb by muslims", "worda of wordb by hindus"
    gap = [m.score(neutral) - m.score(other) for m in (plain, fair)]
    assert gap[0] > 0.02 and gap[1] < gap[0] / 2
    assert fair.score("worda idiotic vilest wordb") > 0.7 > fair.score(neutral) < plain.score(neutral)


def test_labels_of_held_out_rows_are_not_learned(spark, documents):
    rows = corpus(bias=False)
    flipped = [(i, t, 1 - y if held(i) else y) for i, t, y in rows]
    models = [toxicity.fit(*labelled(spark, documents, r)) for r in (rows, flipped)]
    assert models[0].weights == models[1].weights and models[0].bias == models[1].bias


def test_toxicity_edges(spark, documents, odd_texts):
    rows = corpus(90, bias=False)
    _, labels = labelled(spark, documents, rows)
    docs = documents([*((i, t) for i, t, _ in rows), *((1000 + i, t) for i, t in enumerate(odd_texts)), (None, "x"), (5, rows[5][1])], extra=True)
    got = toxicity.toxicity(docs, labels.unionByName(spark.createDataFrame([(1, 1, None), (None, 1, 1)], labels.schema))).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    empty = labels.limit(0)
    assert {r.score < 1e-9 for r in toxicity.toxicity(docs, empty).collect()} == {True}
    assert toxicity.toxicity(documents([]), labels).count() == 0
    kept = toxicity.non_toxic(docs, labels)
    assert kept.columns == docs.columns


def test_solve_reaches_a_stationary_point():
    rng = np.random.default_rng(3)
    x = (rng.random((80, 6)) < 0.4).astype(float)
    y = (rng.random(80) < 0.3).astype(float)
    delta = (rng.random((10, 6)) < 0.3).astype(float)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        wt = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
        return (wt * (np.logaddexp(0, z) - y * z)).sum() + 0.01 * (w[:-1] ** 2).sum() + 0.5 * ((delta @ w[:-1]) ** 2).mean()

    w = toxicity.solve(x, y, delta, l2=0.01, cf=0.5)
    for k in range(7):
        for step in (1e-3, -1e-3):
            v = w.copy()
            v[k] += step
            assert loss(v) >= loss(w) - 1e-12


# ---- WARC ----------------------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}", h, "x") for i, h in rows], "page_id long, url string, html string, record_type string").repartition(3)


def read_back(spark, df, tmp_path, **kw):
    folder = str(tmp_path / "a")
    arch = warc_zip.write_archives(df, folder, **kw).collect()
    return arch, warc_zip.read_archives(spark.createDataFrame(arch, "path string, records long"), folder, run_bytes=3000).collect()


def test_archives_round_trip_with_revisits(spark, tmp_path):
    big, other = "<p>é</p>" * 200, "y" * 1000
    rows = [(1, big), (5, big), (9, big), (2, other), (3, "y" * 999), (4, "y" * 999), (6, None), (7, ""), (8, "a\r\n\r\nb"), (9, big), (None, big), (2**60 + 1, "z" * 2000), (2**60, "z" * 2000)]
    arch, got = read_back(spark, pages(spark, rows), tmp_path, archive_bytes=400)
    assert len(arch) > 3 and sum(a.records for a in arch) == len(rows)
    want = []
    for i, h in rows:
        p = (h or "").encode()
        keep = max(x for x, y in rows if y == h and x is not None)
        ref = keep if len(p) >= 1000 and i != keep else None
        want.append((str(i), len(p), hashlib.sha1(p).hexdigest(), "revisit" if ref is not None else "response", str(ref), None if ref is not None else p))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), None if r.payload is None else bytes(r.payload)) for r in got) == sorted(want, key=lambda r: r[:5])


def test_archives_are_zip64_files(spark, tmp_path):
    import zipfile
    arch, _ = read_back(spark, pages(spark, [(i, f"page {i} " * 50) for i in range(20)]), tmp_path)
    for a in arch:
        with zipfile.ZipFile(a.path) as z:
            assert z.testzip() is None and [x.compress_type for x in z.infolist()] == [0, 0]
            assert z.namelist() == [warc_zip.DATA, warc_zip.INDEX]


def test_reader_takes_plain_zip_files(tmp_path):
    import io
    import zipfile
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k in range(300):
            z.writestr(f"m{k}", b"x" * k)
        z.comment = b"a comment with PK\x05\x06 inside"
    raw = buf.getvalue()
    got = warc_zip.central_directory(io.BytesIO(raw), len(raw))
    assert len(got) == 300 and got["m7"][:2] == (0, 7)
    f = io.BytesIO(raw)
    at = warc_zip.member_start(f, got["m7"][2])
    assert raw[at: at + 7] == b"x" * 7


def test_zip64_offsets_past_four_gigabytes(tmp_path):
    """A sparse file: the second member lies behind 5 GB of nothing."""
    path, far = tmp_path / "far.zip", 5 * 2**30
    members = [(b"a", 0, far - 100, 0), (b"b", zlib.crc32(b"hello"), 5, far)]
    with open(path, "wb") as f:
        f.write(warc_zip.local_header(*members[0][:3]))
        f.seek(far)
        f.write(warc_zip.local_header(*members[1][:3]) + b"hello")
        f.write(warc_zip.directory(members, f.tell()))
    with open(path, "rb") as f:
        size = f.seek(0, 2)
        got = warc_zip.central_directory(f, size)
        assert got == {"a": (0, far - 100, 0), "b": (0, 5, far)}
        f.seek(warc_zip.member_start(f, got["b"][2]))
        assert f.read(5) == b"hello"


@pytest.mark.parametrize("cut", [10, 60])
def test_cut_archives_are_refused(spark, tmp_path, cut):
    import io
    arch, _ = read_back(spark, pages(spark, [(1, "x")]), tmp_path)
    raw = open(arch[0].path, "rb").read()[:-cut]
    with pytest.raises((ValueError, struct.error)):
        warc_zip.central_directory(io.BytesIO(raw), len(raw))


def archive_of(files, indexes, path):
    """A ZIP of stored members with the given archive files ({name: [raw records]}) and indexes ({name: bytes})."""
    members, body = [], b""
    for name, data in [*((f"archive/{n}", b"".join(r)) for n, r in files.items()), *((f"indexes/{n}", x) for n, x in indexes.items()), ("datapackage.json", b"{}")]:
        members.append((name.encode(), zlib.crc32(data), len(data), len(body)))
        body += warc_zip.local_header(name.encode(), zlib.crc32(data), len(data)) + data
    path.write_bytes(body + warc_zip.directory(members, len(body)))


def test_archives_with_several_members_and_indexes(spark, tmp_path):
    import gzip
    import json

    def raw(i):
        text = f"page {i}".encode() * (i + 1)
        return gzip.compress(warc_zip.record("response", i, f"u{i}", hashlib.sha1(text).hexdigest(), text, len(text), None), mtime=0)

    files = {"a.warc.gz": [raw(i) for i in range(5)], "b.warc.gz": [raw(i) for i in range(5, 9)]}

    def lines(name, prefix=""):
        at, out = 0, ""
        for r in files[name]:
            out += prefix + json.dumps({"filename": name, "offset": str(at), "length": str(len(r))}) + "\n"
            at += len(r)
        return out.encode()

    archive_of(files, {"one.cdxj": lines("a.warc.gz", "com,x)/ 2024 "), "two.cdx.gz": gzip.compress(b"!meta\n" + lines("b.warc.gz"))}, tmp_path / "x.wacz")
    paths = spark.createDataFrame([(str(tmp_path / "x.wacz"),)], "path string")
    got = sorted((r.page_id, r.payload_bytes, bytes(r.payload)) for r in warc_zip.read_archives(paths, str(tmp_path), run_bytes=150).collect())
    assert got == [(i, len(f"page {i}") * (i + 1), f"page {i}".encode() * (i + 1)) for i in range(9)]
    for indexes, said in (({"one.cdxj": lines("a.warc.gz")}, "no index names"), ({"one.cdxj": lines("a.warc.gz") + lines("b.warc.gz").replace(b"b.warc", b"c.warc")}, "points outside")):
        archive_of(files, indexes, tmp_path / "y.wacz")
        fs, name = warc_zip.opened(str(tmp_path / "y.wacz"))
        with fs.open_input_file(name) as f, pytest.raises(ValueError, match=said):
            warc_zip.located(f, "y")


def test_no_pages_no_archives(spark, tmp_path):
    arch, got = read_back(spark, pages(spark, [(1, "x")]).limit(0), tmp_path)
    assert arch == [] and got == []


# ---- pipeline ------------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf):
    import corpus_pipeline as c
    from cadence.llm import decontam, quality, simhash
    from cadence.llm.store import written
    assert [n for n, _ in c.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("benchmark", "labels"))
    verdicts = [
        lambda d: {r.doc_id for r in quality.quality_report(d).filter("kept").collect()},
        lambda d: {r.doc_id for r in toxicity.toxicity(d, labels).filter("predicted = 0").collect()},
        lambda d: {r.component_id for r in simhash.near_duplicates(d).collect()},
        lambda d: {r.doc_id for r in decontam.contamination(d, bench).filter("not contaminated").collect()},
    ]
    for (name, stage), verdict in zip(c.STAGES, verdicts, strict=False):
        out = written(stage(spark, docs, sf), "test-" + name)
        assert out.columns == docs.columns
        kept = {r.doc_id: r.text for r in out.collect()}
        before = {r.doc_id: r.text for r in docs.collect()}
        assert kept.keys() == verdict(docs) and len(kept) < len(before) and all(before[i] == t for i, t in kept.items())
        docs = out
    pieces = c.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == set(kept) and len(queries.pipeline(spark, sf).collect()) == len(pieces)


def write_tables(spark, folder, docs, labels, bench):
    schemas = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int",
               "benchmark": "item_id long, text string"}
    for name, rows in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        spark.createDataFrame(rows, schemas[name]).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_end_to_end_on_planted_rows(spark, tmp_path, sf):
    """What must go goes, what must stay stays, and the packed ids are the library's; no operator is asked."""
    import random
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(2, 8))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(vocabulary[:60] if rng.random() < 0.5 else vocabulary) for _ in range(n)).capitalize() + "."

    good = {i: prose(rng.randint(80, 160)) for i in range(300)}
    toxic = {1000 + i: prose(40) + f" grobnik{'s' if i % 2 else ''} vermin scum " + prose(40) for i in range(80)}
    passage = prose(30)
    bad = {2000: "too short", 2001: "", 2002: None, 2003: "again and again we say " * 30, 2004: prose(50) + " " + passage + " " + prose(50)}
    copies = {3000 + i: good[0] for i in range(40)}
    docs = [(i, t) for part in (good, toxic, bad, copies) for i, t in part.items()]
    twice = [(7, prose(120)), (7, prose(90)), (None, prose(100))]  # id 7 once more with other texts, and a row without an id
    rows = [(i, t, "en", f"s{k % 5}", None) for k, (i, t) in enumerate(docs + twice)]
    labels = [(i, 1, int(i >= 1000)) for i in [*range(1, 300), *toxic]]
    folder = write_tables(spark, tmp_path / "t", rows, labels, [(1, passage), (2, None), (3, "")])
    got = queries.pipeline(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert ids == set(good) | {None}, (sorted(set(good) - ids), sorted(i for i in ids if i not in good and i is not None))
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [(i, t) for i, t in good.items()] + twice
    want = sorted(str((i, zlib.crc32(np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()))) for i, t in texts)
    # Rows of one id are told apart by their length; whole documents are compared where they lie in one piece.
    whole = sorted(str((r.doc_id, r.ids_crc32)) for r in got if r.start == 0 and r.length == r.doc_tokens)
    assert set(whole) <= set(want) and len(whole) > len(want) // 2
    sizes = sorted(str((i, len(tok.encode(t, add_special_tokens=False).ids) + 1)) for i, t in texts)
    assert sorted(str((r.doc_id, r.doc_tokens)) for r in got if r.start == 0) == sizes
    assert sum(r.length for r in got) == sum(int(x.split(", ")[1][:-1]) for x in sizes)


def test_pipeline_of_empty_tables(spark, tmp_path):
    folder = write_tables(spark, tmp_path / "e", [], [], [])
    assert queries.pipeline(spark, folder).collect() == []
