"""SimHash, decontamination, quality rules, licences and sharding against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadence.llm import decontam, licenses, quality, queries, sharding, simhash

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
CORE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---- SimHash -------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = SPACE_WORD.findall((text or "").translate(AZ))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=4):
    lab = list(range(len(ids)))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                lab[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}


def test_simhash_query_on_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op2_simhash(spark, sf).collect()}
    fps = [brute_fingerprint(r.text) for r in docs]
    comp = brute_components(fps, [r.doc_id for r in docs])
    assert got == {r.doc_id: (f, comp[r.doc_id]) for r, f in zip(docs, fps, strict=True)}


def test_simhash_edges(documents, odd_texts):
    rows = [*enumerate(odd_texts), (3, "a"), (100, " "), (None, "one two")]
    got = simhash.near_duplicates(documents(rows, extra=True)).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "fingerprint", "component_id"}
    zero = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero.keys() >= {0, 1, 2, 100} and set(zero.values()) == {0}
    assert {r.component_id for r in got if r.doc_id is None} == {4}
    assert simhash.near_duplicates(documents([])).count() == 0
    kept = simhash.one_per_group(documents(rows, extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got})


def test_only_rows_without_ids(documents):
    got = simhash.near_duplicates(documents([(None, "one two"), (None, "one two"), (None, "three")])).collect()
    assert {r.component_id for r in got} == {None}
    assert simhash.one_per_group(documents([(None, "one two"), (None, "one two"), (None, "three")])).count() == 2


def test_one_per_group_keeps_rows_of_one_id_in_other_groups(documents):
    """A repeated id with unrelated texts: each group keeps a row; within a group the choice does not depend on the layout."""
    a, b, c = "the quick brown fox jumps over the lazy dog again", "completely different words stand in this second text", "a third one about trains and boats and planes"
    rows = [(1, a), (1, b), (1, b), (2, a), (2, c), (3, c), (None, c), (None, "only without an id at all here")]
    kept = {sorted((str(r.doc_id), r.text) for r in simhash.one_per_group(documents(rows, extra=True, partitions=n)).collect()).__repr__() for n in (1, 3, 7)}
    assert kept == {repr(sorted([("1", a), ("1", b), ("2", c), ("None", "only without an id at all here")]))}
    near = "the quick brown fox jumps over the lazy dog again and again and again until the end of the day comes near to us all"
    both = [(5, near), (5, near + " now")]  # one id, two texts of one group
    apart = (brute_fingerprint(both[0][1]) ^ brute_fingerprint(both[1][1])).bit_count()
    kept = [simhash.one_per_group(documents(both * 3, partitions=n)).collect() for n in (1, 4)]
    assert len(kept[0]) == (1 if apart <= 4 else 2) and sorted(r.text for r in kept[0]) == sorted(r.text for r in kept[1])
    assert simhash.one_per_group(documents([])).count() == 0


@pytest.mark.parametrize("tile_rows", [16_384, 5])
def test_links_reach_what_brute_force_reaches(spark, tile_rows):
    rng = random.Random(4)
    fps = []
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            fps.append(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    want = brute_components(fps, fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius=4, tile_rows=tile_rows)
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    groups = defaultdict(set)
    for f, s in zip(fps, signed, strict=True):
        groups[root.get(s, s)].add(f)
    brute = defaultdict(set)
    for f in fps:
        brute[want[f]].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, n + 1)}


def test_forest_tiles_skip_no_link():
    rng = np.random.default_rng(0)
    fps = rng.integers(-2**62, 2**62, 60)
    fps = np.unique(np.concatenate([fps, fps ^ 3, fps ^ (1 << 40)]))
    big, small = (simhash.forest(fps, 4, tile=t) for t in (1024, 7))
    assert len(big) == len(small) == 120


def test_forest_of_a_dense_group():
    """All pairs of 2,000 fingerprints are links; the forest has one link fewer than it has nodes, and no link is walked one by one."""
    import time
    rng = np.random.default_rng(1)
    fps = np.unique(np.array([(1 << rng.integers(0, 62)) | (1 << rng.integers(0, 62)) for _ in range(6000)], np.int64))[:1500]
    start = time.time()
    links = simhash.forest(fps, 4)
    assert len(links) == len(fps) - 1 and len({x for link in links for x in link}) == len(fps)
    assert all((a ^ b).bit_count() <= 4 for a, b in links) and time.time() - start < 5
    half = simhash.forest(fps[:700], 4, other=fps[700:])
    assert len(half) == len(fps) - 1


# ---- decontamination -----------------------------------------------------------------------------

def brute_hits(text, items, n=10):
    w, hit, found = CORE_WORD.findall((text or "").translate(AZ)), set(), set()
    for item, t in items:
        b = CORE_WORD.findall((t or "").translate(AZ))
        for win in {tuple(b[i: i + n]) for i in range(max(1, len(b) - n + 1))} if b else ():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i: i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it sleeps a while"), (20, "Short item"), (3, "the the the the the the the the the the the"),
         (4, None), (5, ""), (6, "É one two three four five six seven eight nine ten"), (20, "Short item"), (7, "quick brown fox jumps over the lazy dog and then")]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_decontamination_against_brute_force(spark, documents, odd_texts, limit):
    rows = [*enumerate(odd_texts), (50, "x The QUICK, brown fox jumps over the lazy dog; and then it sleeps a while y"), (51, "short ITEM short item"), (52, "the " * 30),
            (53, "é one two three four five six seven eight nine ten"), (54, "É one two three four five six seven eight nine ten"), (55, "item short"), (50, "Short item"), (None, "short item")]
    got = decontam.contamination(documents(rows, extra=True), bench(spark, ITEMS), broadcast_bytes=limit).collect()
    want = []
    for i, t in rows:
        n, h, items = brute_hits(t, ITEMS)
        want.append((str(i), n, h, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), h > 0))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    clean = decontam.clean_documents(documents(rows, extra=True), bench(spark, ITEMS), broadcast_bytes=limit).collect()
    assert sorted(str(r.doc_id) for r in clean) == sorted(str(i) for i, t in rows if not brute_hits(t, ITEMS)[1])


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_decontamination_cuts_a_text_once_for_its_hits(spark, documents, limit):
    """Spark adds a filter that cuts the words a second time to a generator that drops empty lists."""
    d = documents([(1, "a b")]).select(F.col("doc_id").cast("string").alias("row_key"), "text")
    found = decontam.hits(d, bench(spark, ITEMS), n=10, broadcast_bytes=limit)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Generate posexplode" in x for x in plan) and not [x for x in plan if "Filter" in x and "size(regexp_extract_all(" in x]


def test_words_of_decontamination_character_by_character(spark):
    """Every character is a word's or not as in the contract, and no range is left in the class, which Java tests one by one."""
    chars = [chr(c) for c in [*range(1, 0x300), 0x2028, 0x3042, 0xFFFD, 0x1F600]]
    text = "".join(f"{c} x{c}y\n" for c in chars)
    got = spark.createDataFrame([(text,)], "text string").select(decontam.raw_words(F.col("text")).alias("w")).first().w
    assert got == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
    assert "-" not in decontam.RAW_WORD


def test_decontamination_of_empty_tables(spark, documents):
    assert decontam.contamination(documents([]), bench(spark, ITEMS)).count() == 0
    assert [r.n_hit for r in decontam.contamination(documents([(1, "a b")]), bench(spark, [])).collect()] == [0]


# ---- quality -------------------------------------------------------------------------------------

def brute_base(text):
    t = text or ""
    w = SPACE_WORD.findall(t)
    win = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    rep = {i + k for i in range(len(w) - 4) if win[tuple(w[i: i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w))


def test_quality_base_rules(documents, odd_texts):
    rng = random.Random(2)
    rows = [*enumerate(odd_texts), (30, "a b c d e a b c d e x"), (31, "l one\nl two\nl one\n\n \nl one"), (32, "# $ %% a|b <x>"), (33, "a a a a a a a"), (None, "x")]
    rows += [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    got = quality.quality_report(documents(rows, extra=True)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted((str(i), *brute_base(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality_report(documents([])).count() == 0


def test_quality_divergence(documents):
    rng = random.Random(5)
    common, rare = ["the", "of", "and", "to", "in"], [f"thing{i}" for i in range(400)]

    def text(p):
        return " ".join(rng.choice(common) if rng.random() < p else rng.choice(rare) for _ in range(120))

    rows = [(i, text(0.5)) for i in range(60)] + [(200, text(0.0)), (201, text(0.5).upper()), (202, "only short, no reference is asked for it here, so it passes all right")]
    rows += [(300, text(0.0), None)]
    got = {r.doc_id: r for r in quality.quality_report(documents(rows)).collect()}
    assert all(got[i].kept for i in range(60)) and not got[200].kept and not got[201].kept
    assert got[202].kept and got[202].word_distance is None and got[202].class_distance is None
    assert got[300].word_distance is None  # its language has too little text for a reference
    kept = quality.kept_documents(documents(rows, extra=True))
    assert kept.columns == documents(rows, extra=True).columns and kept.count() == sum(r.kept for r in got.values())


def test_quality_reference_withstands_a_junk_source_of_a_third_of_the_rows(documents):
    from pyspark.sql import functions as F
    rng = random.Random(7)
    common, rare = ["the", "of", "and", "to", "in"], [f"thing{'abcdefghij'[i % 10] * (i // 10 % 9)}{'klmnopqrst'[i // 90]}" for i in range(400)]

    def text(mark=""):
        return " ".join((rng.choice(common) if rng.random() < 0.5 else rng.choice(rare)) + mark for _ in range(120))

    rows = [(i, text()) for i in range(120)] + [(200 + i, text("$%&#*")) for i in range(60)] + [(300 + i, " ".join(f"{'qrstuvwxyz'[i % 10]}{k}" for k in range(120))) for i in range(60)]
    source = F.when(F.col("doc_id") >= 300, "keywords").when(F.col("doc_id") >= 200, "symbols").otherwise(F.concat(F.lit("good"), F.col("doc_id") % 6))
    for junk in ("symbols", "keywords"):
        got = quality.quality_report(documents(rows).withColumn("source", source).filter(F.col("source").startswith("good") | (F.col("source") == junk))).collect()
        assert len(got) == 180 and all(r.kept == (r.doc_id < 200) for r in got), junk


def test_quality_words_of_another_language_or_of_none(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = [r for r in docs if label.get(r.doc_id) == 1 and not brute_base(r.text)[-1] and brute_base(r.text)[0] >= 200]
    rows, other = [(r.doc_id, r.text, r.lang) for r in docs], {}
    for r in [x for k in ("en", "de", "es", "fr") for x in [g for g in good if g.lang == k][:5]]:
        for lang in {"en", "de", "es", "fr"} - {r.lang} if r.lang in ("en", "de") else ("en", "de"):
            other[10**6 + len(other)] = (r.text, lang)
    plain = {2 * 10**6 + n: (" ".join(f"{'abcdefghij'[k % 10]}word{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}" for k in range(n)), "en") for n in (40, 60, 100, 200, 400)}
    got = {r.doc_id: r for r in quality.quality_report(documents([*rows, *[(i, *x) for x_ in (other, plain) for i, x in x_.items()]], partitions=8)).collect()}
    assert len(other) >= 40 and not any(got[i].kept for i in other) and not any(got[i].kept for i in plain)
    assert all(got[r.doc_id].kept for r in good)


def test_quality_words_lose_punctuation_at_their_edges(spark):
    from pyspark.sql import functions as F
    t = '"The, (end). | -- isn\'t x% É! of%%% ...a-b...'
    assert spark.createDataFrame([(t,)], "t string").select(quality.core_list(F.col("t"))).first()[0] == ["the", "end", "isn't", "x", "é", "of", "a-b"]


def test_js_distance(spark):
    from pyspark.sql import functions as F
    p, q = [0.5, 0.5, 0.0], [0.1, 0.2, 0.7]
    got = spark.range(1).select(quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q))).alias("d"), quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, p))).alias("z")).first()
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    want = math.sqrt(sum(x * math.log2(x / y) for v in (p, q) for x, y in zip(v, m, strict=True) if x) / 2)
    assert abs(got.d - want) < 1e-12 and got.z == 0


# ---- licences ------------------------------------------------------------------------------------

def brute_license(text):
    w = CORE_WORD.findall((text or "").translate(AZ))
    at = {label: [i for i in range(len(w)) if w[i: i + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
    flat = [i for v in at.values() for i in v]
    return len(w), len(flat), min(flat, default=None), max(flat, default=None), ",".join(sorted(k for k, v in at.items() if v))


TEXTS = ["Licensed under CC BY-NC 4.0.", "x y CC BY cc by", "This work is licensed under the GNU General Public License, version 3.", "All rights reserved. all RIGHTS reserved",
         "general public\nlicense", "generał public license", "Licensed under the Apache License, Version 2.0", "the apache license is fine", "Released under the MIT License",
         "ccK by", "This work was licensed under our GNU General Public License, version 3.", "licensed under the gnu general public license version 4"]


def test_license_scan(documents, odd_texts):
    rows = [*enumerate(TEXTS + odd_texts), (None, "cc by"), (1, TEXTS[1])] + [(500 + i, f"the file {i} is under version of work") for i in range(30)]
    got = licenses.scan(documents(rows, extra=True)).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == sorted(str((i, *brute_license(t))) for i, t in rows)
    by = {r.doc_id: r for r in got}
    assert by[0].labels == "cc-by,cc-by-nc-4.0" and by[0].score == 1
    assert by[2].labels == "gpl,gpl-3.0" and by[6].labels == "apache-2.0" and by[8].labels == "mit"
    assert by[7].labels == "" and by[11].labels == "gpl" and by[10].labels == "gpl,gpl-3.0" and 0.8 <= by[10].score < 1
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in got)
    assert licenses.scan(documents([])).count() == 0


def brute_labels(text):
    """Labels of the templates that stand anywhere in the text, every place tried, also from before its start."""
    w, out = CORE_WORD.findall(text.translate(AZ)), set()
    for label, template, keys in licenses.TEMPLATES:
        t = template.split()
        need = licenses._needed(t, keys)
        for i in range(-len(t), len(w)):
            if all(0 <= i + p < len(w) and w[i + p] == k for p, k in need) and sum(0 <= i + p < len(w) and w[i + p] == x for p, x in enumerate(t)) >= 0.8 * len(t):
                out.add(label)
    return out


WORDINGS = {
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.": {"gpl-3.0"},
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
    "either version 2.1 of the License, or (at your option) any later version.": {"lgpl-2.1"},
    "The MIT License (MIT)\n\nCopyright (c) 2015 Somebody": {"mit"}, "MIT License\n\nCopyright (c) 2020 A": {"mit"}, "Under the MIT License": {"mit"},
    "some words here. Under the MIT License": {"mit"}, "Apache License\nVersion 2.0, January 2004": {"apache-2.0"},
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": {"cc-by-4.0"},
    "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported": {"cc-by-nc-sa-3.0"}, "CC BY 3.0": {"cc-by-3.0"}, "// SPDX-License-Identifier: MIT": {"mit"},
    "SPDX-License-Identifier: GPL-3.0-or-later": {"gpl-3.0"}, "Under the GNU General Public License version 2": {"gpl-2.0"},
    "This documentation material file is subject to the terms of the Mozilla Public License, v. 2.0.": {"mpl-2.0"},
    "the mit campus has a license for the software": set(), "a general public license is a license": set(), "creative commons is a movement": set(),
}


def test_license_wordings(documents):
    base = set(licenses.PHRASES.values())
    rows = list(enumerate(WORDINGS)) + [(100 + i, t.split(" ", 2)[-1]) for i, t in enumerate(WORDINGS)]
    got = {r.doc_id: set(r.labels.split(",")) - base - {""} for r in licenses.scan(documents(rows)).collect()}
    assert {i: got[i] for i in range(len(WORDINGS))} == dict(enumerate(WORDINGS.values()))
    assert got == {i: brute_labels(t) for i, t in rows}


def test_license_bundles_keep_every_notice(documents):
    rng = random.Random(11)
    notices = [t for _, t, _ in licenses.TEMPLATES]
    prose = [w for t in notices for w in t.split()] + ["and", "with", "source", "code", "form", "free", "copy", "any", "general", "work", *[f"word{i}" for i in range(60)]]
    rows = [(0, " x ".join(notices)), (1, " ".join(rng.choice(prose) for _ in range(4000)) + " " + " . y ".join(notices))]
    rows += [(10 + i, " z ".join(rng.sample(notices, 5)) + " " + " ".join(rng.choice(prose) for _ in range(300))) for i in range(30)]
    rows += [(100 + i, "the work with a mit word and mozilla") for i in range(40)]
    base = {label for label in licenses.PHRASES.values()}
    got = {r.doc_id: set(r.labels.split(",")) - base - {""} for r in licenses.scan(documents(rows)).collect()}
    assert got == {i: brute_labels(t) for i, t in rows} and got[0] == {label for label, _, _ in licenses.TEMPLATES}


def test_license_query_base_columns_on_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = queries.op10_licenses(spark, sf).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == sorted(str((r.doc_id, *brute_license(r.text))) for r in docs)


# ---- sharding ------------------------------------------------------------------------------------

def brute_shards(rows, limit):
    def bits(i):
        return bin(int("1" + hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16))[3:]

    out = {}

    def split(part, depth):
        size = sum(len((t or "").encode()) for _, t in part)
        if size <= limit or len(part) == 1:
            for i, t in part:
                out[i] = (len((t or "").encode()), bits(i)[:depth], depth, size, len(part), size > limit)
            return
        for b in "01":
            sub = [r for r in part if bits(r[0])[depth] == b]
            if sub:
                split(sub, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [100, 1000, 10**9])
def test_sharding_against_brute_force(documents, odd_texts, limit):
    rows = [*enumerate(odd_texts), (None, "no id")] + [(100 + i, "t" * (i * 13 % 300)) for i in range(80)]
    got = sharding.shard(documents(rows, extra=True), limit_bytes=limit).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_shards(rows, limit)


def test_sharding_of_a_hot_key(documents):
    rows = [(7, f"text {i} " * 20) for i in range(60)] + [(7, "same " * 20)] * 30 + [(i, "x" * 50) for i in range(20)]
    got = sharding.shard(documents(rows), limit_bytes=2000).collect()
    assert len(got) == len(rows) and not any(r.oversize for r in got)
    size, docs = Counter(), Counter()
    for r in got:
        size[r.shard_id] += r.n_bytes
        docs[r.shard_id] += 1
    assert all(size[r.shard_id] == r.shard_bytes <= 2000 and docs[r.shard_id] == r.shard_docs for r in got)
    ids = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(ids, ids[1:], strict=False))
    assert sharding.shard(documents([]), limit_bytes=10).count() == 0
