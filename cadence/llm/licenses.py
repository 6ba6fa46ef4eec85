"""Licence scan over a positional index of rare words, in DataFrame operations only.

Words are maximal runs of ASCII letters, digits and characters outside ASCII,
with A-Z lowered.

Base labels: ``PHRASES`` are looked for as consecutive words; every place
counts.  The method adds labels of licence templates (``TEMPLATES``: titles,
standard notices and SPDX lines):

1. The document frequency of every template word is counted over all texts.
   A template is indexed by the rarest words (highest IDF) of its mandatory key
   phrases, with their positions.
2. Every indexed word of a file is looked up at each of its places, so a file may
   hold the notices of any number of licences.
3. Postings are intersected by relative position: a template is a candidate at
   the offset (position in the file less position in the template) where all its
   indexed words agree.  They are mandatory, so no notice that step 4 would accept
   is passed over.  The offset may be negative: a file may begin within a notice.
4. The words of a candidate are looked up at their places by a join; the score is
   the share that stands in place.  A label is given if the score is at least
   ``min_score`` and every key phrase of the template stands in place.

The document's score is its best verified template's; a file with base phrases
only has score 0.

Edge cases: null and empty texts have no words, no labels (empty strings) and
score 0; repeated rows are scanned one by one; a null doc_id is carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.decontam import raw_words
from cadence.llm.store import written

#: Fixed values of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Fixed values: (label, template, mandatory key phrases), as they stand in files, in words.
NOTICES = (
    ("mit", "the mit license mit", ("the mit license mit",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("under the mit license",)),
    ("mit", "under the mit license", ("under the mit license",)),
    ("mit", "mit license copyright c", ("mit license copyright",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("bsd", "the 3 clause bsd license", ("3 clause bsd license",)),
    ("bsd", "bsd 3 clause license", ("bsd 3 clause",)),
    ("bsd", "bsd 2 clause license", ("bsd 2 clause",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "apache license version 2 0 january 2004", ("apache license version 2 0",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    ("epl-2.0", "eclipse public license v 2 0", ("eclipse public license v 2 0",)),
    ("epl-2.0", "eclipse public license version 2 0", ("eclipse public license version 2 0",)),
    ("bsl-1.0", "boost software license version 1 0", ("boost software license version 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    ("cc0-1.0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-2.0", "gnu general public license version 2 june 1991", ("gnu general public license version 2 june 1991",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007", ("gnu general public license version 3 29 june 2007",)),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", ("gnu lesser general public license version 2 1",)),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    ("lgpl-3.0", "gnu lesser general public license version 3 29 june 2007", ("gnu lesser general public license version 3 29 june 2007",)),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007", ("gnu affero general public license version 3 19 november 2007",)),
)
#: The notice at the head of files under a GNU licence, and its licences by name and version.
GNU_HEADER = "{program} is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation {version} of the license"
GNU = (("gpl-2.0", "general public license", "version 2"), ("gpl-3.0", "general public license", "version 3"), ("lgpl-2.1", "lesser general public license", "version 2 1"),
       ("lgpl-3.0", "lesser general public license", "version 3"), ("agpl-3.0", "affero general public license", "version 3"))
#: Creative Commons licences by short and full name, their versions, and SPDX identifiers.
CREATIVE_COMMONS = (("by", "attribution"), ("by sa", "attribution sharealike"), ("by nd", "attribution noderivatives"), ("by nd", "attribution noderivs"),
                    ("by nc", "attribution noncommercial"), ("by nc sa", "attribution noncommercial sharealike"), ("by nc nd", "attribution noncommercial noderivatives"),
                    ("by nc nd", "attribution noncommercial noderivs"))
CC_VERSIONS = ("2 0", "2 5", "3 0", "4 0")
SPDX = (("mit", "mit"), ("isc", "isc"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("apache-2.0", "apache 2 0"), ("mpl-2.0", "mpl 2 0"), ("epl-2.0", "epl 2 0"), ("bsl-1.0", "bsl 1 0"),
        ("unlicense", "unlicense"), ("cc0-1.0", "cc0 1 0"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"), ("agpl-3.0", "agpl 3 0"))


def _templates() -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """NOTICES and the templates made of the tables by rule, each once."""
    out = list(NOTICES)
    for label, name, version in GNU:
        for program in ("this program", "this library"):
            for either in ("either ", ""):
                out.append((label, GNU_HEADER.format(program=program, name=name, version=either + version), (f"gnu {name} as published by the free software foundation", f"{version} of the license")))
    for short, name in CREATIVE_COMMONS:
        for version in CC_VERSIONS:
            label = "cc-" + short.replace(" ", "-") + "-" + version.replace(" ", ".")
            for text in (f"cc {short} {version}", f"creative commons {name} {version}"):
                out.append((label, text, (text,)))
    out += [(label, f"spdx license identifier {name}", (f"spdx license identifier {name}",)) for label, name in SPDX]
    return tuple(dict.fromkeys(out))


TEMPLATES = _templates()


def _all(conds) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def scan(docs: DataFrame, *, templates=TEMPLATES, phrases=None, index_words: int = 3, min_score: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of ``docs``."""
    phrases = PHRASES if phrases is None else phrases
    spark = docs.sparkSession
    # One row a template word: its template, place, whether a key phrase asks for it, and the template's sizes.
    shapes = [(t, label, text.split(), dict(_needed(text.split(), keys))) for t, (label, text, keys) in enumerate(templates)]
    tw = spark.createDataFrame([(t, label, p, w, p in need, len(words), len(need)) for t, label, words, need in shapes for p, w in enumerate(words)],
                               "t int, label string, p int, word string, key boolean, n_all int, n_key int")
    base_words = sorted({w for p in phrases for w in p.split()})
    lexicon = sorted({w for _, _, words, _ in shapes for w in words} | set(base_words))
    # Only words of the lexicon matter from here on: (position, word) pairs, and the number of words. Texts are read once.
    # Template words are ASCII: a word with a character outside ASCII is none of them, whatever its lower case.
    d = docs.select("doc_id", "text").select(F.monotonically_increasing_id().alias("row_key"), "doc_id", "text")
    words = F.transform(raw_words(F.col("text")), lambda w, i: F.when((F.length(w) == F.octet_length(w)) & F.lower(w).isin(*lexicon),
                                                                      F.struct(i.alias("pos"), F.lower(w).alias("word"))))
    d = d.select("row_key", "doc_id", words.alias("w")).select("row_key", "doc_id", F.size("w").cast("long").alias("n_words"), F.filter("w", lambda x: x.isNotNull()).alias("hit"))
    found = written(d.withColumn("own", F.filter("hit", lambda x: x["word"].isin(*base_words))), "license-words")

    base = found.select("row_key", "doc_id", "n_words", F.array(*[
        F.struct(F.lit(label).alias("label"), _phrase_places("own", p.split()).alias("at")) for p, label in phrases.items()]).alias("base"))
    flat = F.flatten(F.transform("base", lambda b: b["at"]))
    base = base.select("row_key", "doc_id", "n_words", F.size(flat).cast("long").alias("n_base"), F.array_min(flat).cast("long").alias("first_word"), F.array_max(flat).cast("long").alias("last_word"),
                       F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"]).alias("base_list"))

    # IDF of the template words over all files.
    seen = found.select("row_key", F.explode(F.array_distinct(F.transform("hit", lambda x: x["word"]))).alias("word"))
    df = seen.groupBy("word").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("t").orderBy(F.coalesce("df", F.lit(0)), "word", "p")
    postings = tw.filter("key").join(df, "word", "left").withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= index_words)
    # At most index_words postings a template: a table bounded by the templates.
    index = written(postings.select("t", "p", "word", F.least(F.lit(index_words), "n_key").alias("n_index")), "license-index")
    rare = [r["word"] for r in index.select("word").distinct().collect()]  # a few for each template
    at = found.select("row_key", F.explode(F.filter("hit", lambda x: x["word"].isin(*rare) if rare else F.lit(False))).alias("x")).select("row_key", F.col("x.pos").alias("pos"), F.col("x.word").alias("word"))
    agree = at.join(F.broadcast(index), "word").groupBy("row_key", "t", (F.col("pos") - F.col("p")).alias("shift")).agg(F.count("*").alias("n"), F.first("n_index").alias("n_index"))
    cand = written(agree.filter(F.col("n") == F.col("n_index")).select("row_key", "t", "shift"), "license-candidates")
    # Verification: the words of each candidate meet the words of its file at their places.
    asked = cand.join(F.broadcast(tw), "t").select("row_key", "t", "label", "shift", "n_all", "n_key", "key", "word", (F.col("shift") + F.col("p")).alias("pos"))
    held = found.join(cand.select("row_key").distinct(), "row_key", "left_semi").select("row_key", F.explode("hit").alias("x")).select("row_key", F.col("x.pos").alias("pos"), F.col("x.word").alias("word"))
    judged = asked.join(held, ["row_key", "pos", "word"]).groupBy("row_key", "t", "shift", "label", "n_all", "n_key").agg(F.count("*").alias("n"), F.sum(F.col("key").cast("int")).alias("k"))
    score = F.col("n") / F.col("n_all")
    good = judged.filter((F.col("k") == F.col("n_key")) & (score >= min_score))
    best = good.groupBy("row_key").agg(F.max(score).alias("score"), F.collect_set("label").alias("more"))
    return base.join(best, "row_key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.sort_array(F.array_distinct("base_list")), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("base_list", F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def _needed(words: list[str], keys: tuple[str, ...]) -> list[tuple[int, str]]:
    """Positions in a template, and the words that mandatory phrases ask for there."""
    out = {}
    for key in keys:
        part = key.split()
        at = next(i for i in range(len(words)) if words[i: i + len(part)] == part)
        out |= {at + k: w for k, w in enumerate(part)}
    return sorted(out.items())


def _phrase_places(hit: str, phrase: list[str]) -> Column:
    """Places of a phrase among (position, word) pairs of lexicon words, in order: consecutive pairs with consecutive positions."""
    n = len(phrase)
    at = F.filter(F.sequence(F.lit(0), F.size(hit)), lambda i: _all(
        F.get(hit, i + k)["word"].eqNullSafe(w) & (F.get(hit, i + k)["pos"] - F.get(hit, i)["pos"]).eqNullSafe(k) for k, w in enumerate(phrase)))
    return F.when(F.size(hit) >= n, F.transform(at, lambda i: F.get(hit, i)["pos"])).otherwise(F.array().cast("array<int>"))
