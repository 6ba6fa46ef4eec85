"""Quality rules with a distribution-divergence verdict, in DataFrame operations only.

Base rules: too few words, or too many words inside 5-word windows that repeat.

The method compares two histograms of a document with its language's reference,
made from all documents of that ``lang`` by medians, so that junk in the
minority does not move it:

* character classes: ASCII lower case, upper case, digits, white space, symbols
  ``#*$%&|<>``, other ASCII, and characters outside ASCII;
  The reference share of a class is its median over the documents of
  ``min_chars`` characters or more, each document counting once.
* words (lower case, without ASCII punctuation at their edges): the language's
  most frequent words, as many as hold ``held`` of its words (``common`` at
  most), all others as one class, and tokens of punctuation alone as another.
  The reference share of a word is its median over up to ``GROUPS`` groups of
  sources (by hash of ``source``, if there is such a column), each group
  counting once, so that one source moves one group however many rows it has.
  The share of punctuation tokens is the median over the documents of
  ``min_words`` tokens or more.

Distance: Jensen-Shannon, square root of the divergence to base 2, from 0 to 1.
A document is rejected if a distance exceeds its limit.  A short text is far from
any reference by chance, and less so the longer it is: the limit for n words is
sqrt(word_base + word_noise / n), ``max_word_distance`` at most.  With a third of
the words held, a text with none of them has a distance of 0.435 or more, over
the limit at any length.  Minimum-length guards:
texts under ``min_chars`` characters skip the character test, texts under
``min_words`` words the word test, and languages under ``min_reference`` words
have no reference, so their documents skip both.

Edge cases: a null text has no words and fails the base rules; a null language
is a language of its own; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
#: From the first to the last character of a word that is not ASCII punctuation.
CORE = r"[\p{Alnum}\P{ASCII}](?:\S*[\p{Alnum}\P{ASCII}])?"
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "ascii", "other")
#: Grid of the medians over documents; groups of sources; a word is rare under 1 / RARE of its group's words; hash buckets of words;
#: places of the table that reference words are looked up in.
GRID, GROUPS, RARE, BUCKETS, SLOTS = 1_000, 64, 2_000, 8_192, 4_096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def core_list(text: Column) -> Column:
    """The words of ``text`` in lower case and without punctuation at their edges; tokens of punctuation alone have none."""
    return F.regexp_extract_all(F.lower(text), F.lit(CORE), F.lit(0))


def class_counts(text: Column) -> Column:
    """Code points of ``text`` by class, in the order of CLASSES; each class is taken out before the next is counted."""
    def strip(t: Column, classes: list[str], counts: list[Column]) -> Column:
        if not classes:
            return F.array(*counts, F.length(t).cast("long"))
        return let(F.regexp_replace(t, classes[0], ""), lambda rest: strip(rest, classes[1:], [*counts, (F.length(t) - F.length(rest)).cast("long")]))

    return strip(text, ["[a-z]+", "[A-Z]+", "[0-9]+", r"[\x20\x09-\x0D]+", "[#*$%&|<>]+", r"[\x00-\x7F]+"], [])


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that are found twice or more in ``words``.

    Windows are compared by a 64-bit hash; those that agree are then compared word by word."""
    n = F.size(words) - (width - 1)

    def at(x: Column) -> Column:
        return F.slice(words, x + 1, width)

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (at(x["i"]) == at(y["i"])), F.lit(False))

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, k: equal(x, F.get(s, k - 1)) | equal(x, F.get(s, k + 1)))
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - i, F.lit(width)))), F.lit(0), lambda a, b: a + b))

    def of_pairs(pair: Column) -> Column:
        # A window's hash is made of the hashes of pairs of words that cover it.
        windows = F.slice(pair, 1, n)
        for k in sorted({*range(2, width - 1, 2), width - 2}):
            windows = F.zip_with(windows, F.slice(pair, k + 1, n), lambda a, b: F.xxhash64(a, b))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)))

    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 1, let(pairs, of_pairs)).otherwise(F.lit(0)).cast("long")


def js_part(p: Column, q: Column) -> Column:
    """Twice the share of one class in the Jensen-Shannon divergence (base 2)."""
    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    return let((p + q) / 2, lambda m: part(p, m) + part(q, m))


def js_of(total: Column) -> Column:
    """The distance of the sum of all classes' ``js_part``."""
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    return js_of(F.aggregate(F.zip_with(p, q, js_part), F.lit(0.0), lambda s, x: s + x))


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c.cast("double") / total)


def medians(shares_of: DataFrame) -> DataFrame:
    """Per ``__lang``: the median of each place of the arrays ``s`` over the rows where it is not null, on a grid of 1 / GRID, as pairs (k, bin) in array ``m``.

    The rows are counted per place and grid value, so what is shuffled is bounded by the languages."""
    bins = shares_of.select("__lang", F.posexplode(F.transform("s", lambda x: F.round(x * GRID).cast("int"))).alias("k", "bin")).filter(F.col("bin").isNotNull())
    bins = bins.groupBy("__lang", "k", "bin").agg(F.count("*").alias("n"))
    place = Window.partitionBy("__lang", "k")
    half = bins.withColumn("upto", F.sum("n").over(place.orderBy("bin"))).withColumn("all", F.sum("n").over(place)).filter(2 * F.col("upto") >= F.col("all"))
    return half.groupBy("__lang", "k").agg(F.min("bin").alias("bin")).groupBy("__lang").agg(F.sort_array(F.collect_list(F.struct("k", "bin"))).alias("m"))


def word_shares(d: DataFrame, *, min_reference: int, broadcast_rows: int) -> DataFrame:
    """__lang, word, share: the median over the language's groups of sources (``g``) of the share of each word of ``w``.

    Groups under ``min_reference`` words are taken as one; languages under it are left out.  A share under 1 / RARE of its group counts as 0."""
    # Words by hash first: a word of a frequent share lies in a bucket of such a share, so the many rare words are never shuffled.
    words = d.select("__lang", "g", F.explode("w").alias("word")).withColumn("b", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int"))
    sizes = written(words.groupBy("__lang", "g", "b").agg(F.count("*").alias("k")), "quality-buckets")
    totals = sizes.groupBy("__lang", "g").agg(F.sum("k").alias("n"))
    lang = Window.partitionBy("__lang")
    totals = totals.withColumn("all", F.sum("n").over(lang)).filter(F.col("all") >= min_reference).withColumn("vote", F.when(F.col("n") >= min_reference, F.col("g")).otherwise(F.lit(-1)))
    totals = totals.withColumn("n", F.sum("n").over(Window.partitionBy("__lang", "vote"))).withColumn("votes", F.size(F.collect_set("vote").over(lang))).drop("all")
    voting = sizes.join(totals, ["__lang", "g"]).withColumn("in_vote", F.sum("k").over(Window.partitionBy("__lang", "vote", "b")))
    # At most RARE buckets of each of GROUPS groups of a language, and about as many as it has frequent words.
    heavy = written(voting.filter(F.col("in_vote") * RARE >= F.col("n")).select("__lang", "g", "b", "vote", "n", "votes"), "quality-frequent")
    few = heavy.limit(broadcast_rows + 1).count() <= broadcast_rows
    voted = words.join(F.broadcast(heavy) if few else heavy, ["__lang", "g", "b"]).groupBy("__lang", "vote", "word").agg((F.count("*") / F.first("n")).alias("share"), F.first("votes").alias("votes")).filter(F.col("share") * RARE >= 1)
    each = voted.groupBy("__lang", "word").agg(F.sort_array(F.collect_list("share")).alias("s"), F.first("votes").alias("votes"))

    def nth(i: Column) -> Column:  # of all votes, those without the word first
        return F.when(i >= F.col("votes") - F.size("s"), F.get("s", i - F.col("votes") + F.size("s"))).otherwise(F.lit(0.0))

    return each.select("__lang", "word", ((nth(F.floor((F.col("votes") - 1) / 2).cast("int")) + nth(F.floor(F.col("votes") / 2).cast("int"))) / 2).alias("share")).filter(F.col("share") > 0)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with what both the references and the verdict are made of, from one pass over the texts:
    __lang, g (group of sources), w (cores of the words), c (CLASSES), n_words, n_chars, n_repeat_words and n_dup_lines, each with leading __."""
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    text = F.col("__t")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measures = let(word_list(text), lambda w: F.struct(
        core_list(text).alias("w"), class_counts(text).alias("c"), F.size(w).cast("long").alias("n_words"), F.length(text).cast("long").alias("n_chars"),
        repeat_words(w).alias("n_repeat_words"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    d = docs.select(*keep, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"),
                    F.pmod(F.conv(F.substring(F.md5(source), 1, 8), 16, 10).cast("long"), F.lit(GROUPS)).cast("int").alias("__g"), F.coalesce("text", F.lit("")).alias("__t"))
    # One row out for each row in: a generator's result is computed once, not once for each use of a measure.
    d = d.withColumn("__m", F.explode(F.array(measures)))
    return d.select(*keep, "__lang", "__g", *[F.col(f"__m.{c}").alias(f"__{c}") for c in ("w", "c", "n_words", "n_chars", "n_repeat_words", "n_dup_lines")])


def references(d: DataFrame, *, common: int, held: float, min_chars: int, min_words: int, min_reference: int, broadcast_rows: int) -> DataFrame:
    """Per language ``__lang`` of ``measured`` rows: the reference words by hash slot (``ref_slots``: words of each slot; ``ref_from``: place of its
    first), ``ref_words`` by place, the shares ``ref_named`` of them together, ``ref_rest`` of all other words and ``ref_bare`` of punctuation tokens, and ``ref_class_shares``."""
    rank = Window.partitionBy("__lang").orderBy(F.desc("share"), "word")
    top = word_shares(d.select("__lang", F.col("__g").alias("g"), F.col("__w").alias("w")), min_reference=min_reference, broadcast_rows=broadcast_rows).withColumns(
        {"r": F.row_number().over(rank), "upto": F.sum("share").over(rank.rowsBetween(Window.unboundedPreceding, 0))})
    top = top.filter((F.col("r") <= common) & (F.col("upto") - F.col("share") < held)).groupBy("__lang").agg(
        F.sort_array(F.collect_list(F.struct(slot(F.col("word")).alias("slot"), F.col("word"), F.col("share")))).alias("top"))
    bare = F.when(F.col("__n_words") >= min_words, 1 - F.size("__w") / F.col("__n_words"))
    classes = F.when(F.col("__n_chars") >= min_chars, shares(F.col("__c"), F.col("__n_chars"))).otherwise(F.array_repeat(F.lit(None).cast("double"), len(CLASSES)))
    m = medians(d.select("__lang", F.concat(classes, F.array(bare)).alias("s")))
    of_class = F.filter("m", lambda x: x["k"] < len(CLASSES))
    whole = F.aggregate(of_class, F.lit(0), lambda a, x: a + x["bin"])
    m = m.select("__lang", F.when(whole > 0, F.transform(of_class, lambda x: x["bin"] / whole)).alias("ref_class_shares"),
                 F.coalesce(F.get(F.transform(F.filter("m", lambda x: x["k"] == len(CLASSES)), lambda x: x["bin"] / GRID), F.lit(0)), F.lit(0.0)).alias("bare"))
    top = top.join(m, "__lang", "left").withColumn("bare", F.coalesce("bare", F.lit(0.0)))
    named = F.transform("top", lambda x: x["share"] * (1 - F.col("bare")))
    rest = F.greatest(F.lit(0.0), 1 - F.col("bare") - F.aggregate(named, F.lit(0.0), lambda a, x: a + x))
    by_slot = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.transform(F.filter("top", lambda x: x["slot"] == s), lambda x: x["word"]))
    before = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.size(F.filter("top", lambda x: x["slot"] < s)))
    # Of a reference word: its share q, and q log2 q - q, what its own part of the divergence is beyond q where the text holds it.
    words = F.transform(F.sort_array(F.transform("top", lambda x: F.struct(x["slot"], x["word"], x["share"]))), lambda x: let(
        x["share"] * (1 - F.col("bare")), lambda q: F.struct(q.alias("q"), F.when(q > 0, q * F.log2(q) - q).otherwise(F.lit(0.0)).alias("own"))))
    return top.select("__lang", by_slot.alias("ref_slots"), before.alias("ref_from"), words.alias("ref_words"), "ref_class_shares",
                      F.aggregate(named, F.lit(0.0), lambda a, x: a + x).alias("ref_named"), rest.alias("ref_rest"), F.col("bare").alias("ref_bare"))


def slot(word: Column) -> Column:
    """The place of a word in a hash table of SLOTS places."""
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def word_distance(words: Column, n_words: Column) -> Column:
    """Distance of the words' histogram from the reference in the row.

    Words are looked up in the hash table; the places found are sorted, and each stretch of one place is a class with its
    count.  A reference word that the text lacks adds its share as it is, so only words found are visited: for shares p in
    the text and q in the reference, p log2 p + q log2 q - (p + q) log2((p + q) / 2) less q."""
    found = F.filter(words, lambda w: F.array_contains(F.get("ref_slots", slot(w)), w))
    places = F.sort_array(F.transform(found, lambda w: F.get("ref_from", slot(w)) + F.array_position(F.get("ref_slots", slot(w)), w).cast("int") - 1))

    def total(at: Column) -> Column:
        last = F.filter(F.transform(at, lambda p, i: F.when((i + 1 == F.size(at)) | (F.get(at, i + 1) != p), i)), lambda i: i.isNotNull())
        classes = let(last, lambda e: F.transform(e, lambda i, k: F.struct(
            ((i - F.coalesce(F.get(e, k - 1), F.lit(-1))) / n_words).alias("p"), F.get("ref_words", F.get(at, i)).alias("r"))))
        seen = F.aggregate(classes, F.lit(0.0), lambda a, x: a + x["p"] * F.log2(x["p"]) + x["r"]["own"] - (x["p"] + x["r"]["q"]) * F.log2((x["p"] + x["r"]["q"]) / 2))
        others = js_part((F.size(words) - F.size(at)) / n_words, F.col("ref_rest")) + js_part((n_words - F.size(words)) / n_words, F.col("ref_bare"))
        return F.col("ref_named") + seen + others

    return js_of(let(places, total))


def quality(docs: DataFrame, keep: list[str], *, common: int = 400, held: float = 0.33, min_chars: int = 250, min_words: int = 40, min_reference: int = 2_000,
            max_class_distance: float = 0.32, max_word_distance: float = 0.42, word_base: float = 0.04, word_noise: float = 9.0,
            broadcast_languages: int = 100, broadcast_rows: int = 200_000) -> DataFrame:
    """Columns ``keep`` of ``docs`` with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words, __base_failed, __class_distance, __word_distance and __kept.

    References are broadcast for at most ``broadcast_languages`` languages (a table of SLOTS places each), the frequent hash
    buckets for at most ``broadcast_rows`` rows; beyond, they are joined by a shuffle."""
    d = written(measured(docs, keep), "quality-measures", compression="zstd", dictionary=False)
    ref = written(references(d, common=common, held=held, min_chars=min_chars, min_words=min_words, min_reference=min_reference, broadcast_rows=broadcast_rows), "quality-references")
    d = d.join(F.broadcast(ref) if ref.limit(broadcast_languages + 1).count() <= broadcast_languages else ref, "__lang", "left")
    n, chars = F.col("__n_words"), F.col("__n_chars")
    d = d.withColumns({
        "__class_distance": F.when(F.col("ref_class_shares").isNotNull() & (chars >= min_chars), js_distance(shares(F.col("__c"), chars), F.col("ref_class_shares"))),
        "__word_distance": F.when(F.col("ref_slots").isNotNull() & (n >= min_words), word_distance(F.col("__w"), n)),
        "__word_chars": chars - F.col("__c")[3], "__n_symbols": F.col("__c")[4],
        "__base_failed": (n < 10) | (100 * F.col("__n_repeat_words") > 20 * n)})
    # One row out for each row in, as above: a filter on the verdict is not pushed below.
    d = d.withColumn("__d", F.explode(F.array(F.struct("__class_distance", "__word_distance")))).withColumns({c: F.col(f"__d.{c}") for c in ("__class_distance", "__word_distance")})
    far = F.coalesce(F.col("__class_distance") > max_class_distance, F.lit(False)) | F.coalesce(F.col("__word_distance") > F.least(F.lit(max_word_distance), F.sqrt(word_base + word_noise / n)), F.lit(False))
    return d.withColumn("__kept", ~F.col("__base_failed") & ~far).select(*keep, *[f"__{c}" for c in REPORT])


REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def quality_report(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and both distances (rounded; null where a guard holds) of every row."""
    q = quality(docs, ["doc_id"], **limits)
    return q.select("doc_id", *[(F.round(f"__{c}", 6) if c.endswith("distance") else F.col(f"__{c}")).alias(c) for c in REPORT])


def kept_documents(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with."""
    return quality(docs, docs.columns, **limits).filter("__kept").select(*docs.columns)
