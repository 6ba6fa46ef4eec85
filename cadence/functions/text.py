"""Scalar column functions (normalisation, labels, formats).

All are compositions of built-in Spark SQL expressions, so they stay inside
whole-stage code generation; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Keyword classifier: labels in priority order, each with its keywords in the
# order they are tried. A title gets the first label with any keyword that is
# a substring of the normalised title; otherwise "unknown".
GENRE_KEYWORDS: dict[str, list[str]] = {
    "rap": ["rap", "hip hop", "hiphop", "hip-hop", "trap", "drill", "urban", "bars",
            "freestyle", "flow", "gang", "street", "lil"],
    "country": ["country", "bluegrass", "western", "southern", "cowboy", "folk", "americana"],
    "rock": ["rock", "metal", "punk", "indie", "alternative", "alt", "grunge", "emo",
             "hardcore", "bands"],
    "chill": ["chill", "sleep", "vibes", "vibe", "feels", "lofi", "lo fi", "relax", "calm",
              "peaceful", "ambient", "mellow", "easy", "slow", "acoustic", "coffee", "rainy",
              "study", "focus"],
    "workout": ["workout", "gym", "running", "run", "cardio", "fitness", "lifting",
                "motivation", "grind", "hustle", "pump", "training", "exercise", "gains"],
    "throwback": ["throwback", "throwbacks", "oldies", "classics", "classic", "retro",
                  "old school", "oldschool", "nostalgia", "60s", "70s", "80s", "90s", "2000s"],
    "party": ["party", "lit", "jams", "turn up", "turnup", "pregame", "hype", "banger",
              "bangers", "club", "friday", "weekend", "drunk", "shots"],
    "pop": ["pop", "hits", "summer", "radio", "chart", "mainstream", "sing along",
            "singalong", "feel good"],
    "rnb": ["r&b", "rnb", "soul", "neo soul", "smooth", "groove", "motown", "slow jam",
            "slow jams", "love songs", "romance"],
    "christian": ["worship", "christian", "gospel", "praise", "church", "jesus", "god",
                  "faith", "spiritual", "devotion"],
    "christmas": ["christmas", "xmas", "x-mas", "holiday", "festive", "santa", "jingle"],
    "edm": ["edm", "electronic", "techno", "house", "trance", "dubstep", "rave", "dance",
            "dj", "bass", "beats", "remix"],
    "latin": ["latin", "reggaeton", "salsa", "bachata", "cumbia", "spanish", "reggae",
              "afrobeats"],
    "jazz": ["jazz", "blues", "swing", "bebop"],
}
# Title punctuation replaced by a blank before matching.
TITLE_PUNCTUATION = ".,/#!$%^*;:{}=_`~()@"
# URI prefixes of the three entity kinds.
URI_PREFIXES = {"track": "spotify:track:", "album": "spotify:album:", "artist": "spotify:artist:"}
# Seed-context grades: (upper bound of seed size, text); beyond the last bound
# the model sees only the last 50 items.
SEED_GRADES = [(0, "add at least 1 track to get recommendations"),
               (2, "weak context — add more tracks for better results"),
               (10, "good context"),
               (50, "excellent context")]
# Patterns of the matching key, applied in this order: what each removes, or (the last) turns into a blank.
MATCH_KEY_REMOVED = [r"\(.*?\)", r"\[.*?\]", r"[^a-z0-9\s]"]
MATCH_KEY_BLANK = r"\s+"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _punct_class() -> str:
    # Java regex character class for TITLE_PUNCTUATION; escape the metacharacters.
    esc = "".join("\\" + ch if ch in "^[]\\-" else ch for ch in TITLE_PUNCTUATION)
    return "[" + esc + "]"


def normalize_title(c) -> Column:
    """lower, listed punctuation -> blank, collapse white space, trim."""
    x = F.regexp_replace(F.lower(_col(c)), _punct_class(), " ")
    x = F.regexp_replace(x, r"(?U)\s+", " ")
    return F.trim(x)


def match_key(c) -> Column:
    """Matching key: lower, drop (...) and [...] lazily, keep [a-z0-9 white space],
    collapse white space, trim. NULL becomes ''."""
    x = F.lower(F.coalesce(_col(c), F.lit("")))
    for pattern in MATCH_KEY_REMOVED:
        x = F.regexp_replace(x, pattern, "")
    return F.trim(F.regexp_replace(x, MATCH_KEY_BLANK, " "))


def keyword_label(c, keywords: dict[str, list[str]] | None = None,
                  default: str = "unknown") -> Column:
    """First label (in map order) with a keyword that is a substring of c."""
    keywords = GENRE_KEYWORDS if keywords is None else keywords
    col = _col(c)
    expr = None
    for label, kws in keywords.items():
        cond = None
        for kw in kws:
            t = col.contains(kw)
            cond = t if cond is None else (cond | t)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def word_grams(text: Column, longest: int) -> Column:
    """The stretches of 1 to ``longest`` words of a blank-separated text."""
    def of_words(words: Column) -> Column:
        def stretches(n: int) -> Column:
            at = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
            return F.coalesce(F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " ")), F.array().cast("array<string>"))

        return F.concat(words, *[stretches(n) for n in range(2, longest + 1)])

    # within the one-element array the words are split once, not once for each stretch
    return F.get(F.transform(F.array(F.split(text, " ")), lambda words: of_words(words)), F.lit(0))


def keyword_label_words(c, keywords: dict[str, list[str]] | None = None,
                        default: str = "unknown") -> Column:
    """First label (in map order) with a keyword that stands in c as whole words
    ("grape" is not "rap"). ``c`` is a normalised title: words parted by one blank.

    The title's word stretches are looked up in a hash set of the keywords; of
    those found, the first in the order of the map decides."""
    keywords = GENRE_KEYWORDS if keywords is None else keywords
    label_of = {kw: label for label, kws in reversed(keywords.items()) for kw in kws}
    ordered = [kw for kws in keywords.values() for kw in kws]
    longest = max((kw.count(" ") + 1 for kw in ordered), default=1)
    found = F.get(F.array_intersect(F.array(*map(F.lit, ordered)).cast("array<string>"), word_grams(_col(c), longest)), F.lit(0))
    if not ordered:
        return F.lit(default)
    labels = F.create_map(*[F.lit(x) for pair in label_of.items() for x in pair])
    return F.coalesce(F.element_at(labels, found), F.lit(default))


def has_prefix(c, kind: str) -> Column:
    return _col(c).startswith(URI_PREFIXES[kind])


def uri_of(kind: str, c) -> Column:
    return F.concat(F.lit(URI_PREFIXES[kind]), _col(c).cast("string"))


def epoch_date(c) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd' in UTC, independent of the session time zone."""
    days = F.floor(_col(c) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def display_label(a, b, n: int = 30, m: int = 20, sep: str = " – ") -> Column:
    """prefix(a, n) + sep + prefix(b, m)."""
    return F.concat(F.substring(_col(a), 1, n), F.lit(sep), F.substring(_col(b), 1, m))


def seed_context(n) -> Column:
    col = _col(n)
    expr = None
    for bound, text in SEED_GRADES:
        cond = col <= F.lit(bound)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(F.format_string("showing last 50 of %d tracks to model", col))
