from cadence.functions import text as X

# name -> (normalised title, label)
TITLES = {
    "Hip-Hop!!": ("hip-hop", "rap"), "Rock_n_Roll": ("rock n roll", "rock"), "   lofi   beats  ": ("lofi beats", None),
    "CHILL  vibes": ("chill vibes", None), "gym @ 6am": ("gym 6am", None), "X-mas ^ 2016": ("x-mas 2016", None),
    "grape soda": ("grape soda", "rap"),  # a keyword inside a word counts
    "R&B (chill)": ("r&b chill", None), "\u00e9t\u00e9": ("\u00e9t\u00e9", "unknown"), "": ("", "unknown"),
    "a.b,c/d#e!f$g%h^i*j;k:l{m}n=o_p`q~r(s)t@u": ("a b c d e f g h i j k l m n o p q r s t u", "unknown"),
}
KEYS = {"DRAKE (feat. X)": "drake", "Song [Remix]!!": "song", None: "", "\u00a1\u00a1\u00a1": "", "a  b\tc": "a b c", "(x)(y) z": "z"}


def test_normalize_and_label(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "name string")
    for r in df.select("name", X.normalize_title("name").alias("n")).withColumn("g", X.keyword_label("n")).collect():
        title, label = TITLES[r["name"]]
        assert r["n"] == title
        assert label is None or r["g"] == label


def test_match_key(spark):
    df = spark.createDataFrame([(v,) for v in KEYS], "t string")
    assert {r["t"]: r["k"] for r in df.select("t", X.match_key("t").alias("k")).collect()} == KEYS


def test_seed_context_and_dates(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 10, 11, 50, 51, 300)], "n int")
    got = {r["n"]: r["c"] for r in df.select("n", X.seed_context("n").alias("c")).collect()}
    assert got[0].startswith("add at least")
    assert got[2].startswith("weak") and got[3] == "good context" and got[50] == "excellent context"
    assert got[51] == "showing last 50 of 51 tracks to model"
    d = spark.createDataFrame([(1509494400,), (0,), (86399,)], "s long").select(X.epoch_date("s").alias("d"))
    assert [r["d"] for r in d.collect()] == ["2017-11-01", "1970-01-01", "1970-01-01"]


def test_keywords_as_whole_words(spark):
    from cadence.functions.text import GENRE_KEYWORDS, keyword_label_words, normalize_title
    titles = ["grape juice", "my rap songs", "Old School days", "oldschooled", "slow jam", "R&B / pop", "x-mas", "popular", "", None, "sing  along!", "hip hop", "a lo fi b", "rainy"]
    df = spark.createDataFrame([(t,) for t in titles], "t string").select("t", normalize_title("t").alias("n"))
    got = {r["t"]: r["g"] for r in df.select("t", keyword_label_words("n").alias("g")).collect()}

    def brute(n):
        for label, kws in GENRE_KEYWORDS.items():
            if any(f" {kw} " in f" {n} " for kw in kws):
                return label
        return "unknown"

    assert got == {r["t"]: "unknown" if r["n"] is None else brute(r["n"]) for r in df.collect()}
    assert got["grape juice"] == "unknown" and got["my rap songs"] != "unknown" and got["popular"] == "unknown" and got["Old School days"] == "throwback"
    own = {"first": ["b c d"], "second": ["a", "c"]}
    r = spark.createDataFrame([("a b c d",), ("b c",), ("d",)], "n string").select(keyword_label_words("n", own, "none").alias("g")).collect()
    assert [x["g"] for x in r] == ["first", "second", "none"]
