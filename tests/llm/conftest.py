import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents tables from (doc_id, text[, lang]) rows, with columns whose names clash with the operators' own."""
    def make(rows, extra=False, partitions=2):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        if extra:
            from pyspark.sql import functions as F
            for c in ("row_key", "w", "words", "bits", "shard", "ids", "fp", "start", "score", "component_id", "n_words", "hit", "part", "t", "kept", "label", "item_id", "first", "window"):
                df = df.withColumn(c, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"



@pytest.fixture(scope="session")
def odd_texts():
    """Texts that hit the edges: null, empty, white space, long, special strings, several scripts."""
    return [None, "", " \n\t ", "a", "one two", "x" * 5000, "<|endoftext|> tail", "I'm you're 'sun !'s", "naïve CAFÉ À b", "日本語 テキスト", "ΑΣ ΣΑΣ",
            " ".join(f"w{i % 97} of thing{i}," for i in range(9000)), "a  b \t c\r\n", "KK İ x́"]
