import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; an input may have them too.
CLASHING = ["blob", "cls", "n", "row", "number", "redacted", "component", "score", "ids", "queue", "bucket", "kind", "start"]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashing=False):
        full = [(i, t, *(rest or ("en", "src0", len(t) if t is not None else None))) for i, t, *rest in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in CLASHING if clashing else []:
            df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that ask something of every operator: missing, empty, blank, tiny, odd signs, long, repeated."""
    rng = random.Random(5)
    words = ["the", "of", "and", "reading", "Wörter", "où", "it's", "1999", "naïve", "日本語", "x"]
    long = " ".join(rng.choices(words, k=30_000))
    return [
        None, "", " ", "\n\n", "a", "...", "0", "tab\tand  two spaces \n end ", "<|endoftext|> in text", "Σίσυφος ÀÉ İ ß",
        "é   \x1c \x85 　 end", "😀 emoji 日本語", "don't we'll 'sure ''s x's", "a" * 5000, "same text twice here now",
        "same text twice here now", long, "\x00 nul",
    ]
