from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=""):
    """documents with these texts; ids from 0."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, white space, one word, repeated rows and a very long text."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "Été", "niño", "x.", "3,5", "日本語"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    return [None, "", " \n\t ", "word", "same text here\nagain", "same text here\nagain", long, "tail\n\n", "a  b \n c"]


def clash(df):
    """The rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = {n: F.lit(7) for n in ("id", "fp", "score", "lines", "kept", "bad", "items", "ranges", "n_hit", "key", "body", "again", "h1", "c0", "c.1", "ids", "kinds", "hit_id")}
    return df.withColumns(extra)
