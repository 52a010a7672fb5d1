"""Small tables with the awkward rows that every operator must take."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text): copies, shared passages, null, empty, blank, long and odd texts."""
    shared = prose(1, 40)
    texts = [prose(2, 60), prose(2, 60), shared, "Intro words. " + shared + " and an end", None, "", " \t\n", "one", "One  two\tthree",
             "é漢字 😀 ÀÉ " * 3, prose(3, 30).upper(), prose(3, 30), "same " * 200, "same " * 150, "\x1c\x85\xa0 odd", prose(4, 3000), prose(4, 3000) + " x"]
    return list(enumerate(texts))


SCHEMA = "doc_id bigint, text string"
#: Columns whose names the operators use inside.
CLASHING = {"id": "1", "word": "2", "cell": "3", "print": "4", "uid": "5", "row": "6", "text_key": "7", "label": "8", "h": "9", "kept": "10", "n_words": "11"}


def frame(spark, rows=None, clashing=False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if clashing else df
