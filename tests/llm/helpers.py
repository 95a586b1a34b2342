"""Small tables and the brute-force answers to them."""

import random

SCHEMA = "doc_id long, text string, source string, n_chars long, keep_id string, id string, size string, _key string"


def frame(spark, rows):
    """Rows of (doc_id, text[, source]) with extra columns whose names clash with those that operators use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "a", None, "x", "y", "z", "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return (text or "").encode().split()


def prose(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "a null id"), (None, None), (7, "ä ö\nü" * 30)]
