"""Small tables with the awkward cases that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id string, bucket int"


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words):03d}x{rng.randrange(50):02d}" for _ in range(n))


def documents(spark, pairs):
    """Rows with clashing extra columns; n_chars is the length of the text."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", None, 1) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    long_text = prose(9, 30_000, 100_000)
    return documents(
        spark,
        [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d"), (None, "null id " * 4),
         (None, None), (7, long_text), (8, "é" * 3000), (9, "\n".join(["same line here."] * 5)), (10, "x\u0000y   z")],
    )


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
