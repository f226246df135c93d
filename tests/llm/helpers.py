"""Small tables with the awkward rows every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """documents from (doc_id, text, lang, source)."""
    return spark.createDataFrame([(i, t, la, s, len(t) if t is not None else None) for i, t, la, s in rows], DOCS)


def prose(rng: random.Random, n: int, syllables=("the", "an", "er", "tion", "st", "re", "ou", "is")) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward(seed: int = 1):
    """Nulls, empty, white space, one word, non-ASCII, long, without spaces, repeated and tied rows."""
    rng = random.Random(seed)
    long = prose(rng, 6000)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", "de", None), (4, "word", None, "b"), (5, "Größe niña être 日本語 😀 ▁x", "de", "b"),
            (6, long, "en", "c"), (7, "x" * 9000, "en", "c"), (8, "same text here again and again", "en", "a"), (8, "same text here again and again", "en", "a"),
            (9, "same text here again and again", "en", "b"), (None, prose(rng, 30), "fr", "b"), (11, prose(rng, 40), "fr", "a"), (12, prose(rng, 3), None, None)]
    return rows + [(20 + k, prose(rng, rng.randint(5, 80)), rng.choice(["en", "fr"]), rng.choice(["a", "b", "c", None])) for k in range(40)]
