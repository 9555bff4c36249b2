"""Small document tables with the cases every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "der hund läuft über die straße und the cat sat on a mat señor año tion ing ever never".split()

LONG = " ".join(f"w{i % 977}" for i in range(9_000))

EDGE_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one two",
    "ONE two",
    "one two three",
    "x" * 5_000,
    "héllo wörld ß 日本語 😀",
    LONG,
    LONG,
]


def rows(texts, start=0):
    return [(start + i, text, "en", None, None if text is None else len(text)) for i, text in enumerate(texts)]


def edge_rows():
    """Null columns, empty and very long texts, ties, a repeated row and a row without an id."""
    found = rows(EDGE_TEXTS)
    return [*found, found[3], (None, "one two three", None, "s", 13)]


def prose(seed, words=120):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(words))


def frame(spark, found, schema=SCHEMA):
    return spark.createDataFrame(found, schema)
