"""Small inputs for the corpus operators."""

import random

import pandas as pd

WORDS = "der die das und ist nicht the of and to in is was le la les une est dans pour que con por los ñandú élan über xylophone quartz vivid jumbo".split()


def prose(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def pandas_of(df):
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)


def odd_rows(base=0):
    """Null ids and texts, empty, blank and very long texts, repeated rows."""
    long = prose(99, 30_000)
    return [(base + 1, None, "en", "a"), (base + 2, "", None, None), (base + 3, " \t\n ", "de", "b"), (base + 4, long, "en", "a"), (base + 5, long, "fr", None), (None, "no id at all", "en", "a"), (base + 6, "one", None, "c"), (base + 6, "one", None, "c"), (base + 7, "1234 !!", "es", "c"), (base + 8, "one", "en", "a")]
