"""Awkward rows that every operator on documents has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns; a table may bring them along.
CLASHING = ["size", "shard", "slot", "taken", "given", "score", "lang_pred", "hits", "found", "pattern", "bin", "k1", "k2", "n",
            "draw", "part", "sub", "hots", "offset", "uses", "id", "sig", "place"]


def words(rng: random.Random, n: int, stems=("ka", "lo", "mi", "ra", "tu", "ve", "no", "si")) -> str:
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward(seed: int = 3):
    """(doc_id, text, lang, source, n_chars) rows: nulls, blanks, copies, ties, a very long text."""
    rng = random.Random(seed)
    base = words(rng, 60)
    long_ = words(rng, 30_000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "?!. 123", "de", "b", 7),
            (5, base, "en", "a", 1), (6, base, "en", "b", 1), (6, base, "en", "b", 1), (7, base + " extra", "en", None, 1),
            (8, long_, "fr", "b", 1), (9, "Ünïcödé 語 " + base, None, "c", 1), (None, "no id here at all", "en", "c", 1),
            (10, "two words", "en", "c", 1)]
    return rows + [(100 + i, words(rng, rng.randint(1, 80)), rng.choice(["en", "de"]), rng.choice("abc"), 1)
                   for i in range(25)]


def frame(spark, rows=None, clash=False):
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if clash:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])
    return df
