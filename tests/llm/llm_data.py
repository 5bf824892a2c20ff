"""Small documents with all that operators must cope with."""

import random

from pyspark.sql import types as T

#: Extra columns whose names the operators use themselves.
EXTRA = ("n", "h", "t", "id", "key", "score", "hits", "items", "node", "rank", "spans", "lines", "kept")

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in EXTRA]
)


def frame(spark, rows):
    """Documents of (doc_id, text) with columns of clashing names."""
    return spark.createDataFrame([(i, t, *["x"] * len(EXTRA)) for i, t in rows], SCHEMA)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, and a very long text."""
    rng = random.Random(5)
    long = "\n".join(" ".join(words(rng, 40, 5000)) for _ in range(900))
    short = " ".join(words(rng, 60))
    return [
        (1, None), (2, ""), (3, " \n\t\n "), (4, short), (4, short), (5, short), (6, short + " end"),
        (None, short), (None, None), (7, long), (8, long), (9, "one"), (9, "two"),
        (10, "Ünïcödé ©\n" * 50), (11, "\n".join(["same line here"] * 30)), (12, "a" * 900),
        (13, "a b c"), (14, "A B C"),
    ]


def rows(df, *cols):
    """All rows as a sorted list of tuples."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
