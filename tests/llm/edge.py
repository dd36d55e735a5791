"""Edge rows shared by the tests of this folder."""

import random
import string

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, one id with two texts."""
    rng = random.Random(5)
    long_text = " ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(30_000))
    rows = [
        (1, "the cat sat on the mat", "en", "a", 22), (2, "the cat sat on the mat", "en", "a", 22), (3, "", "en", "a", 0),
        (4, None, "de", "b", None), (5, "der hund und die katze", "de", "b", 22), (6, "  \t\n ", None, None, 5),
        (7, "1234 !!", "en", "", 7), (8, long_text, "en", "b", len(long_text)), (9, "x", None, "a", 1),
        (10, "the cat sat on the mat", None, None, 22), (10, "the cat sat on the mat", None, None, 22),
        (11, "first text of this id", "en", "a", 21), (11, "other text of this id", "en", "a", 21), (None, "no id here", "en", "a", 10),
        (12, "\U0001F642 na\u00efve \u65e5\u672c\u8a9e \x1c end", "en", "a", 17),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df, names):
    """Extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
