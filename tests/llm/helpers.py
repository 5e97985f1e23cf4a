"""Small documents frames with awkward rows."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and empty texts, null ids, a repeated row, white space and a long text.
AWKWARD = [
    (1, None, "en", "a"), (2, "", "en", None), (None, "the cat sat on the mat today", None, "b"),
    (4, "the dog ran over the hill and far away from home", "en", "a"),
    (4, "the dog ran over the hill and far away from home", "en", "a"),
    (6, " \t\n ", None, None), (7, "x", "de", "b"), (8, "日本語 テスト \U0001f600 z", None, "c"),
    (9, "long " * 30_000, "en", "a"),
]


def frame(spark, rows, extra=""):
    """A documents frame; ``extra`` adds columns that operators might also use as names."""
    full = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in extra.split():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("own"))
    return df


def texts(spark, values):
    return frame(spark, [(i, t, None, None) for i, t in enumerate(values)])


#: Names that operators use for columns of their own.
CLASHING = "row size rank node rk key part tie line lost score repeats stays root copy spans"
