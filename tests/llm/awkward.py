"""Documents with every awkward case: nulls in all columns, empty and very long texts, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(12_000))
PASSAGE = "one passage that several documents share and that is longer than fifty bytes, to be sure"
ROWS = [
    (0, "the cat and the dog were in the house of the king", "en", "a"),
    (1, "the cat and the dog were in the house of the king", "en", "a"),
    (1, "the cat and the dog were in the house of the king", "en", "a"),
    (2, "der hund und die katze sind in dem haus", "de", None),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\n ", None, "b"),
    (6, "1234 5678 !!", "de", "a"),
    (7, LONG, "de", "a"),
    (8, LONG + " end", "de", "a"),
    (9, "é à ü ñ " * 20 + PASSAGE, "fr", "ü"),
    (10, PASSAGE + " z " * 30, "en", "\U0001f600"),
    (11, "x" * 120, "en", "c"),
    (12, "x" * 120 + "y", "en", "c"),
    (None, PASSAGE + " without an id", "en", "a"),
    (14, PASSAGE.upper() + " x", "en", "a"),
    (15, "single", "en", "d"),
]


def documents(spark, rows=None, extra=True):
    rows = ROWS if rows is None else rows
    df = spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], COLUMNS)
    if not extra:
        return df
    names = ("fingerprint", "_found", "group", "shard", "count", "part", "_id", "_hash", "item_id", "place", "is_next", "_copies", "copies")
    return df.select("*", *[F.lit(1).alias(n) for n in names])


def empty(spark):
    return documents(spark, [], extra=False)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}
