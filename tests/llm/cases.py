"""Awkward rows that every operator has to take."""

from pyspark.sql import functions as F

LONG = "the quick brown fox jumps over the lazy dog and runs. " * 8_000
DOCUMENTS = [
    (1, "The first text of all has more than ten words, and it is plain.", "en", "a"),
    (1, "The first text of all has more than ten words, and it is plain.", "en", "a"),
    (2, "the FIRST text of all has more than ten words, and it is plain.", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (4, "", None, "b"),
    (None, "A row without an id, which has ten words or a few more than that.", "de", "b"),
    (None, None, None, None),
    (5, LONG, "en", "b"),
    (6, "x" * 3_000, "en", "b"),
    (7, " \t\n ", "fr", "b"),
    (8, "Ünïcödé 漢字 🙂 text\x0bwith\x0cmany kinds of blanks and signs #*$%&|<>", "fr", "c"),
]


def documents(spark):
    """``DOCUMENTS`` with columns whose names are those of results."""
    frame = spark.createDataFrame(DOCUMENTS, "doc_id bigint, text string, lang string, source string")
    for name in ("kept", "score", "slot", "shard", "n_tokens", "component_id", "sequence_id", "length", "fp", "cell", "root"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def rows(frame, *names):
    """Rows as tuples in an order that nulls don't disturb."""
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=lambda row: [(x is None, str(type(x)), x) for x in row])
