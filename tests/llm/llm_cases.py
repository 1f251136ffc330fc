"""Odd rows that every operator on documents must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
COPY = "a passage of some length that several of the documents below share word by word, " * 3

ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "s", 59),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (4, "   \n\t ", "en", "s", 6),
    (5, COPY + "five", "en", "s", 1),
    (6, COPY + "six and more words at the end", "en", "s", 1),
    (6, COPY + "six and more words at the end", "en", "s", 1),  # a repeated row
    (7, "same id, first text " + COPY, "en", "s", 1),
    (7, "same id, second text " + COPY, "en", "s", 1),
    (None, "no id " + COPY, "en", "s", 1),
    (None, None, "en", "s", 1),
    (8, LONG, "en", "s", len(LONG)),
    (9, LONG + " tail", "en", "s", len(LONG)),
    (10, "é" * 300 + " ß " + "é" * 300, "fr", "s", 603),
    (-4, "a negative id, " + COPY, "en", "s", 1),
    ((1 << 60) + 1, "a large id, " + COPY, "en", "s", 1),
    ((1 << 63) - 1, "the largest id, " + COPY, "en", "s", 1),
]


def odd_docs(spark, clashing=()):
    """The odd rows, with further columns of the given names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, DOCS)
    return df.withColumns({c: F.lit("clash") for c in clashing})


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
