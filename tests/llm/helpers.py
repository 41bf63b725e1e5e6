"""Small tables with every awkward case the operators must define."""

import zlib

SPACE = " \t\n\x0b\x0c\r"


def lower_az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    out, own = [], ""
    for c in lower_az(text or "") + " ":
        if c in SPACE:
            if own:
                out.append(own)
            own = ""
        else:
            own += c
    return out


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


#: (doc_id, text): nulls, empty and long texts, ties, repeated rows and ids.
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (6, "the cat sat on the mat " * 50),
    (6, "the cat sat on the mat " * 50), (7, "word " * 30000), (8, "x" * 50000), (9, "ÄÖ É naïve 日本語 \U0001F600 text"),
    (None, "a row without an id"), (None, None), (10, "dup same id"), (10, "other text of the same id"),
    (11, "A\x0bB\x0cC\rD  E\n\nF"), (12, "<|endoftext|> inside <|endoftext|>"),
]


def awkward(spark, extra=True):
    """The awkward rows, with columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    if extra:
        for name in ("Text", "key", "doc", "size", "print", "n_lines", "ids", "row", "c0"):
            df = df.withColumn(name, F.lit(0)) if name != "Text" else df.select("*", F.lit("decoy").alias("Text"))
    return df
